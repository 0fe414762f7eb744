"""Whitespace rules shared by every cleaning expression.

Spark's ``trim`` only strips the space character and ``\\s`` is ASCII.  The class below is the Unicode
White_Space property plus the four information separators U+001C..U+001F, which count as blanks in the
record rules.  It is spelled out because the regex engine matches listed ranges several times faster
than the property.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK_CHARS = r" \t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK = f"[{BLANK_CHARS}]"

# Line ends of a text document: CR LF, or any single vertical-space character.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, for lambdas that mention it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Remove blanks from both ends."""
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")


def collapse(text: Column) -> Column:
    """Turn every run of blanks into one space."""
    return F.regexp_replace(text, f"{BLANK}+", " ")


def drop_blanks(text: Column) -> Column:
    return F.regexp_replace(text, f"{BLANK}+", "")


def is_blank(text: Column) -> Column:
    """True for NULL, empty and all-blank text."""
    return F.coalesce(strip(text) == "", F.lit(True))


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def document_lines(text: Column) -> Column:
    """Stripped, non-empty lines of a document, in order."""
    return F.filter(F.transform(F.split(text, LINE_END), strip), lambda line: line != "")
