"""Edit-distance similarity of two strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance over code points."""
    return F.levenshtein(a, b)


def similarity_ratio(a: Column, b: Column) -> Column:
    """``1 - distance / longer length``; two empty strings are equal, one empty matches nothing."""
    longest = F.greatest(F.length(a), F.length(b))
    return (
        F.when((a == "") & (b == ""), F.lit(1.0))
        .when((a == "") | (b == ""), F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), _ratio(F.levenshtein(a, b), longest)))
    )


def _ratio(distance: Column, longest: Column) -> Column:
    return F.lit(1.0) - distance.cast("double") / longest.cast("double")


def max_edits(longest: Column, theta: Column) -> Column:
    """Largest distance d with ``1.0 - d / longest >= theta`` in double arithmetic.

    The estimate is off by at most one through rounding, so its two neighbours are tested with the
    very expression that decides a match.
    """
    guess = F.floor(longest * (F.lit(1.0) - theta)).cast("int")
    fits = lambda d: _ratio(d, longest) >= theta
    return F.when(fits(guess + 1), guess + 1).when(fits(guess), guess).otherwise(guess - 1)


def bounded_distance(a: Column, b: Column, theta: Column) -> Column:
    """Edit distance of two non-empty strings if their similarity reaches ``theta``, else -1.

    The bounded edit distance gives up as soon as the bound is passed.
    """
    limit = max_edits(F.greatest(F.length(a), F.length(b)), theta)
    return F.call_function("levenshtein", a, b, limit)


def ratio_of(distance: Column, a: Column, b: Column) -> Column:
    """Similarity of two non-empty strings with a known distance."""
    return _ratio(distance, F.greatest(F.length(a), F.length(b)))


def letter_marks(text: Column) -> Column:
    """64 bits that say which of 32 classes of characters a text has, and which it has twice or more."""

    def marked(seen: Column, letter: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.ascii(letter) % 32)
        return F.struct(
            seen["once"].bitwiseOR(bit).alias("once"), seen["twice"].bitwiseOR(seen["once"].bitwiseAND(bit)).alias("twice")
        )

    none = F.lit(0).cast("bigint")
    return F.aggregate(
        F.split(text, ""), F.struct(none.alias("once"), none.alias("twice")), marked,
        lambda seen: seen["once"].bitwiseOR(F.shiftleft(seen["twice"], 32)),
    )


def least_edits(marks_a: Column, marks_b: Column) -> Column:
    """No fewer edits than this turn one text into the other: an edit makes up for one mark on either side."""
    lacks = lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b)))
    return F.greatest(lacks(marks_a, marks_b), lacks(marks_b, marks_a))
