"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over the text finds anchors: at-signs, plus signs, scheme marks,
digits, and cues that announce an identifier.  At each anchor a small parser expands to the left and
right and validates what it has found; text without an anchor is never looked at again.  All parsers go
forward only, so a text costs time linear in its length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowkin.llm.rows import flat, parts, releasing

#: Kinds in the order of the result.  The first four are the base kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "address", "account", "secret")
MASKS = {kind: f"[{kind.upper()}]" for kind in KINDS}

#: Words that announce an account or identity number.
CUES = ("iban", "account", "acct", "ssn", "passport")
#: Words that announce a secret, and the least characters of one.
SECRETS = {"token": 16, "secret": 16, "key": 16, "password": 8, "passwd": 8}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE_RUN = re.compile(r"\+[0-9][\x20().0-9-]+")
_DIGIT_RUN = re.compile(r"[0-9]+")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_SCHEME = _LETTERS | _DIGITS | frozenset("+.-")
#: A network address with credentials: userinfo, then a host.
_AUTHORITY = re.compile(r"([A-Za-z0-9._~%!$&'*+,;=:-]+)@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)(:[0-9]{1,5})?(/[^\s<>\"']*)?")
_AFTER_CUE = re.compile(r"(?:[ ]?(?:number|no\.?|nr\.?|#))?[ ]?[:#=]?[ ]?", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9]){6,16}(?![0-9])")
#: An assignment, then the value up to a character that no secret holds; as values end before the next
#: assignment, no character belongs to two of them.
_SECRET = re.compile(r"[\"']?[ ]?(?::=|=>|=|:)[ ]?[\"']?([A-Za-z0-9_+/.~-]+={0,2})")
_PASSPORT = re.compile(r"[A-Z]{1,2}[0-9]{6,8}(?![A-Za-z0-9])")


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    anchors = {"@": "at", "+": "plus", "://": "scheme", **dict.fromkeys("0123456789", "digit")}
    for cue in (*CUES, *SECRETS):
        anchors |= dict.fromkeys((cue, cue.upper(), cue.capitalize()), cue)
    machine = ahocorasick.Automaton()
    for text, kind in anchors.items():
        machine.add_word(text, kind)
    machine.make_automaton()
    return machine


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _iban_valid(value: str) -> bool:
    plain = value.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _email(text: str, at: int, free: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``, not reaching before ``free``."""
    start = at
    while start > free and text[start - 1] in _LOCAL:
        start -= 1
    if start == at or not (domain := _DOMAIN.match(text, at + 1)):
        return None
    return start, domain.end()


def _scheme(text: str, end: int) -> int:
    """Where the scheme that ends at ``end`` starts: at the first letter of its run of scheme characters, else ``end``."""
    start = end
    while start and text[start - 1] in _SCHEME:
        start -= 1
    while start < end and text[start] not in _LETTERS:
        start += 1
    return start


def _account(text: str, cue: str, end: int) -> tuple[int, int] | None:
    """The validated identifier that follows a cue ending at ``end``."""
    at = _AFTER_CUE.match(text, end).end()
    if cue == "iban":
        # The longest prefix, by blocks, that has a valid check number.
        if m := _IBAN.match(text, at):
            for stop in range(m.end(), at + 14, -1):
                if text[stop - 1] != " " and _iban_valid(text[at:stop]):
                    return at, stop
        return None
    if cue == "ssn":
        m = _SSN.match(text, at)
        if m and text[at : at + 3] not in ("000", "666") and text[at] != "9" and text[at + 4 : at + 6] != "00" and text[at + 7 : at + 11] != "0000":
            return m.span()
        return None
    m = (_PASSPORT if cue == "passport" else _NUMBER).match(text, at)
    return m.span() if m else None


def _secret(text: str, cue: str, end: int) -> tuple[int, int] | None:
    """The value assigned behind a cue ending at ``end``, if it is long enough and mixes letters and digits, as no
    word does; marks that end a sentence are not part of it."""
    if not (m := _SECRET.match(text, end)):
        return None
    value = m[1].rstrip(".-")
    if len(value) < SECRETS[cue] or _DIGITS.isdisjoint(value) or _LETTERS.isdisjoint(value):
        return None
    return m.start(1), m.start(1) + len(value)


def find(text: str | None) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, end exclusive, by kind in the order of ``KINDS``, then start.

    Base kinds are the leftmost non-overlapping matches of their patterns; those that fail validation are
    dropped and not tried again.  ``address`` is a URL with credentials, ``account`` an identifier behind a
    cue, ``secret`` a token, key or password assigned behind a cue.  Kinds may overlap each other.  A null or empty text has none.
    """
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if not text:
        return []
    email_free = phone_free = 0
    run_end = ip_free = card_free = 0  # behind the last digit run, IP match and card match
    for last, anchor in _automaton().iter(text):
        if anchor == "digit":
            if last < run_end:
                continue
            run_end = _DIGIT_RUN.match(text, last).end()
            if last >= ip_free and (m := _IP.match(text, last)):
                ip_free = m.end()
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                    found["ip"].append(m.span())
            if last >= card_free and (m := _CARD.match(text, last)):
                card_free = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append(m.span())
        elif anchor == "at":
            if span := _email(text, last, email_free):
                found["email"].append(span)
                email_free = span[1]
        elif anchor == "plus":
            if last >= phone_free and (m := _PHONE_RUN.match(text, last)):
                end = m.end()
                while text[end - 1] not in _DIGITS:
                    end -= 1
                if end - last >= 4:
                    phone_free = end
                    if 8 <= sum(c in _DIGITS for c in text[last:end]) <= 15:
                        found["phone"].append((last, end))
        elif anchor == "scheme":
            start = _scheme(text, last - 2)
            if start < last - 2 and (m := _AUTHORITY.match(text, last + 1)):
                if not found["address"] or start >= found["address"][-1][1]:
                    found["address"].append((start, m.end()))
        elif anchor in SECRETS:
            if (span := _secret(text, anchor, last + 1)) and (not found["secret"] or span[0] >= found["secret"][-1][1]):
                found["secret"].append(span)
        elif (span := _account(text, anchor, last + 1)) and (not found["account"] or span[0] >= found["account"][-1][1]):
            found["account"].append(span)
    return [(kind, *span) for kind in KINDS for span in found[kind]]


def spelled(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind's mask; overlapping spans become one, under the mask
    of the first."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], MASKS[kind]]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _judged(docs: DataFrame, text_col: str, with_masked: bool, keep: list[str]) -> DataFrame:
    """``_0``, ``_1``, ... (the columns ``keep`` of every row) and the findings; the masked text, if any, stands in the text's place."""
    rows, at = flat(docs, text_col)
    places = [docs.columns.index(c) for c in keep]
    text_at = keep.index(text_col) if with_masked else None
    schema = T.StructType()
    for k, place in enumerate(places):
        schema.add(f"_{k}", "string" if k == text_at else rows.schema[place].dataType)
    for kind in KINDS:
        schema.add(f"n_{kind}", "long")
    schema.add("n_spans", "long").add("base_sha256", "string").add("spans", "string")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            counts: list[list[int]] = [[] for _ in KINDS]
            totals, digests, every, texts = [], [], [], []
            for value in batch.column(at):
                text = value.as_py()
                spans = find(text)
                for k, kind in enumerate(KINDS):
                    counts[k].append(sum(s[0] == kind for s in spans))
                totals.append(len(spans))
                digests.append(hashlib.sha256(spelled([s for s in spans if s[0] in BASE_KINDS]).encode()).hexdigest())
                every.append(spelled(spans))
                if with_masked:
                    texts.append(masked(text, spans) if spans else text)
            columns = [pa.array(texts, pa.string()) if k == text_at else batch.column(place) for k, place in enumerate(places)]
            columns += [*(pa.array(c, pa.int64()) for c in (*counts, totals)), pa.array(digests, pa.string()), pa.array(every, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(releasing(run), schema)


def detected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id of every row with its counts by kind and in all (``n_spans``), ``base_sha256`` (of the spans
    of the base kinds) and ``spans``.

    Every row is judged on its own, so there is no shuffle; repeated rows and ties need no rule.  Columns
    other than the id and the text are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t"))
    out = _judged(rows, "_t", False, ["_id"])
    return out.select(F.col("_0").alias(id_col), *out.columns[1:])


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind's mask; null texts stay null."""
    out = _judged(docs, text_col, True, docs.columns)
    return out.select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(docs.columns)])
