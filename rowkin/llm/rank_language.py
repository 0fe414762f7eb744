"""Language identification by rank-order profiles.

A profile is the list of the most frequent character n-grams (one to three letters, words padded with
one blank) in order.  The distance of a text to a language is the out-of-place sum: for each n-gram of
the text's own profile, by how many ranks it is displaced in the language's profile; n-grams that the
language lacks count as the longest displacement.  The nearest language wins.

Counting runs in numpy inside the tasks, one document at a time; n-grams are exact (three code points in
one 64-bit number), nothing is hashed.  Profiles come from counts over all training rows; only
``PROFILE`` rows per language reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowkin.llm.rows import flat, parts, plain_reads, releasing

PROFILE = 300
#: More languages than this are refused: what is sent to every task is MOST_LANGUAGES * PROFILE pairs at most.
MOST_LANGUAGES = 1000
UNKNOWN = "und"
#: Characters that are counted at a time.
CHUNK = 1 << 20
#: N-grams of texts that a task holds before it sums them: 4 MB with their counts.
HELD = 1 << 18
_BITS = 21
_BLANK = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    """Lower-cased code points, all but letters blank, runs of blanks reduced to one, blank at both ends."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes[~_letters()[codes.astype(np.int64)]] = _BLANK
    blank = codes == _BLANK
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return codes[keep]


def _grams(codes: np.ndarray) -> np.ndarray:
    """One to three code points packed into one number; none spans two words or is a lone blank."""
    blank = codes == _BLANK
    one = codes[~blank]
    two = (codes[:-1] << np.uint64(_BITS)) | codes[1:]
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    three = (((a << np.uint64(_BITS)) | b) << np.uint64(_BITS)) | c
    return np.concatenate([one, two, three[~blank[1:-1]]])


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text with their counts; long texts are counted piece by piece."""
    if not text:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    codes = _codes(text)
    if not (codes != _BLANK).any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(codes) <= CHUNK:
        return np.unique(_grams(codes), return_counts=True)
    keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    for at in range(0, len(codes), CHUNK):
        piece = codes[at : at + CHUNK]
        tail = codes[max(0, at - 2) : at + CHUNK]
        grams = [piece[piece != _BLANK]]
        two = tail[1:] if at else tail
        grams.append((two[:-1] << np.uint64(_BITS)) | two[1:])
        a, b, c = tail[:-2], tail[1:-1], tail[2:]
        grams.append(((((a << np.uint64(_BITS)) | b) << np.uint64(_BITS)) | c)[b != _BLANK])
        k, n = np.unique(np.concatenate(grams), return_counts=True)
        merged, where = np.unique(np.concatenate([keys, k]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([counts, n])).astype(np.int64)
        keys = merged
    return keys, counts


def ranked(keys: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams in order, ties by code."""
    order = np.lexsort((keys, -counts))[:most]
    return keys[order]


_COUNTED = "lang string, gram long, n long"


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([n for _, n in held])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_lang: dict[str, list] = {}
        held, most = 0, HELD
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            keys, counts = gram_counts(text.as_py())
            if len(keys):
                by_lang.setdefault(lang, []).append((keys, counts))
                held += len(keys)
            if held >= most:
                by_lang = {lang: [_summed(parts)] for lang, parts in by_lang.items()}
                held = sum(len(parts[0][0]) for parts in by_lang.values())
                most = max(HELD, 2 * held)
        for lang, parts in by_lang.items():
            keys, counts = _summed(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]).take(pa.array(np.zeros(len(keys), np.int64))), pa.array(keys.astype(np.int64)), pa.array(counts)],
                names=["lang", "gram", "n"],
            )


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = PROFILE) -> dict[str, list[int]]:
    """Profiles by language from all rows of ``docs`` that have a language.

    The counts of a task's batch are summed before they are sent, and again by Spark, so a language with
    most of the rows costs one row per n-gram and batch.  Only the ``most`` first rows of a language are kept.
    """
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = rows.mapInArrow(releasing(_count), _COUNTED).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    with plain_reads(docs.sparkSession):
        found = top.orderBy("lang", "rank").limit(MOST_LANGUAGES * most + 1).collect()
    if len(found) > MOST_LANGUAGES * most:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    profiles: dict[str, list[int]] = {}
    for row in found:
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


def _table(profiles: dict[str, list[int]], most: int):
    """Languages in order, all n-grams of all profiles sorted, and the rank of each in each language."""
    langs = sorted(profiles)
    grams = np.unique(np.array([g for p in profiles.values() for g in p], np.uint64))
    ranks = np.full((len(langs), len(grams) + 1), -1, np.int64)
    for k, lang in enumerate(langs):
        ranks[k, np.searchsorted(grams, np.array(profiles[lang], np.uint64))] = np.arange(len(profiles[lang]))
    return langs, grams, ranks


def nearest(own: np.ndarray, langs: list[str], grams: np.ndarray, ranks: np.ndarray, most: int) -> tuple[str, float]:
    """The nearest language (ties: the first by name) and 1 - distance / largest possible distance."""
    if not len(own) or not langs:
        return UNKNOWN, 0.0
    at = np.searchsorted(grams, own)
    at[(at == len(grams)) | (grams[np.minimum(at, len(grams) - 1)] != own)] = len(grams)
    theirs = ranks[:, at]
    moved = np.where(theirs < 0, most, np.minimum(np.abs(theirs - np.arange(len(own))), most)).sum(axis=1)
    best = int(moved.argmin())
    return langs[best], float(1.0 - moved[best] / (most * len(own)))


def _judged(docs: DataFrame, profiles: dict[str, list[int]], text_col: str, most: int, keep: list[str]) -> DataFrame:
    """``_0``, ``_1``, ... (the columns ``keep`` of every row), ``lang_pred`` and ``score``."""
    langs, grams, ranks = _table(profiles, most)
    rows, at = flat(docs, text_col)
    places = [docs.columns.index(c) for c in keep]
    schema = rows.select(*[f"_{k}" for k in places]).toDF(*[f"_{k}" for k in range(len(keep))]).schema.add("lang_pred", "string").add("score", "double")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = [nearest(ranked(*gram_counts(t.as_py()), most), langs, grams, ranks, most) for t in batch.column(at)]
            columns = [batch.column(k) for k in places]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=names)

    return rows.mapInArrow(releasing(run), schema)


def identified(docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text", most: int = PROFILE) -> DataFrame:
    """``_row`` (all columns of the row), ``lang_pred`` and ``score`` of every row."""
    out = _judged(docs, profiles, text_col, most, docs.columns)
    return out.select(F.struct(*[F.col(f"_{k}").alias(c) for k, c in enumerate(docs.columns)]).alias("_row"), "lang_pred", "score")


def identify(docs: DataFrame, profiles: dict[str, list[int]], id_col: str = "doc_id", text_col: str = "text",
             most: int = PROFILE) -> DataFrame:
    """The id, ``lang_pred`` and ``score`` of every row.

    ``und`` with score 0 where the text is null or has no letter, or if nothing was learned.  Whole texts
    are counted; repeated rows are judged each on its own.  Other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t"))
    return _judged(rows, profiles, "_t", most, ["_id"]).select(F.col("_0").alias(id_col), "lang_pred", "score")
