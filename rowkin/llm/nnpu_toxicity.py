"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; a draw from all training texts is unlabelled.  A linear classifier
over hashed character n-grams of words is fitted in numpy with the class-prior-corrected risk

    prior * R_p(+)  +  max(0, R_u(-) - prior * R_p(-))

where R_p and R_u are mean logistic losses over positives and unlabelled texts.  When the second term of
a step is negative, the step goes back up that term alone, which keeps the fit from memorising the
unlabelled texts.

The fit takes a bounded sample (``MOST_POSITIVE`` and ``MOST_UNLABELLED`` texts, chosen by digest of the
id, so reruns agree).  Features are made inside the tasks, one text at a time; scoring reads every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowkin.llm.rank_language import _BLANK, CHUNK, _codes

#: Bounds of the fitting sample, in texts.
MOST_POSITIVE = 2000
MOST_UNLABELLED = 5000
#: ... and in characters of either side: a text that begins beyond them is left out.
MOST_CHARS = 100_000_000
#: Features: character n-grams of these lengths inside a blank-padded word, hashed to 2**HASH_BITS places.
GRAMS = (4, 5)
HASH_BITS = 30
#: A feature must occur in so many sample texts to get a weight.
LEAST_TEXTS = 5
#: Weighted features: at most so many, each so many standard errors apart between positives and all texts.
MOST_FEATURES = 4096
LEAST_APART = 5.0
#: ... and in at least this share of the positives, as a few near copies prove nothing ...
LEAST_SHARE = 0.02
#: ... and at least so many times as frequent in positives as in unlabelled texts.
LEAST_LIFT = 4.0
STEPS = 400
RATE = 0.05
DECAY = 1e-5
#: Going back up the negative part: by this share of the step.
BACK = 1.0
THRESHOLD = 0.5
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def text_features(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of a text; empty for a null or letterless one."""
    if not text:
        return np.empty(0, np.int64)
    codes = _codes(text)
    found = []
    for at in range(0, len(codes), CHUNK):
        piece = codes[at : at + CHUNK + max(GRAMS) - 1]
        blank = piece == _BLANK
        for n in GRAMS:
            count = len(piece) - n + 1
            if count <= 0:
                continue
            mixed = np.full(count, n, np.uint64)
            inside = np.ones(count, bool)
            for k in range(n):
                mixed = (mixed ^ piece[k : k + count]) * _MULTIPLIERS[k]
                mixed ^= mixed >> np.uint64(29)
                if 0 < k < n - 1:
                    inside &= ~blank[k : k + count]
            found.append((mixed[inside] >> np.uint64(64 - HASH_BITS)).astype(np.int64))
        if len(found) > 64:
            found = [np.unique(np.concatenate(found))]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def _make_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [text_features(t.as_py()).astype("<i4").tobytes() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["positive", "features"])


@dataclass(frozen=True)
class Model:
    keys: np.ndarray  # feature numbers in order
    weights: np.ndarray
    bias: float

    def score(self, features: np.ndarray) -> float:
        z = self.bias
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, features), len(self.keys) - 1)
            z += float(self.weights[at[self.keys[at] == features]].sum())
        return float(1.0 / (1.0 + np.exp(-min(max(z, -60.0), 60.0))))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def _distinct(lists: list[np.ndarray]) -> list[np.ndarray]:
    return list({x.tobytes(): x for x in lists}.values())


def fit(positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
        steps: int = STEPS, rate: float = RATE) -> Model:
    """Fit the classifier from feature lists.

    Without positives, or without unlabelled texts, nothing can be told apart: every text gets ``prior``.
    """
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    if not positives or not unlabelled:
        return Model(np.empty(0, np.int64), np.empty(0), float(np.log(prior / (1 - prior))))
    # Copies say the same thing once; else what a group of them shares would look like a sign.
    positives, unlabelled = _distinct(positives), _distinct(unlabelled)
    n, total = len(positives), len(positives) + len(unlabelled)
    every, texts = np.unique(np.concatenate([*positives, *unlabelled]), return_counts=True)
    seen = np.bincount(np.searchsorted(every, np.concatenate(positives)), minlength=len(every))
    # How far a feature's share among the positives is above its share overall, in standard errors.
    share = texts / total
    apart = (seen / n - share) / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n - 1 / total + 1e-12))
    # Features of a language or topic that toxic texts merely favour are a little, not many times, as frequent.
    usable = (texts >= LEAST_TEXTS) & (seen >= LEAST_SHARE * n) & (apart >= LEAST_APART) & (seen / n >= LEAST_LIFT * (texts - seen) / len(unlabelled))
    strongest = np.flatnonzero(usable)
    strongest = np.sort(strongest[np.argsort(-apart[strongest], kind="stable")[:MOST_FEATURES]])
    keys = every[strongest]
    width = len(keys)

    def rows(lists):
        cut = [np.searchsorted(keys, x[np.isin(x, keys, assume_unique=True)]) for x in lists]
        lengths = np.array([len(x) for x in cut])
        return np.concatenate(cut).astype(np.int64), np.repeat(np.arange(len(cut)), lengths), len(cut)

    pos, unl = rows(positives), rows(unlabelled)
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros(width), np.zeros(width), 0.0, 0.0

    def margins(data):
        columns, owner, n = data
        return np.bincount(owner, w[columns], n) + b

    def gradient(data, per_text):
        columns, owner, n = data
        return np.bincount(columns, per_text[owner], width) / n, per_text.sum() / n

    for step in range(1, steps + 1):
        zp, zu = margins(pos), margins(unl)
        sp, su = _sigmoid(zp), _sigmoid(zu)
        # Logistic loss of calling a text negative is log(1 + e**z), with slope sigmoid(z).
        negative_part = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gu, gub = gradient(unl, su)
        gp, gpb = gradient(pos, sp)
        if negative_part >= 0:
            gq, gqb = gradient(pos, sp - 1)
            g, gb = prior * gq + gu - prior * gp, prior * gqb + gub - prior * gpb
        else:
            g, gb = -BACK * (gu - prior * gp), -BACK * (gub - prior * gpb)
        g = g + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**step, 1 - 0.999**step
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return Model(keys, w, float(b))


def _sample(rows: DataFrame, most: int, total: int) -> DataFrame:
    """About ``most`` of ``total`` ids by their digest, and never more than ``most``."""
    if total <= most:
        return rows
    share = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("double") / F.lit(float(16**8))
    return rows.where(share < most / total).orderBy(F.md5(F.col("id").cast("string")), "id").limit(most)


def _bounded_texts(rows: DataFrame) -> DataFrame:
    """Of (positive, text) every text once a side, as far as the bounds allow, by digest: an id may repeat any number of
    times, and texts have any length.  What is chosen is decided on digests and lengths; the texts are joined to that."""
    named = rows.withColumn("digest", F.md5(F.coalesce("text", F.lit(""))))
    narrow = named.select("positive", "digest", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("size")).distinct()
    few = None
    for flag, most in ((True, MOST_POSITIVE), (False, MOST_UNLABELLED)):
        side = narrow.where(F.col("positive") == flag).orderBy("digest").limit(most)
        few = side if few is None else few.unionByName(side)
    # At most MOST_POSITIVE + MOST_UNLABELLED rows of some 60 bytes: one window task, and safe to broadcast.
    before = Window.partitionBy("positive").orderBy("digest").rowsBetween(Window.unboundedPreceding, -1)
    chosen = few.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).where(F.col("before") < MOST_CHARS)
    texts = named.join(F.broadcast(chosen.select("positive", "digest")), ["positive", "digest"])
    return texts.dropDuplicates(["positive", "digest"]).select("positive", "text")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", allowed: Column | None = None) -> Model:
    """Fit on the documents joined with ``labels`` (id, label: 1 toxic) where ``allowed`` holds.

    The class prior is the toxic share of the labelled rows; labels that are null do not count.  An id with
    several labels is toxic if one of them says so.
    """
    told = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
    if allowed is not None:
        told = told.where(allowed)
    told = told.groupBy("id").agg(F.max("y").alias("y"))
    stats = told.agg(
        F.count(F.when(F.col("y") == 1, 1)).alias("p"), F.count("y").alias("n"), F.count(F.lit(1)).alias("rows")
    ).first()
    if not stats["n"]:
        return fit([], [], 0.5)
    positive = _sample(told.where("y = 1").select("id"), MOST_POSITIVE, stats["p"])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if allowed is not None:
        texts = texts.where(allowed)
    # Unlabelled texts stand for all texts, so they are drawn without a look at any label.
    unlabelled = _sample(texts.select("id"), MOST_UNLABELLED, texts.count())
    chosen = positive.withColumn("positive", F.lit(True)).unionByName(unlabelled.distinct().withColumn("positive", F.lit(False)))
    # At most MOST_POSITIVE + MOST_UNLABELLED ids of 8 bytes and a flag: safe to broadcast.
    rows = _bounded_texts(texts.join(F.broadcast(chosen), "id").select("positive", "text"))
    made = rows.mapInArrow(_make_features, "positive boolean, features binary").collect()
    lists: dict[bool, list[np.ndarray]] = {True: [], False: []}
    for flag, data in made:
        lists[flag].append(np.frombuffer(data, "<i4"))
    for flag in lists:  # the order of rows depends on the partitions
        lists[flag].sort(key=lambda x: x.tobytes())
    return fit(lists[True], lists[False], stats["p"] / stats["n"])


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``score`` (0 to 1) of every row; an empty or null text gets the score of no features.

    Repeated rows are scored each on its own; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(text_features(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, rows.select("id").schema.add("score", "double"))
    return out.select(F.col("id").alias(id_col), "score")
