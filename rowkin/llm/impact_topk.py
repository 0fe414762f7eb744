"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Components become whole numbers, ``floor(scale * x)``.  A posting is a (dimension, row, value); its
impact is quantised to the position of the value's highest bit, and the postings of a block of rows form
one segment per impact level.  A block of queries goes through the segments from the highest impact
down.  After each segment the part of a score still to come is bounded by
``|query| * |what is left of the row|``; a row is given up for a query only once its score so far plus
this bound is below the k-th best proven score.  When few rows are possible, or no segment is left,
the possible members are scored exactly in whole numbers.

Rows whose squares sum to ``LARGEST`` or more could round in this arithmetic.  They are scored against
all others in Python's whole numbers, after floating-point bounds have left few of them.

Rows and queries are cut into blocks of fixed size, and every pair of blocks is one group: what a task
holds is bounded whatever the size of the table.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowkin.scratch import store

SCALE = 256
ROW_BLOCK = 8192
QUERY_BLOCK = 2048
#: Below this sum of squares every product and sum is exact in a double.
LARGEST = 1 << 52
#: Queries that go through the segments together; bounds the score matrix at 4 MB.
STRIP = 64
#: Once so few rows per query are possible, they are scored exactly.
FEW = 64


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<bigint>, x array<double>): ``floor(scale * x)`` of a vector as ``v``, or, if its squares
    sum to ``LARGEST`` or more, divided by the scale as ``x``; the other one is null.

    Vectors that are null, empty or hold a null or non-finite component take no part, nor do those with a
    null id.  Different vectors of one id are all kept; equal ones count once.
    """
    c = F.col(vector_col).cast("array<double>")
    finite = F.forall(c, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.where(F.col(id_col).isNotNull() & (F.size(vector_col) > 0) & finite)
    small = F.aggregate(c, F.lit(0.0), lambda a, x: a + F.floor(x * scale).cast("double") * F.floor(x * scale)) < LARGEST
    v = F.transform(c, lambda x: F.floor(x * scale))
    # From 2^53 on a double has no fraction.
    x = F.transform(c, lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale) / F.lit(float(scale))).otherwise(x))
    return rows.select(F.col(id_col).alias("vec_id"), F.when(small, v).alias("v"), F.when(~small, x).alias("x")).distinct()


def _matrix(column: pa.ChunkedArray, width: int, kind: type = np.int64) -> np.ndarray:
    """Rows of numbers; shorter vectors are filled up with zeros."""
    lists = column.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
    out = np.zeros((len(lengths), width), kind)
    at = np.arange(width)[None, :] < lengths[:, None]
    out[at] = flat
    return out


class Segments:
    """The postings of a block of rows by impact level, highest first."""

    def __init__(self, rows: np.ndarray):
        size = np.abs(rows)
        level = np.where(size > 0, np.floor(np.log2(np.maximum(size, 1))).astype(np.int64), -1)
        self.parts = []
        left = (rows.astype(np.float64) ** 2).sum(axis=1)
        for at in sorted(set(np.unique(level)) - {-1}, reverse=True):
            part = np.where(level == at, rows, 0).astype(np.float64)
            left = np.maximum(left - (part**2).sum(axis=1), 0)
            # The root is raised a little so that rounding can only make the bound larger.
            self.parts.append((part, np.sqrt(left) * (1 + 1e-9) + 1e-6))


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
    """(query, row, score) positions of each query's k best rows of the block, its own id left out."""
    segments = Segments(rows)
    found_q, found_r, found_s = [], [], []
    for at in range(0, len(queries), STRIP):
        q = queries[at : at + STRIP]
        qf = q.astype(np.float64)
        norm = np.sqrt((qf**2).sum(axis=1)) * (1 + 1e-9)
        own = query_ids[at : at + STRIP, None] == row_ids[None, :]
        score = np.zeros((len(q), len(rows)))
        possible = ~own
        for n, (part, left) in enumerate(segments.parts):
            score += qf @ part.T
            if n + 1 == len(segments.parts):
                break
            bound = norm[:, None] * left[None, :]
            low = np.where(possible, score - bound, -np.inf)
            if low.shape[1] > k:
                proven = np.partition(low, low.shape[1] - k, axis=1)[:, -k]
                possible &= score + bound >= proven[:, None] - 1e-3
            if possible.sum() <= FEW * len(q):
                break
        who, which = np.nonzero(possible)
        exact = np.einsum("ij,ij->i", q[who], rows[which])
        order = np.lexsort((row_ids[which], -exact, who))
        who, which, exact = who[order], which[order], exact[order]
        first = np.searchsorted(who, np.arange(len(q)))
        rank = np.arange(len(who)) - first[who]
        take = rank < k
        found_q.append(who[take] + at)
        found_r.append(which[take])
        found_s.append(exact[take])
    if not found_q:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(found_q), np.concatenate(found_r), np.concatenate(found_s)


class Side:
    """Rows of ``quantised`` with their ids: whole numbers exactly, and as doubles between -1 and 1 times powers of two."""

    def __init__(self, rows: pa.Table, width: int, scale: int):
        self.ids, self.scale = rows["vec_id"].to_numpy(), scale
        self.large = ~rows["v"].is_valid().to_numpy()
        self.v = np.zeros((len(rows), width), np.int64)
        self.v[~self.large] = _matrix(rows["v"].filter(pa.array(~self.large)), width)
        self.x = {}
        real = self.v / scale
        if self.large.any():
            real[self.large] = _matrix(rows["x"].filter(pa.array(self.large)), width, np.float64)
            self.x = {n: real[n] for n in np.flatnonzero(self.large)}
        self.power = np.frexp(np.abs(real).max(axis=1))[1] if len(rows) else np.empty(0, np.int32)
        self.unit = np.ldexp(real, -self.power[:, None])
        self.norm = np.sqrt((self.unit**2).sum(axis=1))

    def whole(self, n: int) -> list[int]:
        if n not in self.x:
            return self.v[n].tolist()
        return [round(c * self.scale) if math.isfinite(c * self.scale) else int(c) * self.scale for c in self.x[n].tolist()]

    def without_copies(self, among: np.ndarray, most: int) -> np.ndarray:
        """``among``, but of equal rows only the ``most`` with the smallest ids."""
        seen, keep = Counter(), []
        for n in among[np.argsort(self.ids[among], kind="stable")]:
            key = self.x[n].tobytes() if n in self.x else self.v[n].tobytes()
            seen[n in self.x, key] += 1
            if seen[n in self.x, key] <= most:
                keep.append(n)
        return np.array(sorted(keep), np.int64)


def best_large(queries: Side, who: np.ndarray, rows: Side, which: np.ndarray, k: int):
    """As ``best``, of the chosen queries and rows of any size."""
    out = []
    if len(who) and len(which):
        which = rows.without_copies(which, k + 1)  # one of them may be the query's own
        share = np.ldexp(1.0, rows.power[which] - rows.power[which].max())
        error = (rows.unit.shape[1] + 8) * 2.0**-50
        whole = {}
        for at in range(0, len(who), STRIP):
            q = who[at : at + STRIP]
            score = (queries.unit[q] @ rows.unit[which].T) * share
            slack = error * queries.norm[q, None] * (rows.norm[which] * share)[None, :] + 1e-300
            possible = queries.ids[q, None] != rows.ids[None, which]
            low = np.where(possible, score - slack, -np.inf)
            if low.shape[1] > k:
                possible &= score + slack >= np.partition(low, low.shape[1] - k, axis=1)[:, -k][:, None]
            for n, some in zip(q, possible, strict=True):
                mine, found = queries.whole(n), []
                for r in which[some]:
                    if r not in whole:
                        whole[r] = rows.whole(r)
                    found.append((-sum(a * b for a, b in zip(mine, whole[r], strict=True)), rows.ids[r], r))
                out += [(n, r, -s) for s, _, r in sorted(found)[:k]]
    for n, r, s in out:
        if not -(1 << 63) <= s < 1 << 63:
            raise OverflowError(f"the score {s} of vectors {queries.ids[n]} and {rows.ids[r]} is no bigint")
    found_q, found_r, found_s = zip(*out, strict=True) if out else ((), (), ())
    return np.array(found_q, np.int64), np.array(found_r, np.int64), np.array(found_s, np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows of every query, ties to the smaller id.

    ``is_query`` is a condition on ``vec_id``.  A query with fewer candidates than k gets them all; an
    empty table gives no rows.  Different vectors of one query id are one query: its best pairs count.  A score
    that does not fit a bigint is an error.
    """
    saved = store(quantised(vectors, id_col, vector_col, scale), "impact-rows", queries=F.count(F.when(is_query, 1)), width=F.max(F.size(F.coalesce("x", F.col("v").cast("array<double>")))))
    row_blocks = max(1, -(-saved.rows // ROW_BLOCK))
    query_blocks = max(1, -(-saved.figures["queries"] // QUERY_BLOCK))
    width = saved.figures["width"] or 1

    def block(n: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = saved.table.select(block(row_blocks, 1).alias("rb"), every(query_blocks).alias("qb"), "vec_id", "v", "x")
    queries = saved.table.where(is_query).select(every(row_blocks).alias("rb"), block(query_blocks, 2).alias("qb"), "vec_id", "v", "x")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        large = left["v"].null_count or right["v"].null_count
        if not large:
            q, r = _matrix(left["v"], width), _matrix(right["v"], width)
            q_ids, r_ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            who, which, score = best(q, q_ids, r, r_ids, k)
            return pa.table({"query_id": q_ids[who], "vec_id": r_ids[which], "score": score})
        q, r = Side(left, width, scale), Side(right, width, scale)
        small_q, small_r = np.flatnonzero(~q.large), np.flatnonzero(~r.large)
        who, which, score = best(q.v[small_q], q.ids[small_q], r.v[small_r], r.ids[small_r], k)
        found = [
            (small_q[who], small_r[which], score),
            best_large(q, small_q, r, np.flatnonzero(r.large), k),
            best_large(q, np.flatnonzero(q.large), r, np.arange(len(r.ids)), k),
        ]
        who, which, score = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({"query_id": q.ids[who], "vec_id": r.ids[which], "score": score})

    kind = saved.table.schema["vec_id"].dataType.simpleString()
    part = (
        queries.groupBy("rb", "qb")
        .cogroup(rows.groupBy("rb", "qb"))
        .applyInArrow(run, f"query_id {kind}, vec_id {kind}, score bigint")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
