"""Nearest neighbours by cosine with multi-index hashing.

1. **Learned codes.**  A bounded sample gives the mean direction and a rotation of the unit vectors for which
   their signs lose least (iterative quantisation); a vector's code is its ``BITS`` signs.  Wider vectors are
   first projected onto their principal directions, for narrower ones several rotations are put side by side.
2. **Learned radius.**  Among the sample itself the true neighbours are known; the radius is the Hamming
   distance that ``COVERAGE`` of them do not exceed.  In the whole table neighbours are nearer than in a
   sample of it, so the share found there is no smaller.
3. **Index.**  Every vector is indexed.  Codes are cut into ``PARTS`` substrings, and each substring has a
   directory of its values with the rows that hold them.
4. **Pigeonhole probing.**  If two codes differ in at most r bits, and the parts' own radii sum to
   r - parts + 1, some part is within its own radius.  So probing every directory within its part's radius
   meets every code within r; those that differ in more are left out by counting bits.  A directory is
   probed by flipping bits or, when it has fewer values than that would try, walked once.
5. **Reranking.**  All rows left, without any limit, are compared on the original vectors in double precision.

Rows and queries are cut into blocks by a hash; every pair of blocks is one group, so a task's memory is
bounded and no vector, however often it occurs, makes a group larger.  In a block, rows of one vector are
represented by the few that can be among the k nearest.
"""

from __future__ import annotations

from copy import copy
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowkin.scratch import store

BITS = 64
PARTS = 4
#: Vectors that the rotation and the radius are learned from, and a bound on their components together.
SAMPLE = 6_000
SAMPLE_COMPONENTS = 1 << 22
#: Share of the sample's true neighbours that the radius has to cover.
COVERAGE = 0.97
TURNS = 25
#: Rows and queries of a block, and a bound on the components of either.
ROW_BLOCK = 1 << 13
QUERY_BLOCK = 1 << 16
BLOCK_COMPONENTS = 1 << 22


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors that are not null or zero and whose components are finite numbers."""
    c = F.col(vector_col).cast("array<double>")
    finite = F.forall(c, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.where(finite & F.exists(c, lambda x: x != 0))
    # Single precision widens to double without loss, so such vectors travel as they are.
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    return rows.select(F.col(id_col).alias("vec_id"), (F.col(vector_col) if single else c).alias("v"))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def lengths(rows: np.ndarray) -> np.ndarray:
    """Lengths of vectors whose largest component is 1 in size."""
    return np.sqrt(np.einsum("ij,ij->i", rows, rows))


def scaled(rows: np.ndarray) -> np.ndarray:
    """Vectors divided by the power of two next to their largest component: no square overflows or vanishes."""
    if not len(rows):
        return rows
    power = np.frexp(np.abs(rows).max(axis=1))[1]
    # In two steps, as a single factor may itself be no double.
    half = power // 2
    return np.ldexp(np.ldexp(rows, -half[:, None]), -(power - half)[:, None])


class Codes:
    """Signs of rotated unit vectors, and the radius within which neighbours are looked for."""

    def __init__(self, sample: np.ndarray, k: int = 5, bits: int = BITS, parts: int = PARTS, coverage: float = COVERAGE):
        self.bits, self.parts = bits, parts
        width = sample.shape[1]
        unit = np.unique(self._unit(sample), axis=0) if len(sample) else np.zeros((0, width))
        self.mean = unit.mean(axis=0) if len(unit) else np.zeros(width)
        centred = unit - self.mean
        rng = np.random.default_rng(0)
        base = np.eye(width)
        if width > bits:
            base = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :bits]
        turns = [self._rotation(centred @ base, rng) for _ in range(-(-bits // base.shape[1]))]
        self.rotation = np.concatenate([base @ turn for turn in turns], axis=1)[:, :bits]
        self.radius = self._radius(unit, k, coverage)
        # The parts' radii sum to radius - parts + 1; a negative one is never within reach.
        whole, more = divmod(self.radius - parts + 1, parts)
        self.part_radius = [whole + (j < more) for j in range(parts)]

    @staticmethod
    def _unit(rows: np.ndarray) -> np.ndarray:
        rows = scaled(rows)
        return rows / lengths(rows)[:, None] if len(rows) else rows

    @staticmethod
    def _rotation(rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        turn = np.linalg.qr(rng.normal(size=(rows.shape[1],) * 2))[0]
        for _ in range(TURNS if len(rows) else 0):
            signs = np.where(rows @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(signs.T @ rows)
            turn = (left @ right).T
        return turn

    def _radius(self, unit: np.ndarray, k: int, coverage: float) -> int:
        if len(unit) < 2:
            return self.bits
        codes, far = self._signs(unit), []
        for at in range(0, len(unit), 512):
            near = unit[at : at + 512] @ unit.T
            near[np.arange(len(near)), at + np.arange(len(near))] = -np.inf
            best = np.argpartition(-near, min(k, near.shape[1] - 1) - 1, axis=1)[:, : min(k, near.shape[1] - 1)]
            far.append(np.bitwise_count(codes[at : at + 512, None] ^ codes[best]).ravel())
        return int(np.quantile(np.concatenate(far), coverage, method="higher"))

    def _signs(self, unit: np.ndarray) -> np.ndarray:
        signs = ((unit - self.mean) @ self.rotation >= 0).astype(np.uint8)
        packed = np.zeros((len(unit), 8), np.uint8)
        packed[:, : -(-self.bits // 8)] = np.packbits(signs, axis=1, bitorder="little")
        return packed.view("<u8").ravel()

    def reaching_all(self) -> Codes:
        """The same codes with a radius that no two of them exceed."""
        wide = copy(self)
        wide.radius, wide.part_radius = self.bits, [self.bits] * self.parts
        return wide

    def of(self, rows: np.ndarray) -> np.ndarray:
        return self._signs(self._unit(rows))

    def substrings(self, codes: np.ndarray) -> list[np.ndarray]:
        """A code's parts, as small whole numbers."""
        wide = self.bits // self.parts
        ends = [j * wide for j in range(self.parts)] + [self.bits]
        return [((codes >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)).astype(np.int64) for a, b in zip(ends, ends[1:], strict=False)]

    def flips(self, part: int, most: int) -> np.ndarray | None:
        """All masks of up to the part's radius of bits, or None if these are more than ``most``."""
        wide = self.bits // self.parts if part < self.parts - 1 else self.bits - (self.parts - 1) * (self.bits // self.parts)
        masks = [0]
        for n in range(1, min(self.part_radius[part], wide) + 1):
            for chosen in combinations(range(wide), n):
                if len(masks) >= most:
                    return None
                masks.append(sum(1 << b for b in chosen))
        return np.array(masks, np.int64)


class Index:
    """The directories of a block's codes, one for each part."""

    def __init__(self, codes: np.ndarray, learned: Codes):
        self.codes, self.learned = codes, learned
        self.directories = []
        for j, keys in enumerate(learned.substrings(codes)):
            order = np.argsort(keys, kind="stable")
            values, first = np.unique(keys[order], return_index=True)
            flips = learned.flips(j, len(values)) if learned.part_radius[j] >= 0 else np.empty(0, np.int64)
            self.directories.append((values, np.append(first, len(keys)), order, flips))

    def within(self, code: np.uint64, parts: list[int]) -> np.ndarray:
        """Rows whose codes differ from ``code`` in at most the radius."""
        met = np.zeros(len(self.codes), bool)
        for j, (values, first, order, flips) in enumerate(self.directories):
            if flips is None:
                hit = np.flatnonzero(np.bitwise_count(values ^ parts[j]) <= self.learned.part_radius[j])
            else:
                tried = flips ^ parts[j]
                hit = np.searchsorted(values, tried)
                hit = hit[(hit < len(values)) & (values[np.minimum(hit, len(values) - 1)] == tried)]
            starts, sizes = first[hit], first[hit + 1] - first[hit]
            # The rows of all buckets hit, as one list of places.
            steps = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
            met[order[steps + np.arange(len(steps))]] = True
        rows = np.flatnonzero(met)
        return rows[np.bitwise_count(self.codes[rows] ^ code) <= self.learned.radius]


def _representatives(rows: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among the k nearest: of equal vectors the first ``k + 1`` ids, ``k`` rows of each."""
    kinds = np.unique(np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * 8))).ravel(), return_inverse=True)[1]
    order = np.lexsort((ids, ~known, kinds))
    kind, name, there = kinds[order], ids[order], known[order]
    new_kind = np.diff(kind, prepend=-1) != 0
    new_id = new_kind | np.concatenate(([True], (name[1:] != name[:-1]) | (there[1:] != there[:-1])))
    nth_id = np.cumsum(new_id)
    nth_id -= nth_id[np.flatnonzero(new_kind)][np.cumsum(new_kind) - 1]
    place = np.arange(len(order))
    nth_row = place - place[np.flatnonzero(new_id)][np.cumsum(new_id) - 1]
    return np.sort(order[(nth_id <= k) & (nth_row < k)])


def searched(queries: pa.Table, rows: pa.Table, learned: Codes, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score): the k best rows of a block found for each of a block's queries, by position."""
    v, q = matrix(rows["v"], width) + 0.0, matrix(queries["v"], width) + 0.0
    known = rows["vec_id"].is_valid().to_numpy()
    ids = rows["vec_id"].fill_null(0).to_numpy()
    kept = _representatives(v, ids, known, k)
    v, ids, known = scaled(v[kept]), ids[kept], known[kept]
    q = scaled(q)
    size, index = lengths(v), Index(learned.of(v), learned)
    codes = learned.of(q)
    parts = np.stack(learned.substrings(codes), axis=1)
    out = []
    names, norms = queries["vec_id"].to_numpy(), lengths(q)
    for n in range(len(q)):
        near = index.within(codes[n], parts[n])
        near = near[~known[near] | (ids[near] != names[n])]
        if not len(near):
            continue
        score = np.einsum("ij,j->i", v[near], q[n]) / (size[near] * norms[n])
        if len(near) > 8 * k:
            least = np.partition(score, len(near) - k)[len(near) - k]
            near, score = near[score >= least], score[score >= least]
        best = np.lexsort((ids[near], ~known[near], -score))[:k]
        out.append((np.full(len(best), n), kept[near[best]], score[best]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def learn(stored: DataFrame, rows: int, width: int, k: int = 5, sample: int = SAMPLE, **settings) -> Codes:
    """Codes fitted on a sample of at most ``sample`` vectors, and of at most ``SAMPLE_COMPONENTS`` components, drawn by a hash."""
    wanted = max(2, min(sample, SAMPLE_COMPONENTS // max(width, 1)))
    share = min(1.0, 1.2 * wanted / max(rows, 1))
    drawn = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)) <= int(share * (1 << 30))
    taken = stored.where(drawn).select("v").limit(wanted).toArrow()
    return Codes(matrix(taken["v"], width), k, **settings)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", **settings
) -> DataFrame:
    """(query_id, rank, vec_id, score): of every query the k nearest rows found, by cosine, ties to the smaller id.

    ``is_query`` is a condition on ``vec_id``.  Vectors that are null, empty, zero or hold a null or non-finite
    component take no part; shorter ones count as filled up with zeros.  Rows with a null id are no queries and
    come last among ties.  A query never finds rows of its own id; repeated rows are found each.  Fewer
    candidates than k are all returned, whatever the radius: a query that found too few is compared with all.
    Several vectors under one query id are one query, each pair of rows counting.  An empty table gives no rows.
    """
    saved = store(
        usable(vectors, id_col, vector_col), "hashed-rows", queries=F.count(F.when(is_query, 1)), width=F.max(F.size("v"))
    )
    width = saved.figures["width"] or 1
    learned = learn(saved.table, saved.rows, width, k, **settings)
    most = max(1, BLOCK_COMPONENTS // width)
    row_blocks = max(1, -(-saved.rows // min(ROW_BLOCK, most)))
    query_blocks = max(1, -(-saved.figures["queries"] // min(QUERY_BLOCK, most)))
    kind = saved.table.schema["vec_id"].dataType.simpleString()

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(n: int) -> Column:
        # Rows of one id, or of one vector, are dealt as evenly as all others.
        return F.pmod(F.xxhash64("at"), F.lit(n)).cast("int")

    numbered = saved.table.withColumn("at", F.monotonically_increasing_id())
    asked = saved.table.where(is_query).withColumn("at", F.monotonically_increasing_id())

    def grid(query_rows: DataFrame, codes: Codes) -> DataFrame:
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            who, which, score = searched(left, right, codes, width, k)
            return pa.table({"query_id": left["vec_id"].take(pa.array(who)), "vec_id": right["vec_id"].take(pa.array(which)), "score": score})

        rows = numbered.select(dealt(row_blocks).alias("rb"), every(query_blocks).alias("qb"), "vec_id", "v")
        queries = query_rows.select(every(row_blocks).alias("rb"), dealt(query_blocks).alias("qb"), "vec_id", "v")
        return (
            queries.groupBy("rb", "qb").cogroup(rows.groupBy("rb", "qb"))
            .applyInArrow(run, f"query_id {kind}, vec_id {kind}, score double")
        )

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)

    first = store(ranked(grid(asked, learned)), "hashed-found")
    columns = ("query_id", "rank", "vec_id", "score")
    full = first.table.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = store(asked.join(full, "vec_id", "left_anti"), "hashed-short")
    if not short.rows:
        return first.table.select(*columns)
    # Within the radius some queries have fewer than k rows: these are compared with every row.
    rest = ranked(grid(short.table, learned.reaching_all()))
    kept = first.table.join(full.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi")
    return kept.select(*columns).unionByName(rest.select(*columns))
