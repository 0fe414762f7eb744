import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowkin.llm import multi_index as M


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / (math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(y * y for y in b)))


def brute(rows, k=5):
    """Every pair of a query and another row, ranked."""
    good = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for query in sorted({i for i, _ in good if i is not None and i % 50 == 0}):
        pairs = [(-round(cosine(a, b), 12), j is None, j or 0) for i, a in good if i == query for j, b in good if j != query]
        out[query] = [(None if none else j, -s) for s, none, j in sorted(pairs)[:k]]
    return out


def found(df, **settings):
    out = {}
    for r in sorted(M.nearest(df, F.col("vec_id") % 50 == 0, **settings).collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], round(r["score"], 12)))
    return out


def clusters(seed, n, width, spread=0.5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    return (centres[rng.integers(12, size=n)] + spread * rng.normal(size=(n, width))).tolist()


def test_a_radius_meets_every_code_within_it():
    """Pigeonhole probing, by flips and by walks, against counting the bits of all codes."""
    rng = np.random.default_rng(1)
    learned = M.Codes(rng.normal(size=(300, 20)))
    codes = rng.integers(0, 1 << 63, size=4000, dtype=np.uint64)
    codes[:2000] = codes[0] ^ (np.uint64(1) << rng.integers(0, 64, size=2000, dtype=np.uint64))
    for radius in (0, 1, 2, 3, 4, 7, 11, 20, 40, 64):
        whole, more = divmod(radius - M.PARTS + 1, M.PARTS)
        learned.radius, learned.part_radius = radius, [whole + (j < more) for j in range(M.PARTS)]
        index = M.Index(codes, learned)
        for code in (codes[0], codes[7], codes[3000], np.uint64(0)):
            parts = [int(p[0]) for p in learned.substrings(np.array([code]))]
            assert index.within(code, parts).tolist() == np.flatnonzero(np.bitwise_count(codes ^ code) <= radius).tolist()


@pytest.mark.parametrize("width", [5, 64, 100])
def test_recall_and_scores(spark, monkeypatch, width):
    monkeypatch.setattr(M, "ROW_BLOCK", 300)
    monkeypatch.setattr(M, "QUERY_BLOCK", 7)
    rows = list(enumerate(clusters(width, 1500, width)))
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<double>, score double")
    got, expected = found(df), brute(rows)
    assert got.keys() == expected.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len(set(got[q]) & {(j, round(s, 12)) for j, s in expected[q]}) for q in expected)
    assert hits >= 0.9 * 5 * len(expected)
    vectors = dict(rows)
    assert all(abs(s - cosine(vectors[q], vectors[j])) < 1e-12 and j != q for q, near in got.items() for j, s in near)


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    expected = brute([(r["vec_id"], r["embedding"]) for r in table.collect()])
    got = found(table)
    assert sum(len({j for j, _ in got[q]} & {j for j, _ in expected[q]}) for q in expected) >= 0.9 * 5 * len(expected)


def test_odd_vectors_ties_and_repeated_rows(spark):
    """With few rows everything is compared, so the result is exact."""
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(60)]
    rows += [(100, [1.0, 0.0, 0.0]), (101, [1.0]), (102, [1e-300]), (103, [2e307, 0.0]), (103, [2e307, 0.0]), (104, [0.5])]
    rows += [(150, [0.0, 3.0]), (150, [5.0, 0.0]), (7, rows[7][1]), (None, [1.0]), (None, rows[0][1])]
    rows += [(200, None), (200, []), (201, [float("nan")]), (202, [float("inf")]), (203, [None]), (204, [0.0, -0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    tame = [(n, v if n not in (102, 103) else [1.0]) for n, v in rows]  # plain arithmetic would over- or underflow
    got, expected = found(df), brute(tame)
    assert got == {q: [(j, round(s, 12)) for j, s in near] for q, near in expected.items()}
    assert [j for j, _ in got[100]] == [101, 102, 103, 103, 104] and 200 not in got


def test_one_vector_in_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(M, "ROW_BLOCK", 200)
    vectors = clusters(2, 900, 16)
    rows = [(i, vectors[0] if i % 3 == 0 else v) for i, v in enumerate(vectors)]
    got = found(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert [j for j, _ in got[0]] == [3, 6, 9, 12, 15] and [j for j, _ in got[150]] == [0, 3, 6, 9, 12]


def test_small_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 1.0])], "vec_id int, embedding array<float>")
    half = round(math.sqrt(0.5), 12)
    assert found(df) == {0: [(1, half), (50, 0.0)], 50: [(1, half), (0, 0.0)]}
    assert found(df.where("vec_id = 0")) == {} and found(df.limit(0)) == {}
    assert M.nearest(df, F.col("vec_id") % 50 == 0).dtypes == [("query_id", "int"), ("rank", "int"), ("vec_id", "int"), ("score", "double")]


def test_a_block_keeps_every_row_that_can_be_near():
    rows = np.repeat(np.eye(2), [30, 4], axis=0)
    ids = np.array([9] * 12 + list(range(18)) + [1, 1, 1, 2])
    known = np.ones(34, bool)
    kept = M._representatives(rows, ids, known, 3)
    assert sorted(ids[kept[rows[kept][:, 0] == 1]].tolist()) == [0, 1, 2, 3] and sorted(ids[kept[rows[kept][:, 1] == 1]].tolist()) == [1, 1, 1, 2]
    assert M.matrix(pa.array([[1.0], [], [2.0, 3.0]]), 2).tolist() == [[1, 0], [0, 0], [2, 3]]
