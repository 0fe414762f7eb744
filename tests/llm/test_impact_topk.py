import math
import random

import pytest
from pyspark.sql import functions as F

from rowkin.llm import impact_topk as T
from tests.llm.brute import top_k


def _vectors(seed, n=260, width=12):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    out = [(i, [c + rng.gauss(0, 0.3) for c in rng.choice(centres)]) for i in range(n)]
    out += [(n + i, list(centres[0])) for i in range(12)]  # ties
    out += [(900, None), (901, [float("nan")] * width), (902, [float("inf")] * width), (903, [None] * width), (904, []), (905, [0.0] * width), (950, [0.0] * width)]
    return out


@pytest.mark.parametrize("blocks", [(8192, 2048), (40, 2)])
def test_against_all_scores(spark, monkeypatch, blocks):
    monkeypatch.setattr(T, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(T, "QUERY_BLOCK", blocks[1])
    monkeypatch.setattr(T, "FEW", 4)
    vectors = _vectors(3)
    df = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id long, embedding array<float>, score int")
    plain = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = sorted(tuple(r) for r in T.top_k(df, F.col("vec_id") % 50 == 0).collect())
    assert found == sorted(top_k(plain))


def test_few_rows_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 0.5]), (0, [1.0, 0.5]), (3, [0.5]), (None, [1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in T.top_k(df, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 3, 256 * 128)]
    assert T.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize("blocks", [(8192, 2048), (20, 2)])
def test_large_components_and_different_vectors_of_one_id(spark, monkeypatch, blocks):
    monkeypatch.setattr(T, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(T, "QUERY_BLOCK", blocks[1])
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(120)]
    rows += [(i, [rng.gauss(0, 1) * 3e5 for _ in range(6)]) for i in (150, 151, 152, 153)]
    rows += [(200, [262144.0] * 6), (201, [-262144.0] * 6), (202, [4e5 + 0.3, 0.0, 0.0, 0.0, 0.0, 0.0])]
    rows += [(50, [2.0] * 6), (50, [-2.0] * 6), (7, [3.0] * 6), (7, [-3.0] * 6), (7, [3e5] * 6)]
    rows += [(300 + i, [5e5, 1.0, 0.0, 0.0, 0.0, 0.0]) for i in range(12)]  # ties
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    expected = []
    for query in sorted({i for i, _ in rows if i % 50 == 0}):
        scores = sorted((-sum(map(int.__mul__, a, b)), j) for i, a in whole if i == query for j, b in whole if j != i)
        expected += [(query, n + 1, j, -s) for n, (s, j) in enumerate(scores[:5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in T.top_k(df, F.col("vec_id") % 50 == 0).collect()) == expected


def test_scores_beyond_a_bigint_fail(spark):
    df = spark.createDataFrame([(0, [1e308]), (1, [1e308])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="is no bigint"):
        T.top_k(df, F.col("vec_id") % 50 == 0).collect()
