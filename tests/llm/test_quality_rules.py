import random

from rowkin.llm import quality_rules as Q
from tests.llm.brute import quality

_CASES = [
    None, "", " \t\n\x0b\x0c\r", "a", "a a a", "a a a a", "a b c a b c", "x b c y b c", "a\u00a0b c", "#*$%&|<> !!",
    "same\nsame\n\n \n \nsame ", "one two three " * 60, "é" * 300, "word " * 49, "a b " * 30 + "c d e f",
]


def _random(seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab \n\t#!") for _ in range(rng.randint(0, 300))) for _ in range(60)]


def test_measurements_against_plain_python(spark):
    texts = _CASES + _random(1) + [" ".join(f"w{i % 997}" for i in range(30_000))]
    docs = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    rows = {r["doc_id"]: r for r in Q.judged(docs).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == quality(text), repr(text)[:80]
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (r["fail_bits"] & Q.policy_mask(Q.CURRENT) == 0)
        assert not (r["kept"] and r["base_failed"])


def test_policies_and_ablations_come_from_the_bits(spark):
    stored = spark.createDataFrame([(0,), (0,), (1,), (3,), (2,), (64,), (65,)], "fail_bits long")
    assert stored.where(Q.passes("base-1")).count() == 3
    rows = {r["rule"]: (r["failed"], r["only"], r["kept"], r["kept_without"]) for r in Q.ablations(stored, "base-1").collect()}
    assert rows == {"few_words": (3, 2, 3, 5), "repeated_windows": (2, 1, 3, 4)}
    empty = Q.ablations(stored.limit(0), "base-1").collect()
    assert [tuple(r)[1:] for r in empty] == [(0, 0, 0, 0)] * 2


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "x " * 60), (1, "x " * 60), (None, None)], "doc_id long, text string")
    assert Q.judged(docs.limit(0)).collect() == []
    assert sorted((r["doc_id"] or 0, r["n_words"]) for r in Q.judged(docs).collect()) == [(0, 0), (1, 60), (1, 60)]


def test_no_python_and_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = Q.judged(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
