import random

from pyspark.sql import functions as F

from rowkin.llm import curriculum as C
from tests.llm.brute import mix


def _docs(seed, sources):
    rng = random.Random(seed)
    return [(rng.randint(1, 500), "w " * rng.choice([0, 1, 5, 40, rng.randint(1, 90)]), rng.choice(sources)) for _ in range(300)]


def test_targets_and_taken(spark):
    for seed, sources in ((1, ["a", "b", "é", None]), (2, ["a"] * 9 + ["b", "c", "d", "e"]), (3, ["x"])):
        docs = _docs(seed, sources) + [(7, None, "a"), (7, None, "a")]
        rows = C.plan(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, source string, size int")).collect()
        key = lambda r: (r[0], r[1], r[2], round(r[3], 6))
        assert sorted(map(key, mix(docs))) == sorted(key((r["doc_id"], r["size"], r["source_size"], r["target"])) for r in rows)
        taken: dict = {}
        for r in rows:
            assert 0 <= r["taken"] <= 2 * r["size"]
            taken.setdefault((r["source"], r["target"]), []).append(r["taken"])
        for (_, target), parts in taken.items():
            assert abs(sum(parts) - target) <= 1
        assert round(sum(t for _, t in taken)) == round(1.5 * sum(r["size"] for r in rows))


def test_slices_do_not_change_the_plan(spark, monkeypatch):
    docs = spark.createDataFrame(_docs(5, ["a", "a", "b", None]), "doc_id long, text string, source string")
    one = sorted(map(tuple, C.plan(docs).drop("key").collect()), key=repr)
    monkeypatch.setattr(C, "LEAST_SLICES", 3)
    assert sorted(map(tuple, C.plan(docs.repartition(3)).drop("key").collect()), key=repr) == one


def test_schedule_is_ordered_and_complete(spark):
    docs = spark.createDataFrame(_docs(6, ["a", "b", "c", "d"]), "doc_id long, text string, source string")
    planned = C.plan(docs)
    times = C.scheduled(planned)
    assert times.agg(F.sum("words")).first()[0] == planned.agg(F.sum("taken")).first()[0]
    places = [r["position"] for r in times.collect()]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1
    # A source that comes late has less than half of its words in the first half.
    early = {r["source"]: r["s"] for r in times.where("position < 0.5").groupBy("source").agg(F.sum("words").alias("s")).collect()}
    goal = {r["source"]: r["target"] for r in planned.select("source", "target").distinct().collect()}
    assert early["a"] / goal["a"] < 0.42 and early["c"] / goal["c"] > 0.58


def test_positions_of_both_epochs(spark):
    docs = spark.createDataFrame(_docs(8, ["a", "b", "c", "d", None]), "doc_id long, text string, source string")
    planned = C.plan(docs)
    rows = C.with_positions(planned).collect()
    assert len(rows) == 300 and any(r["position_2"] is not None for r in rows)
    times = sorted((r["source"] or "", r["start"], r["epoch"], r["position"]) for r in C.scheduled(planned).collect())
    wide = [(r["source"] or "", r["start"], k, r[f"position_{k + 1}"]) for r in rows for k in (0, 1) if r[f"position_{k + 1}"] is not None]
    assert sorted(wide) == times
    for r in rows:
        places = [(k, r[f"position_{k + 1}"]) for k in (0, 1) if r[f"position_{k + 1}"] is not None]
        assert bool(places) == (r["taken"] > 0)
        for k, t in places:  # the integral of the schedule up to the position is the share used up before the document
            share = min(1.0, (r["start"] + k * r["source_size"]) / max(r["target"], 1.0))
            assert abs(r["tilt"] * t * t + (1 - r["tilt"]) * t - share) < 1e-9


def test_mixed_texts_hold_the_words_taken(spark):
    docs = [(i, f" w{i} x\ty\n z ", "ab"[i % 2]) for i in range(50)] + [(99, None, "a")]
    df = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, source string, key string")
    out = C.mixed(df)
    assert out.columns == df.columns
    rows = out.collect()
    assert sum(len(r["text"].split()) for r in rows) == sum(r["taken"] for r in C.plan(df).collect())
    assert all(f" w{r['doc_id']} x\ty\n z ".startswith(r["text"]) for r in rows)


def test_empty_table(spark):
    df = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    assert C.plan(df.limit(0)).collect() == [] and C.mixed(df.limit(0)).collect() == []
