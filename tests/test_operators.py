from pyspark.sql import functions as F

from rowkin.operators import lookup, numbering, profile, skew, views
from rowkin.operators.exact import distinct_first, match_exact
from rowkin.settings import MatchSettings
from rowkin.streaming.incremental import MasterSink

HOT = MatchSettings(hot_rows=3, hot_keys=2)


def keyed(spark):
    rows = [(i, "hot" if i % 3 else f"k{i % 7}", i) for i in range(60)] + [(i, None, i) for i in range(60, 80)]
    return spark.createDataFrame(rows, "id bigint, key string, payload bigint")


def test_attach_first_with_and_without_salt(spark):
    df = keyed(spark)
    plain = {r["id"]: r["first_id"] for r in skew.attach_first(df, "key", total=80).collect()}
    salted = {r["id"]: r["first_id"] for r in skew.attach_first(df, "key", settings=HOT).collect()}
    assert plain == salted and len(plain) == 80
    assert plain[59] == 1 and plain[1] == 1 and plain[70] is None


def test_hot_keys_are_spread_over_tasks(spark):
    counts = spark.createDataFrame([("a", 10), ("b", 4), ("c", 9), ("d", 2)], "key string, n bigint")
    assert [tuple(r) for r in skew.hot_keys(counts, "key", "n", 8, HOT).collect()] == [("a", 3), ("c", 3)]


def test_every_hot_key_is_split_whatever_the_bound_of_the_list(spark):
    rows = spark.range(400).select(F.col("id"), (F.col("id") % 20).alias("key"))
    counts = rows.groupBy("key").agg(F.count("*").alias("n"))
    for bound in (1, 5, 19, 100):
        settings = MatchSettings(hot_rows=3, hot_keys=bound)
        hot = skew.hot_keys(counts, "key", "n", 400, settings).collect()
        # No key is left with more rows per part than its share of the bound.
        assert len(hot) <= bound
        assert all(20 / parts <= max(3, 400 / bound) for _, parts in hot) and len(hot) in (0, 20)
        joined = skew.left_join_by_key(rows, counts.withColumn("v", F.col("key") * 2), "key", F.col("id"), settings=settings)
        assert joined.where("v = key * 2").count() == 400


def test_exact_and_distinct(spark):
    df = keyed(spark).fillna("", ["key"])
    pairs = {r["id"]: r["first_id"] for r in match_exact(df, "key", "id").collect()}
    assert pairs[59] == 1 and 1 not in pairs and 70 not in pairs
    kept = {r["id"] for r in distinct_first(df, "key", "id").collect()}
    assert kept == set(range(80)) - set(pairs)


def test_lookup_and_increment(spark):
    master = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "")], "record_id bigint, primary_key string")
    batch = spark.createDataFrame([(9, "a"), (8, "c"), (7, "c"), (6, ""), (5, None)], "record_id bigint, primary_key string")
    found = {r["record_id"]: r["found_id"] for r in lookup.key_lookup(batch, master, settings=HOT).collect()}
    assert found == {9: 1, 8: None, 7: None, 6: None, 5: None}
    hits, fresh = lookup.incremental_match(batch, master)
    assert {(r["record_id"], r["found_id"]) for r in hits.collect()} == {(9, 1), (8, 7)}
    assert {r["record_id"] for r in fresh.collect()} == {7, 6, 5}


def test_increment_keeps_every_row_of_a_batch(spark):
    master = spark.createDataFrame([(1, "k")], "record_id bigint, primary_key string")
    rows = [(11, "n"), (12, "n"), (13, "m"), (14, "k"), (15, "n"), (16, ""), (17, "")]
    batch = spark.createDataFrame(rows, "record_id bigint, primary_key string")
    for settings in (HOT, MatchSettings()):
        hits, fresh = lookup.incremental_match(batch, master, settings=settings)
        found = {r["record_id"]: r["found_id"] for r in hits.collect()}
        assert found == {12: 11, 14: 1, 15: 11}
        assert sorted(r["record_id"] for r in fresh.collect()) == [11, 13, 16, 17]
        assert fresh.columns == batch.columns and hits.columns == [*batch.columns, "found_id"]
    assert lookup.incremental_match(batch.limit(0), master)[0].count() == 0


def test_sink_replays_a_batch_and_fails_on_a_broken_master(spark, tmp_path):
    sink = MasterSink(str(tmp_path / "master"), str(tmp_path / "hits"))
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "record_id bigint, primary_key string")
    second = spark.createDataFrame([(4, "b"), (5, "c"), (6, "c")], "record_id bigint, primary_key string")
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        sink(batch, number)
    master = spark.read.parquet(str(tmp_path / "master"))
    hits = spark.read.parquet(str(tmp_path / "hits"))
    assert sorted(r["record_id"] for r in master.collect()) == [1, 3, 5]
    assert sorted((r["record_id"], r["found_id"]) for r in hits.collect()) == [(2, 1), (4, 3), (6, 5)]


def test_number_rows(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v")).repartition(5)
    numbered = numbering.number_rows(df, ["v"], "n")
    assert numbered.where("n <> v + 1").count() == 0 and numbered.count() == 1000


def test_profile_of_a_small_table(spark):
    df = spark.createDataFrame([(f"key_{i}",) for i in range(15)] + [("key_0",), ("",)], "key string")
    row = profile.bucket_profile(df, "key", 7).first()
    assert (row["capacity"], row["num_elements"], row["inserts"]) == (31, 15, 16)
    assert row["occupied_buckets"] + row["empty_buckets"] == 31
    assert row["total_collisions"] == 16 - row["occupied_buckets"] and row["load_factor"] == 0.484
    assert profile.bucket_collisions(df, "key", 7).first()["total_collisions"] == row["total_collisions"]
    assert profile.bucket_profile(df.limit(0), "key", 7).first()["avg_chain_length_occupied"] == 0.0


def test_run_report_and_rates(spark):
    from rowkin.operators.groups import run_report, summary

    outcomes = spark.createDataFrame(
        [(1, False, None, None), (2, True, 1, "Exact Duplicate")],
        "record_id bigint, is_duplicate boolean, duplicate_of_id bigint, duplicate_type string",
    )
    reports = spark.createDataFrame([("a.csv", "success"), ("b.xyz", "error")], "filename string, status string")
    row = run_report(outcomes, reports).first()
    assert (row["total_records"], row["exact_duplicates"], row["total_files_analyzed"], row["failed_files"]) == (2, 1, 2, 1)
    keys = spark.createDataFrame([("a",), ("a",)], "key string")
    rates = profile.match_rates(summary(outcomes), profile.bucket_profile(keys, "key", 31), elapsed_ms=500.0).first()
    assert (rates["load_factor"], rates["collision_rate_percent"], rates["records_per_second"]) == (0.065, 50.0, 4.0)


def test_views(spark):
    rows = [(i, {"a": f"Value {i}", "b": None, "__c": "z"}, f"a:value {i}", i % 2 == 0) for i in range(1, 31)]
    df = spark.createDataFrame(rows, "record_id bigint, raw map<string,string>, primary_key string, is_duplicate boolean")
    assert views.filter_status(df, "unique").count() == 15 and views.filter_status(df).count() == 30
    assert views.search_records(df, "VALUE 2").count() == 11 and views.search_records(df, "").count() == 30
    assert views.search_records(df, "A:v").count() == 30
    assert [r["record_id"] for r in views.page_records(df, 3, 12).collect()] == list(range(25, 31))
    assert [r["record_id"] for r in views.page_after(df, 28, 12).collect()] == [29, 30]
    assert views.page_info(df, 3, 12).first()["total_pages"] == 3
    assert views.get_record(df, 7).first()["primary_key"] == "a:value 7"
    texts = df.select(views.record_summary(F.create_map(F.lit("x"), F.lit("1"), F.lit("__y"), F.lit("2"), F.lit("z"), F.lit("3"))))
    assert texts.first()[0] == "x: 1 | z: 3"


def test_stream_against_a_growing_master(spark, tmp_path):
    source = str(tmp_path / "in")
    batches = [[(1, "a"), (2, "b"), (3, "a")], [(4, "b"), (5, "c")]]
    sink = MasterSink(str(tmp_path / "master"), str(tmp_path / "hits"))
    schema = "record_id bigint, primary_key string"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        sink.start(stream, str(tmp_path / "checkpoint")).awaitTermination(120)
    master = spark.read.parquet(str(tmp_path / "master"))
    assert sorted((r["record_id"], r["batch"]) for r in master.collect()) == [(1, 0), (2, 0), (5, 1)]
    hits = spark.read.parquet(str(tmp_path / "hits"))
    assert sorted((r["record_id"], r["found_id"]) for r in hits.collect()) == [(3, 1), (4, 2)]
    # A replay of the last batch changes nothing.
    sink(spark.createDataFrame(batches[1], schema), 1)
    assert spark.read.parquet(str(tmp_path / "master")).count() == 3


def test_dropped_tables_are_gone_and_the_result_stays(spark):
    import os

    from rowkin.scratch import dropping, write_out

    with dropping(spark) as made:
        first = write_out(spark.range(5).toDF("x"), "first")
        result = write_out(first.where("x > 2"), "result")
        gone, kept = made[0], made.pop()
    assert not os.path.exists(gone) and os.path.exists(kept)
    assert sorted(r["x"] for r in result.collect()) == [3, 4]
