"""Plans stay inside the JVM and free of all-pairs joins and one-task windows."""

import re

import pytest
from pyspark.sql import functions as F

from rowkin.operators.names import match_names
from rowkin.operators.skew import attach_first
from rowkin.plans.catalog import QUERIES, part_rows, people_columns
from rowkin.sources import delimited
from tests.conftest import SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")
ONE_TASK_WINDOW = re.compile(r"Window \[[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition")

LAZY = (
    "text_cards", "report_rows", "paragraph_cards", "decode_fallback", "canonical_field", "fuse_aliases", "normalize_name",
    "normalize_number", "normalize_date", "dispatch_clean", "primary_key", "hash_polynomial", "bucket_id", "match_exact",
    "distinct_first", "possible_pairs", "scan_json", "grid_records", "page_info", "match_rates", "search_groups",
)


def plan_of(df):
    # The extended form is not cut at a number of nodes or fields.
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.mark.parametrize("name", LAZY)
def test_plan(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert not [word for word in FORBIDDEN if word in plan]
    assert not ONE_TASK_WINDOW.search(plan)


def test_filters_and_columns_reach_the_scan(spark):
    df = spark.read.parquet(f"{SMALL}/customer.parquet").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("key"), "c_acctbal", "c_name"
    )
    plan = plan_of(attach_first(df, "key").where("id < 50").select("id", "first_id"))
    assert "PushedFilters: [IsNotNull(c_custkey), LessThan(c_custkey,50)]" in plan
    assert "c_acctbal" not in plan and "c_name" not in plan


def test_only_a_limited_list_is_broadcast_on_purpose(spark):
    df = spark.read.parquet(f"{SMALL}/customer.parquet").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("key"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(attach_first(df, "key"))
        # What is broadcast is the list of keys above the bound, which holds for at most hot_keys of them.
        assert "> 200000" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        assert "> 200000" in plan_of(attach_first(df, "key", total=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    from rowkin import scratch

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError):
        scratch.shared_folder(Session())


def test_similar_names_of_one_cluster_never_form_all_pairs(spark):
    from rowkin.settings import MatchSettings

    # One cluster of equal names at different addresses, and a few others.
    df = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("maria fernandez")).otherwise(F.substring(F.md5(F.col("id").cast("string")), 1, 14)).alias("name"),
        F.concat(F.lit("street "), F.col("id").cast("string")).alias("address"),
    )
    found = match_names(df, MatchSettings(pair_budget=20_000, pairs_per_name=4)).where("anchor = 0")
    assert found.count() == 999


def test_csv_scan_reads_alike_files_together(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f"a,b\n{i},x\n")
    plan = plan_of(delimited.scan_csv(spark, str(tmp_path), line_numbers=False))
    assert plan.count("FileScan csv") == 1 or plan.count("Scan csv") == 1


def test_rows_of_small_files_are_dealt_over_all_cores(spark):
    """A table of few bytes is one split, however much work its rows are."""
    cores = spark.sparkContext.defaultParallelism
    for rows in (people_columns(spark, SMALL), part_rows(spark, SMALL)):
        assert rows.rdd.getNumPartitions() >= cores
