"""Duplicate groups under their direct anchor, and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.operators.details import details
from rowkin.operators.numbering import number_rows
from rowkin.operators.skew import left_join_by_key
from rowkin.plans.detect import EXACT, PARTIAL, POSSIBLE
from rowkin.settings import DEFAULTS, MatchSettings


def group_attributes(outcomes: DataFrame) -> DataFrame:
    """One row per anchor: size, and type, field and confidence of its first duplicate.

    Groups hang on direct anchors: an anchor may itself be a duplicate of another record.
    """
    first = F.struct("duplicate_type", "matched_on", "confidence")
    return (
        outcomes.where("is_duplicate")
        .groupBy(F.col("duplicate_of_id").alias("primary_id"))
        .agg(
            F.min("record_id").alias("first_duplicate_id"),
            (F.count(F.lit(1)) + 1).alias("total_records"),
            F.min_by(first, "record_id").alias("first"),
        )
        .select("primary_id", "first_duplicate_id", "total_records", "first.*")
    )


def groups(outcomes: DataFrame, records: DataFrame | None = None, settings: MatchSettings = DEFAULTS) -> DataFrame:
    """Groups numbered in the order of their first duplicate.

    With ``records`` the matched fields and the explanation of that first duplicate are added.
    """
    numbered = number_rows(group_attributes(outcomes), ["first_duplicate_id"], "group_id")
    if records is None:
        return numbered
    firsts = outcomes.join(
        numbered.select(F.col("first_duplicate_id").alias("record_id")), "record_id", "left_semi"
    )
    texts = details(records, firsts, settings).select(
        F.col("record_id").alias("first_duplicate_id"), "matched_fields", "explanation"
    )
    return numbered.join(texts, "first_duplicate_id")


def group_members(outcomes: DataFrame, settings: MatchSettings = DEFAULTS) -> DataFrame:
    """``(group_id, primary_id, position, record_id)``: the members of every group in order.

    Position 0 is the anchor itself, then come its duplicates by record id; ``group_id`` is that of
    :func:`groups`.  All members are numbered at once in one range-sorted pass and counted from the start of
    their group, so neither the size of a group nor the values of the ids bound anything.
    """
    attributes = number_rows(group_attributes(outcomes), ["first_duplicate_id"], "group_id")
    heads = attributes.select("group_id", "primary_id", F.col("total_records").alias("n"))
    found = outcomes.where("is_duplicate").select(F.col("duplicate_of_id").alias("primary_id"), "record_id")
    members = left_join_by_key(found, heads, "primary_id", F.col("record_id"), settings=settings)
    anchors = heads.select("primary_id", F.col("primary_id").alias("record_id"), "group_id", "n")
    rows = members.unionByName(anchors).withColumn("later", F.col("record_id") != F.col("primary_id"))
    placed = number_rows(rows, ["group_id", "later", "record_id"], "at")
    # Groups stand one behind the other, so a group starts behind the members of those before it.
    starts = placed.where("not later").select("primary_id", F.col("at").alias("start"), "n")
    counted = left_join_by_key(placed.drop("n"), starts, "primary_id", F.col("record_id"), settings=settings)
    return counted.select(
        "group_id", "primary_id", (F.col("at") - F.col("start")).cast("bigint").alias("position"), "record_id"
    )


def masters(outcomes: DataFrame) -> DataFrame:
    """The unique records."""
    return outcomes.where(~F.col("is_duplicate"))


def duplicates(outcomes: DataFrame) -> DataFrame:
    return outcomes.where("is_duplicate")


def summary(outcomes: DataFrame) -> DataFrame:
    """Counts of the whole run, one row; the percentage is 0.0 for no records."""
    of_kind = lambda kind: F.count_if(F.col("duplicate_type") == kind)
    counts = outcomes.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(~F.col("is_duplicate")).alias("unique_records"),
        F.count_if("is_duplicate").alias("duplicate_records"),
        of_kind(EXACT).alias("exact_duplicates"),
        of_kind(PARTIAL).alias("partial_duplicates"),
        of_kind(POSSIBLE).alias("possible_duplicates"),
        F.count_distinct("duplicate_of_id").alias("duplicate_groups_count"),
    )
    share = F.when(
        F.col("total_records") > 0,
        F.bround(F.col("duplicate_records") / F.nullif(F.col("total_records"), F.lit(0)) * 100, 1),
    ).otherwise(F.lit(0.0))
    return counts.withColumn("duplicate_percentage", share)


def run_report(outcomes: DataFrame, file_reports: DataFrame) -> DataFrame:
    """Summary with the number of analysed files and their reports."""
    files = file_reports.agg(
        F.count_distinct("filename").alias("total_files_analyzed"),
        F.count_if(F.col("status") == "error").alias("failed_files"),
    )
    return side_by_side(summary(outcomes), files)


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One row with the columns of several one-row tables."""
    whole = rows[0]
    for row in rows[1:]:
        whole = whole.unionByName(row, allowMissingColumns=True)
    return whole.agg(*[F.max(c).alias(c) for c in whole.columns])
