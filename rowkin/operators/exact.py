"""Exact duplicates and the survivors that go on to the next tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowkin.operators.skew import attach_first
from rowkin.scratch import store
from rowkin.settings import DEFAULTS, MatchSettings


def digest(text: Column) -> Column:
    """A fixed-length stand-in for a key of any length, NULL for the empty key."""
    return F.when(text != "", F.unhex(F.sha2(text, 256)))


def match_exact(
    rows: DataFrame, key: str = "primary_key", id_col: str = "record_id", settings: MatchSettings = DEFAULTS
) -> DataFrame:
    """``(id, first_id)``: every row whose non-empty key occurred earlier, with the first such row."""
    # Written once, so that the rows are scanned and their keys computed in a single pass.
    slim = store(rows.select(F.col(id_col).alias("id"), digest(F.col(key)).alias("digest")), "digests")
    flagged = attach_first(slim.table, "digest", settings=settings, total=slim.rows)
    return flagged.where("id > first_id").select("id", "first_id")


def distinct_first(
    rows: DataFrame, key: str = "primary_key", id_col: str = "record_id", settings: MatchSettings = DEFAULTS
) -> DataFrame:
    """The first row of every key; rows with an empty key are all kept.

    The repeats are found on narrow rows; whole rows only meet the list of repeated ids, and stay
    where they are when Spark finds that list small enough to broadcast.
    """
    repeats = match_exact(rows, key, id_col, settings).select(F.col("id").alias(id_col))
    return rows.join(repeats, id_col, "left_anti")
