"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowkin.settings import DEFAULTS, MatchSettings

# Rows without a key take part in no match; they are spread over this many salts so that they do not
# meet in one task.
_KEYLESS_SPREAD = 65_536


def hot_keys(
    counts: DataFrame, key: str, rows: str, total: int, settings: MatchSettings = DEFAULTS
) -> DataFrame:
    """``(key, parts)`` of the keys too large for one task.

    A key is hot from ``settings.hot_rows`` rows on, and from ``total / settings.hot_keys`` on where that is
    more.  ``total`` is the number of rows over all keys, so no more than ``settings.hot_keys`` keys can be
    hot: the list is complete and may be broadcast.
    """
    least = max(settings.hot_rows, -(-total // settings.hot_keys))
    return counts.where(F.col(rows) > least).select(key, F.ceil(F.col(rows) / least).cast("int").alias("parts"))


def left_join_by_key(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    spread_by: Column,
    count: str = "n",
    settings: MatchSettings = DEFAULTS,
    total: int | None = None,
) -> DataFrame:
    """``rows LEFT JOIN per_key USING (key)`` where ``per_key`` has one row and a row count per key.

    Rows of a hot key are salted over several tasks and its single ``per_key`` row is copied to each
    of them.  ``spread_by`` must tell the rows of one key apart.  ``total`` is the number of ``rows``
    where it is known, else the counts are summed first.
    """
    if total is None:
        total = per_key.agg(F.sum(count)).first()[0] or 0
    hot = hot_keys(per_key, key, count, total, settings)
    copies = F.coalesce(F.col("parts"), F.lit(1))
    left = rows.join(F.broadcast(hot), key, "left").withColumn(
        "salt",
        F.pmod(
            F.xxhash64(spread_by),
            F.when(F.col(key).isNull(), F.lit(_KEYLESS_SPREAD)).otherwise(copies).cast("bigint"),
        ).cast("int"),
    )
    right = per_key.join(F.broadcast(hot), key, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), copies - 1))
    )
    return left.drop("parts").join(right.drop("parts"), [key, "salt"], "left").drop("salt")


def first_per_key(rows: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """``(key, first_id, n)`` of the keys that occur more than once.

    A plain aggregation, so every task sends one row per key it has seen, however hot the key.
    """
    return (
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def attach_first(
    rows: DataFrame,
    key: str,
    id_col: str = "id",
    settings: MatchSettings = DEFAULTS,
    total: int | None = None,
) -> DataFrame:
    """Add ``first_id``: the smallest id that has the row's key, NULL if the row is the only one."""
    firsts = first_per_key(rows, key, id_col)
    return left_join_by_key(rows, firsts, key, F.col(id_col), settings=settings, total=total).drop("n")
