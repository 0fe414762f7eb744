"""Filters, search and paging over records and groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_status(records: DataFrame, status: str = "all") -> DataFrame:
    """``status`` is "duplicate" or "unique"; anything else keeps all records."""
    if status == "duplicate":
        return records.where("is_duplicate")
    if status == "unique":
        return records.where(~F.col("is_duplicate"))
    return records


def _mentions(raw: Column, query: str) -> Column:
    return F.exists(F.map_values(raw), lambda v: F.coalesce(F.contains(F.lower(v), F.lit(query)), F.lit(False)))


def search_records(records: DataFrame, query: str, raw: str = "raw", key: str = "primary_key") -> DataFrame:
    """Records with ``query`` in a raw value or in the composite key, ignoring case."""
    if not query:
        return records
    q = query.lower()
    found = _mentions(F.col(raw), q)
    if key in records.columns:
        found = found | F.coalesce(F.contains(F.lower(F.col(key)), F.lit(q)), F.lit(False))
    return records.where(found)


def page_records(records: DataFrame, page: int = 1, per_page: int = 25, order: str = "record_id") -> DataFrame:
    """One page in record order: a top-k plan, not a full sort.  For deep pages see :func:`page_after`."""
    return records.orderBy(order).offset((page - 1) * per_page).limit(per_page)


def page_after(records: DataFrame, last: int, per_page: int = 25, order: str = "record_id") -> DataFrame:
    """The page that follows record ``last``: the filter is pushed to the scan, nothing is skipped over."""
    return records.where(F.col(order) > last).orderBy(order).limit(per_page)


def page_info(records: DataFrame, page: int = 1, per_page: int = 25) -> DataFrame:
    """``total_count, page, per_page, total_pages``."""
    pages = F.ceil(F.col("total_count") / per_page) if per_page > 0 else F.lit(1)
    return records.agg(F.count(F.lit(1)).alias("total_count")).select(
        "total_count",
        F.lit(page).cast("bigint").alias("page"),
        F.lit(per_page).cast("bigint").alias("per_page"),
        pages.cast("bigint").alias("total_pages"),
    )


def get_record(records: DataFrame, record_id: int, id_col: str = "record_id") -> DataFrame:
    return records.where(F.col(id_col) == record_id)


def record_summary(raw: Column, shown: int = 4) -> Column:
    """The first fields of a raw map as ``key: value | key: value``."""
    visible = F.filter(F.map_entries(raw), lambda e: ~e["key"].startswith("__"))
    texts = F.transform(
        F.slice(visible, 1, shown), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")))
    )
    return F.array_join(texts, " | ")


def search_groups(groups: DataFrame, outcomes: DataFrame, records: DataFrame, query: str) -> DataFrame:
    """Groups where a raw value of the master or of a member, or a matched field, contains ``query``."""
    if not query:
        return groups
    q = query.lower()
    hits = records.where(_mentions(F.col("raw"), q)).select("record_id")
    by_member = outcomes.where("is_duplicate").join(hits, "record_id", "left_semi").select("duplicate_of_id")
    by_master = hits.select(F.col("record_id").alias("duplicate_of_id"))
    named = F.exists("matched_fields", lambda f: F.contains(F.lower(f), F.lit(q)))
    by_field = groups.where(named).select(F.col("primary_id").alias("duplicate_of_id"))
    wanted = by_member.unionByName(by_master).unionByName(by_field).distinct()
    return groups.join(wanted.withColumnRenamed("duplicate_of_id", "primary_id"), "primary_id", "left_semi")
