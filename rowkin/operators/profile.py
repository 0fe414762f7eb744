"""Distribution profiles of key columns over a fixed number of buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.functions.keys import bucket_count, bucket_id
from rowkin.operators.groups import side_by_side
from rowkin.plans.detect import TierRun

# Fixed value: bucket count of the identifier profiles.
IDENTIFIER_BUCKETS = 53


def bucket_profile(
    rows: DataFrame, key: str, buckets: int = 101, algorithm: str = "polynomial", by: str | None = None
) -> DataFrame:
    """How the distinct keys spread over ``buckets``: load, occupancy, chain lengths, collisions.

    Rows with an empty key are left out.  With ``by`` there is one profile per value of that column.
    Keys are counted by digest, so long keys are not shuffled.
    """
    capacity = bucket_count(buckets)
    groups = [by] if by else []
    # Empty keys are dropped after the aggregation: a filter on the key itself would be moved below
    # the projection that computes the key, and compute it twice.
    per_key = (
        rows.groupBy(
            *groups,
            F.sha2(F.col(key), 256).alias("digest"),
            bucket_id(F.col(key), capacity, algorithm).alias("bucket"),
        )
        .agg(F.count(F.lit(1)).alias("inserts"), F.bool_and(F.col(key) != "").alias("used"))
        .where("used")
    )
    per_bucket = per_key.groupBy(*groups, "bucket").agg(
        F.count(F.lit(1)).alias("chain"), F.sum("inserts").alias("inserts")
    )
    totals = per_bucket.groupBy(*groups).agg(
        F.coalesce(F.sum("chain"), F.lit(0)).alias("num_elements"),
        F.count(F.lit(1)).alias("occupied_buckets"),
        F.coalesce(F.max("chain"), F.lit(0)).alias("max_chain_length"),
        F.coalesce(F.sum("inserts"), F.lit(0)).alias("inserts"),
    )
    keys, occupied = F.col("num_elements"), F.col("occupied_buckets")
    return totals.select(
        *groups,
        F.lit(capacity).cast("bigint").alias("capacity"),
        keys,
        F.bround(keys / F.lit(capacity), 3).alias("load_factor"),
        occupied,
        (F.lit(capacity).cast("bigint") - occupied).alias("empty_buckets"),
        F.col("max_chain_length"),
        F.when(occupied > 0, F.bround(keys / F.nullif(occupied, F.lit(0)), 2))
        .otherwise(F.lit(0.0))
        .alias("avg_chain_length_occupied"),
        F.col("inserts"),
        (F.col("inserts") - occupied).alias("total_collisions"),
    )


def bucket_collisions(
    rows: DataFrame, key: str, buckets: int = 101, algorithm: str = "polynomial"
) -> DataFrame:
    """Inserts, occupied buckets, and the inserts that meet a non-empty bucket."""
    bucket = bucket_id(F.col(key), bucket_count(buckets), algorithm)
    used = F.count_if(F.col(key) != "")
    per_bucket = rows.groupBy(bucket.alias("bucket")).agg(used.alias("n")).where("n > 0")
    return per_bucket.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("inserts"), F.count(F.lit(1)).alias("occupied_buckets")
    ).withColumn("total_collisions", F.col("inserts") - F.col("occupied_buckets"))


def bucket_members(
    records: DataFrame,
    buckets: int = 101,
    shown: int = 50,
    algorithm: str = "polynomial",
    excerpt: int = 45,
    shown_fields: int = 3,
) -> DataFrame:
    """Members of the first ``shown`` buckets, one row per member, and one row per empty bucket.

    A member is the first record of a key.  Members stay rows, not arrays, as a bucket has no size
    limit.  ``records`` has ``record_id``, ``source_file``, ``primary_key`` and ``canonical``.
    """
    capacity = bucket_count(buckets)
    key = F.col("primary_key")
    placed = records.where(key != "").withColumn("bucket_index", bucket_id(key, capacity, algorithm))
    placed = placed.where(F.col("bucket_index") < shown)
    member = F.struct(
        "bucket_index",
        "record_id",
        "source_file",
        F.concat(F.left(key, F.lit(excerpt)), F.when(F.length(key) > excerpt, "...").otherwise("")).alias("key_excerpt"),
        F.map_from_entries(F.slice(F.map_entries("canonical"), 1, shown_fields)).alias("fields"),
    )
    members = placed.groupBy(F.sha2(key, 256)).agg(F.min_by(member, "record_id").alias("m")).select("m.*")
    lengths = members.groupBy("bucket_index").agg(F.count(F.lit(1)).alias("chain_length"))
    spark = records.sparkSession
    listed = spark.range(min(shown, capacity)).withColumnRenamed("id", "bucket_index")
    # Both are bounded by ``shown`` rows.
    listed = listed.join(F.broadcast(lengths), "bucket_index", "left").fillna(0, ["chain_length"])
    occupied = members.join(F.broadcast(listed), "bucket_index")
    empty = listed.where("chain_length = 0")
    return occupied.unionByName(empty, allowMissingColumns=True).withColumn(
        "is_empty", F.col("chain_length") == 0
    )


def identifier_rows(runs: list[TierRun]) -> DataFrame:
    """``(key_type, key)`` of the identifier rows that each tier worked on."""
    whole = None
    for run in runs:
        if run.tier.key == "digest":
            continue
        field = run.tier.key
        rows = run.seen.where(F.col(field).isNotNull()).select(
            F.lit(field).alias("key_type"), F.concat(F.lit(f"{field}:"), F.col(field)).alias("key")
        )
        whole = rows if whole is None else whole.unionByName(rows)
    if whole is None:
        raise ValueError("the records have no identifier field")
    return whole


def identifier_profile(
    runs: list[TierRun], buckets: int = IDENTIFIER_BUCKETS, algorithm: str = "polynomial"
) -> DataFrame:
    """Bucket profile of each identifier."""
    return bucket_profile(identifier_rows(runs), "key", buckets, algorithm, by="key_type")


def match_rates(summary: DataFrame, profile: DataFrame, elapsed_ms: float | None = None) -> DataFrame:
    """Load factor and collision rate over all records; with a wall time also records per second."""
    both = side_by_side(summary, profile.select("capacity", "total_collisions"))
    total = F.col("total_records")
    nonzero = F.nullif(total, F.lit(0))
    rates = both.select(
        total,
        F.col("duplicate_records"),
        F.bround(total / F.col("capacity"), 3).alias("load_factor"),
        F.coalesce(F.bround(F.col("total_collisions") / nonzero * 100, 2), F.lit(0.0)).alias("collision_rate_percent"),
    )
    if elapsed_ms is not None:
        speed = F.bround(total / F.lit(elapsed_ms / 1000.0), 1) if elapsed_ms > 0 else F.lit(0.0)
        rates = rates.withColumn("records_per_second", speed)
    return rates
