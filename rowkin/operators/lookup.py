"""Lookup in, and growth of, a master table of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.operators.exact import digest
from rowkin.operators.skew import attach_first, left_join_by_key
from rowkin.scratch import store, write_out
from rowkin.settings import DEFAULTS, MatchSettings


def key_lookup(
    probe: DataFrame,
    master: DataFrame,
    key: str = "primary_key",
    id_col: str = "record_id",
    settings: MatchSettings = DEFAULTS,
) -> DataFrame:
    """``probe`` with ``found_id``: the first master record with the same key, NULL for a miss.

    Both sides are reduced to one row per key before they meet, so neither a hot probe key nor a hot
    master key reaches one task.  A short list of probe keys is broadcast to the master, which is then
    only filtered; a longer one meets the aggregated master in a shuffle.
    """
    tagged = probe.withColumn("_digest", digest(F.col(key)))
    wanted = store(
        tagged.where("_digest is not null").groupBy("_digest").agg(F.count(F.lit(1)).alias("n")), "wanted",
        total=F.sum("n"),
    )
    slim = master.select(digest(F.col(key)).alias("_digest"), F.col(id_col).alias("_id"))
    if wanted.rows <= settings.broadcast_rows:
        slim = slim.join(F.broadcast(wanted.table.select("_digest")), "_digest", "left_semi")
    firsts = slim.where("_digest is not null").groupBy("_digest").agg(F.min("_id").alias("found_id"))
    hits = wanted.table.join(firsts, "_digest")
    total = wanted.figures["total"] or 0
    return left_join_by_key(tagged, hits, "_digest", F.col(id_col), settings=settings, total=total).drop("_digest", "n")


def incremental_match(
    batch: DataFrame,
    master: DataFrame,
    key: str = "primary_key",
    id_col: str = "record_id",
    settings: MatchSettings = DEFAULTS,
) -> tuple[DataFrame, DataFrame]:
    """Match a batch against a master: ``(hits, fresh)``; every row of the batch is in exactly one of them.

    ``hits`` are rows whose key is known, with ``found_id``: the first master record of the key, or, for a
    key that the master lacks, the first row of the batch that has it.  ``fresh`` are those first rows of
    new keys, to be appended to the master, and all rows with an empty key.
    """
    # Stored once: the master is read and digested a single time, however often the two results are.
    looked = write_out(key_lookup(batch, master, key, id_col, settings), "looked")
    missed = looked.where("found_id is null").withColumn("_digest", digest(F.col(key)))
    again = attach_first(missed, "_digest", id_col, settings).drop("_digest")
    repeats = F.col("first_id").isNotNull() & (F.col("first_id") != F.col(id_col))
    later = again.where(repeats).withColumn("found_id", F.col("first_id")).drop("first_id")
    hits = looked.where("found_id is not null").unionByName(later)
    return hits, again.where(~repeats).drop("found_id", "first_id")
