"""Fates in the lexicographically first maximal independent set, many steps to a job.

A record is unique if none of its earlier partners is.  Taken one layer at a time that needs as many rounds as
the longest chain of partners has links.  Here a round does three things instead:

1. Pairs are put into ranges of their later record, so a task has all earlier partners of its records, in
   order.  It follows the definition from record to record.  Where a record hangs on one it cannot know, it
   says so: "as", or "against", that one.  Two partners of which one must be unique settle it all the same.
2. Records that follow a record of another range are contracted by pointer doubling, so a chain over n ranges
   takes log n steps.
3. Only records that hang on several others wait for the next round.

A task holds one small entry per record of its range, and a hot record is spread by the number of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.operators.skew import left_join_by_key
from rowkin.scratch import Stored, store
from rowkin.settings import DEFAULTS, MatchSettings

# Fates; the records of the last two are open.
UNIQUE, BEATEN, FOLLOWS, OPEN = range(4)
_SCHEMA = "id bigint, fate int, leader bigint, against boolean, links bigint, moved boolean"


def fates(pairs: Stored, settings: MatchSettings = DEFAULTS) -> Stored:
    """``(id, fate, leader, against, links)`` of every later record of ``(i, j)`` pairs, and how many are ``open``.

    ``i`` is the later record of a pair, ``j`` the earlier one.  Records that are never the later one are
    unique and not listed.  FOLLOWS is as unique as ``leader``, or exactly if that is not, if ``against``.
    ``links`` is the length of the chain that was followed to the fate.
    """
    placed = _with_known_partners(pairs, settings).repartitionByRange("i").sortWithinPartitions("i", "j")
    told = _store(placed.mapInArrow(_followed, _SCHEMA))
    moved = told.figures["follows"]
    while moved:
        told = _store(_jumped(told, settings))
        moved = told.figures["moved"]
    return told


def _store(rows: DataFrame) -> Stored:
    fate = F.col("fate")
    return store(
        rows, "fates", open=F.count_if(fate >= FOLLOWS), follows=F.count_if(fate == FOLLOWS), moved=F.count_if("moved"),
        links=F.max("links"),
    )


def _with_known_partners(pairs: Stored, settings: MatchSettings) -> DataFrame:
    """``(i, j, waits)``: whether the earlier partner has earlier partners itself; without any it is unique."""
    ends = pairs.table.select(
        F.inline(
            F.array(
                F.struct(F.col("i").alias("id"), F.lit(1).alias("later")),
                F.struct(F.col("j").alias("id"), F.lit(0).alias("later")),
            )
        )
    )
    # Partial aggregation first: a record with very many pairs sends one row per task.
    per_id = ends.groupBy("id").agg(F.max("later").alias("later"), F.count(F.lit(1)).alias("n")).where("later = 1")
    known = per_id.select(F.col("id").alias("j"), "n")
    met = left_join_by_key(pairs.table, known, "j", F.col("i"), settings=settings, total=pairs.rows)
    return met.select("i", "j", F.col("n").isNotNull().alias("waits"))


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fates of one range, from its pairs in order of ``i``."""
    known: dict[int, tuple[int, int | None, bool, int]] = {}
    now, beaten, leaders, links = None, False, {}, 0

    def fate() -> tuple[int, int | None, bool, int]:
        if beaten:
            return BEATEN, None, False, links
        if not leaders:
            return UNIQUE, None, False, links
        if len(leaders) > 1:
            return OPEN, None, False, links
        (leader, against), = leaders.items()
        return FOLLOWS, leader, not against, links

    def emitted(rows: list[tuple]) -> pa.RecordBatch:
        names = ["id", "fate", "leader", "against", "links", "moved"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_()]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        rows = []
        for i, j, waits in zip(*(batch[c].to_pylist() for c in ("i", "j", "waits")), strict=True):
            if i != now:
                if now is not None:
                    known[now] = fate()
                    rows.append((now, *known[now], False))
                now, beaten, leaders, links = i, False, {}, 0
            if beaten:
                continue
            # A partner of another range, or one that hangs on several, speaks for itself.
            found, leader, against, before = known.get(j, (FOLLOWS, j, False, 0)) if waits else (UNIQUE, None, False, 0)
            links = max(links, before + 1)
            if found == OPEN:
                found, leader, against = FOLLOWS, j, False
            if found == UNIQUE or found == FOLLOWS and leaders.get(leader, against) != against:
                beaten = True
            elif found == FOLLOWS:
                leaders[leader] = against
        yield emitted(rows)
    if now is not None:
        yield emitted([(now, *fate(), False)])


def _jumped(told: Stored, settings: MatchSettings) -> DataFrame:
    """Every record that follows another takes over its leader's fate, or its leader's leader."""
    table = told.table.drop("moved")
    followers = table.where(F.col("fate") == FOLLOWS).groupBy(F.col("leader").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    leaders = table.join(followers, "id").select(
        F.col("id").alias("leader"), F.col("fate").alias("its"), F.col("leader").alias("next"), F.col("against").alias("turned"),
        F.col("links").alias("before"), "n",
    )
    met = left_join_by_key(table, leaders, "leader", F.col("id"), settings=settings, total=told.rows)
    # A leader that hangs on several others stays the leader.
    moves = F.coalesce(F.col("its") != OPEN, F.lit(False))
    unique = (F.col("its") == UNIQUE) != F.col("against")
    follows_on = moves & (F.col("its") == FOLLOWS)
    return met.select(
        "id",
        F.when(moves & ~follows_on, F.when(unique, UNIQUE).otherwise(BEATEN)).otherwise(F.col("fate")).alias("fate"),
        F.when(follows_on, F.col("next")).when(~moves, F.col("leader")).alias("leader"),
        F.when(follows_on, F.col("against") != F.col("turned")).otherwise(F.col("against")).alias("against"),
        F.when(moves, F.col("links") + F.col("before")).otherwise(F.col("links")).alias("links"),
        moves.alias("moved"),
    )
