"""Possible duplicates: each record takes the first earlier unique record with a similar name.

A record is unique when no earlier *unique* record matches it, which is the lexicographically first
maximal independent set of the match graph.  It is computed as Spark jobs (Blelloch, Fineman, Shun
2012, "Greedy Sequential Maximal Independent Set and Matching are Parallel on Average"):

1. records with one name and one set of contexts collapse to their first record;
2. a front of the earliest waiting names is taken, as long as its candidate pairs stay within a
   budget that is linear in the waiting names; dense neighbourhoods make the front shorter, so a
   cluster of n similar names never forms its n * n pairs;
3. inside the front, rounds settle all names whose fate follows from one range of ids, and chains of
   names that each hang on one other, however long;
4. the new unique names claim their later neighbours, which leave; then the next front is taken.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.operators import chains
from rowkin.operators.blocking import (
    CONTEXT_FIELDS,
    MIN_NAME,
    long_side,
    measure,
    scoped_names,
    short_side,
    store_names,
    verified_pairs,
)
from rowkin.operators.skew import attach_first, left_join_by_key
from rowkin.scratch import Growing, Stored, store, write_out
from rowkin.settings import DEFAULTS, MatchSettings


def name_profiles(
    rows: DataFrame, settings: MatchSettings = DEFAULTS, total: int | None = None
) -> DataFrame:
    """``rows`` with ``first_id``: the first record with the same name and contexts.

    Only rows with a comparable name are kept.  A context is NULL, "" or no column when missing.
    """
    context = lambda field: F.coalesce(F.col(field), F.lit("")) if field in rows.columns else F.lit("")
    named = rows.where(F.length("name") >= MIN_NAME).select(
        "id", "name", *[context(field).alias(field) for field in CONTEXT_FIELDS]
    )
    profile = F.sha2(F.to_json(F.array("name", *CONTEXT_FIELDS)), 256)
    keyed = named.withColumn("profile", profile)
    return attach_first(keyed, "profile", settings=settings, total=total).drop("profile")


def possible_pairs(rows: DataFrame, settings: MatchSettings = DEFAULTS) -> DataFrame:
    """``(i, j, similarity)`` of all matching pairs of name profiles, by the id of their first record."""
    named = store(rows.drop("digest"), "match-rows")
    firsts = name_profiles(named.table, settings, named.rows).where("first_id is null or id = first_id")
    names = store_names(scoped_names(firsts, settings, named.rows))
    return verified_pairs(_candidates(names.table, names.table, names.figures, settings))


def _candidates(shorter: DataFrame, longer: DataFrame, figures: dict, settings: MatchSettings):
    short, long = short_side(shorter, figures, settings), long_side(longer, figures, settings)
    return measure(short, long, settings, figures["rows"])


def match_names(
    rows: DataFrame, settings: MatchSettings = DEFAULTS, total: int | None = None
) -> DataFrame:
    """``(id, anchor, similarity)`` of the possible duplicates among ``(id, name, contexts)`` rows.

    ``total`` is an upper bound of the number of rows, where it is known.
    """
    profiles = store(name_profiles(rows, settings, total), "profiles")
    firsts = profiles.table.where("first_id is null or id = first_id")
    settled = _settle(firsts, profiles.rows, settings)
    copies = profiles.table.where("id > first_id").select("id", "first_id")
    # A copy follows its first record: to its anchor, or to the record itself when that is unique.
    per_first = copies.groupBy("first_id").agg(F.count(F.lit(1)).alias("n"))
    per_first = per_first.join(settled.withColumnRenamed("id", "first_id"), "first_id", "left")
    followed = left_join_by_key(
        copies, per_first, "first_id", F.col("id"), settings=settings, total=profiles.rows
    ).select(
        "id",
        F.coalesce("anchor", "first_id").alias("anchor"),
        F.coalesce("similarity", F.lit(1.0)).alias("similarity"),
    )
    return settled.unionByName(followed)


def _settle(firsts: DataFrame, total: int, settings: MatchSettings) -> DataFrame:
    names = store_names(scoped_names(firsts, settings, total))
    waiting, figures = names.table, names.figures
    found = Growing(firsts.sparkSession, "settled")
    while True:
        front, cut, candidates = _take_front(waiting, figures, total, settings)
        pairs = store(verified_pairs(candidates), "pairs")
        beaten = _eliminate(pairs, settings)
        found.add(_first_anchor(pairs.table.join(beaten.withColumnRenamed("id", "j"), "j", "left_anti")))
        if cut is None:
            return found.table().drop("step")
        unique = front.join(beaten, "id", "left_anti")
        later = waiting.where(F.col("id") > cut)
        claimed = found.add(_first_anchor(_across(unique, later, figures, settings))).table
        waiting = write_out(later.join(claimed.select("id"), "id", "left_anti"), "names")


def _take_front(waiting: DataFrame, figures: dict, total: int, settings: MatchSettings):
    """The earliest names whose candidate pairs fit the budget, and the id the front ends with.

    All waiting names are tried first; the end is None when they fit.
    """
    budget = max(settings.pair_budget, settings.pairs_per_name * total)
    front, cut = waiting, None
    while True:
        candidates = _candidates(front, front, figures, settings)
        if candidates.pairs <= budget:
            return front, cut, candidates
        smaller = _cut(front, min(0.5, sqrt(budget / candidates.pairs)))
        if smaller == cut:
            return front, cut, candidates  # a single name
        cut = smaller
        front = waiting.where(F.col("id") <= cut)


def _cut(names: DataFrame, share: float):
    """Id that ends the first ``share`` of the names; a sketch, as any front is right.

    Its error is relative to the names it is given, so cutting a front again always shrinks it.
    """
    first = F.percentile_approx("id", F.lit(share), F.lit(10_000)).alias("cut")
    return names.where("scope = ''").agg(first).first()["cut"]


def _across(unique: DataFrame, later: DataFrame, figures: dict, settings: MatchSettings) -> DataFrame:
    """Matching pairs of a settled unique name and a later name."""
    forth = verified_pairs(_candidates(unique, later, figures, settings))
    back = verified_pairs(_candidates(later, unique, figures, settings))
    return forth.unionByName(back)


def _first_anchor(pairs: DataFrame) -> DataFrame:
    """The earliest partner of every later record."""
    return pairs.groupBy(F.col("i").alias("id")).agg(
        F.min("j").alias("anchor"), F.min_by("similarity", "j").alias("similarity")
    )


def _eliminate(pairs: Stored, settings: MatchSettings) -> DataFrame:
    """``(id)`` of the records with an earlier unique partner.

    A round settles every record whose fate follows from what one range of ids knows, and whole chains of
    records that hang on a single other one.  Beaten records leave with their pairs; the rest goes on.
    """
    beaten = Growing(pairs.table.sparkSession, "beaten")
    waiting, links = Stored(pairs.table.select("i", "j"), pairs.rows, {}), 0
    while True:
        fates = chains.fates(waiting, settings)
        links += fates.figures["links"] or 0
        if settings.max_rounds is not None and links > settings.max_rounds:
            raise RuntimeError(f"names that settle each other in a chain of {links} links; raise max_rounds")
        lost = beaten.add(fates.table.where(F.col("fate") == chains.BEATEN).select("id"))
        if not fates.figures["open"]:
            return beaten.table().select("id")
        still = fates.table.where(F.col("fate") >= chains.FOLLOWS).select(F.col("id").alias("i"))
        rest = waiting.table.join(still, "i", "left_semi")
        waiting = store(rest.join(lost.table.withColumnRenamed("id", "j"), "j", "left_anti"), "open")
