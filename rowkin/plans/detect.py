"""The full cascade: one outcome per record.

Tiers run in order and each sees only what the earlier ones left over: exact key, email, phone, id
code, similar name.  Every tier is an aggregation and a join on narrow rows, written to the shared
folder, so later tiers read a short lineage and only the columns they need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowkin.operators.names import match_names
from rowkin.operators.skew import attach_first
from rowkin.plans.records import match_rows
from rowkin.scratch import Stored, store, write_out
from rowkin.settings import DEFAULTS, MatchSettings

# Names of the outcomes; the confidences are in KEY_TIERS.
EXACT = "Exact Duplicate"
PARTIAL = "Partial Duplicate"
POSSIBLE = "Possible Duplicate"

OUTCOME_COLUMNS = ("record_id", "is_duplicate", "duplicate_of_id", "duplicate_type", "matched_on", "confidence")


@dataclass(frozen=True)
class Tier:
    """One key tier: the column it matches on, and the outcome it gives."""

    key: str
    kind: str
    matched_on: str
    confidence: float


KEY_TIERS = (
    Tier("digest", EXACT, "primary_key", 100.0),
    Tier("email", PARTIAL, "email", 95.0),
    Tier("phone", PARTIAL, "phone", 90.0),
    Tier("id_code", PARTIAL, "id_code", 95.0),
)


@dataclass(frozen=True)
class TierRun:
    """What a tier saw, what it decided, and what it left over."""

    tier: Tier
    seen: DataFrame
    outcome: DataFrame
    left_over: DataFrame


def run_key_tiers(
    records: DataFrame, last: str = "id_code", settings: MatchSettings = DEFAULTS
) -> tuple[list[TierRun], Stored]:
    """Run the key tiers up to the one that matches on ``last``; also gives the narrow rows.

    A record that a tier matches takes no part in later tiers, neither as duplicate nor as anchor.
    """
    stored = store(match_rows(records), "match-rows")
    waiting = stored.table
    runs = []
    for tier in KEY_TIERS:
        if tier.key in waiting.columns:
            flagged = attach_first(waiting, tier.key, settings=settings, total=stored.rows)
            seen = write_out(flagged, f"tier-{tier.matched_on}")
            outcome = _outcome(
                seen.where("id > first_id"),
                F.col("first_id"),
                tier.kind,
                tier.matched_on,
                F.lit(tier.confidence),
            )
            # The digest is as wide as all other columns together and of no more use.
            waiting = seen.where("first_id is null or id = first_id").drop("first_id", "digest")
            runs.append(TierRun(tier, seen.drop("first_id"), outcome, waiting))
        if tier.matched_on == last:
            break
    return runs, stored


def match_tier(records: DataFrame, matched_on: str, settings: MatchSettings = DEFAULTS) -> DataFrame:
    """The duplicates that one key tier finds among what the tiers before it left over."""
    runs, _ = run_key_tiers(records, matched_on, settings)
    found = [run.outcome for run in runs if run.tier.matched_on == matched_on]
    if not found:
        raise ValueError(f"the records have no {matched_on} field")
    return found[0]


def detect(records: DataFrame, settings: MatchSettings = DEFAULTS) -> DataFrame:
    """Outcome of every record: unique, or duplicate of an earlier one, with the reason.

    ``records`` comes from one of the functions in :mod:`rowkin.plans.records`.
    """
    runs, stored = run_key_tiers(records, settings=settings)
    outcomes = [run.outcome for run in runs]
    waiting = runs[-1].left_over
    if "name" in waiting.columns:
        # Records without any usable field have no key and no name: they stay unique.
        similar = match_names(waiting, settings, stored.rows)
        confidence = F.bround(F.col("similarity") * 100, 1)
        outcomes.append(_outcome(similar, F.col("anchor"), POSSIBLE, "name", confidence))
        waiting = waiting.join(similar.select("id"), "id", "left_anti")
    outcomes.append(_outcome(waiting, F.lit(None), None, None, F.lit(0.0)))
    whole = outcomes[0]
    for outcome in outcomes[1:]:
        whole = whole.unionByName(outcome)
    return whole


def _outcome(
    rows: DataFrame, anchor: Column, kind: str | None, matched_on: str | None, confidence: Column
) -> DataFrame:
    return rows.select(
        F.col("id").alias("record_id"),
        F.lit(kind is not None).alias("is_duplicate"),
        anchor.cast("bigint").alias("duplicate_of_id"),
        F.lit(kind).cast("string").alias("duplicate_type"),
        F.lit(matched_on).cast("string").alias("matched_on"),
        confidence.cast("double").alias("confidence"),
    )


def with_outcomes(records: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Records with their outcome columns: one shuffle on the record id."""
    return records.join(outcomes, "record_id")
