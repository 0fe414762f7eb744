"""Tuning knobs of the matching operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

#: Rows that a task of a large shuffle takes; some 100 bytes each.
ROWS_PER_TASK = 1_500_000


@dataclass(frozen=True)
class MatchSettings:
    """None of these changes a result; they only steer how the work is cut up.

    hot_rows        rows of one key that a single task may take; a hotter key is salted into
                    ceil(rows / hot_rows) parts.
    hot_keys        bound of the broadcast list of hot keys; with keys of 64 bytes the default stays below
                    4 MB.  A key is hot only if it has more than 1 / hot_keys of all rows, too, which keeps
                    the list complete within the bound.
    broadcast_rows  longest list of key digests that is broadcast on purpose: 32 bytes each, about 20 MB
                    at the default.  Longer lists are joined by a shuffle.
    small_context   members of a context up to which all of them are compared; larger contexts are
                    compared by segment signatures.  About as many comparisons as a 20 character
                    name has signatures.
    large_context   members of a context from which on short names have to share two pieces instead of one: more
                    signatures a name, far fewer candidates.  Longer names, which have more signatures, change
                    over later.
    halved_context  members of a context from which on names of up to 13 letters have to share a half but for one letter:
                    some 60 signatures a name, and about one candidate per 20,000 members.
    pair_budget     candidate pairs of one name-matching round below which the round is not cut.
    pairs_per_name  candidate pairs per waiting name allowed in a round above that budget.
    max_rounds      stop with an error where names settle each other in a chain of more links than that; None
                    means no limit.
    """

    hot_rows: int = 200_000
    hot_keys: int = 50_000
    broadcast_rows: int = 500_000
    small_context: int = 400
    large_context: int = 50_000
    halved_context: int = 5_000
    pair_budget: int = 5_000_000
    pairs_per_name: int = 100
    max_rounds: int | None = None


DEFAULTS = MatchSettings()


def tasks_for(spark: SparkSession, rows: float) -> int | None:
    """Tasks for this many rows, None where the session's number of shuffle partitions is enough."""
    tasks = int(-(-rows // ROWS_PER_TASK))
    return tasks if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else None
