"""Why two records belong together: matched fields and an explanation text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.operators.blocking import CONTEXT_FIELDS
from rowkin.operators.skew import left_join_by_key
from rowkin.plans.detect import EXACT, PARTIAL
from rowkin.settings import DEFAULTS, MatchSettings


def with_anchor(records: DataFrame, outcomes: DataFrame, settings: MatchSettings = DEFAULTS) -> DataFrame:
    """Duplicates with their own and their anchor's canonical map.

    One anchor may have very many duplicates, so that join is balanced by the number of them.
    """
    slim = records.select("record_id", "canonical", "primary_key")
    duplicates = outcomes.where("is_duplicate").join(slim, "record_id")
    wanted = outcomes.where("is_duplicate").groupBy("duplicate_of_id").agg(F.count(F.lit(1)).alias("n"))
    anchors = wanted.join(
        slim.select(F.col("record_id").alias("duplicate_of_id"), F.col("canonical").alias("anchor_canonical")),
        "duplicate_of_id",
    )
    return left_join_by_key(duplicates, anchors, "duplicate_of_id", F.col("record_id"), settings=settings).drop("n")


def details(records: DataFrame, outcomes: DataFrame, settings: MatchSettings = DEFAULTS) -> DataFrame:
    """Duplicates with ``matched_fields`` and ``explanation``.

    Exact: all fields.  Partial: fields equal in both, the matched one among them.  Possible: fields
    present in both, equal or not.
    """
    both = with_anchor(records, outcomes, settings)
    own, other = F.col("canonical"), F.col("anchor_canonical")
    equal = F.map_keys(F.map_filter(own, lambda k, v: F.coalesce(F.try_element_at(other, k) == v, F.lit(False))))
    matched = (
        F.when(F.col("duplicate_type") == EXACT, F.map_keys(own))
        .when(F.col("duplicate_type") == PARTIAL, F.array_union(equal, F.array("matched_on")))
        .otherwise(F.array_intersect(F.map_keys(own), F.map_keys(other)))
    )
    value = lambda m, f: F.try_element_at(m, F.lit(f))
    same_context = F.lit(False)
    for field in CONTEXT_FIELDS:
        same_context = same_context | F.coalesce(value(own, field) == value(other, field), F.lit(False))
    # The three sentences.
    explanation = (
        F.when(
            F.col("duplicate_type") == EXACT,
            F.format_string("Exact match on normalized composite key: '%s'.", "primary_key"),
        )
        .when(
            F.col("duplicate_type") == PARTIAL,
            F.format_string(
                "Partial match: Identical %s ('%s') with varying schema attributes.",
                "matched_on",
                F.try_element_at(own, F.col("matched_on")),
            ),
        )
        .otherwise(
            F.format_string(
                "Possible match: Name '%s' is %s%% similar to '%s'%s.",
                value(own, "name"),
                F.col("confidence").cast("string"),
                value(other, "name"),
                F.when(same_context, F.lit(" in same department/organization")).otherwise(F.lit("")),
            )
        )
    )
    return both.select(
        *outcomes.columns, matched.alias("matched_fields"), explanation.alias("explanation")
    )
