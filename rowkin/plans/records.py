"""Records: raw rows with their canonical fields and composite key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowkin.functions.fields import FieldMap, map_of, normalized_map, raw_map
from rowkin.functions.keys import IDENTIFIERS, composite_key, composite_key_of_columns
from rowkin.operators.blocking import CONTEXT_FIELDS
from rowkin.operators.exact import digest

# The canonical fields the matching tiers read.
MATCH_FIELDS = ("name", *CONTEXT_FIELDS, *IDENTIFIERS)


def clean_columns(
    df: DataFrame, id_col: str, columns: list[str] | None = None, fields: FieldMap | None = None
) -> DataFrame:
    """Wide path: ``record_id``, one column per canonical field, and ``primary_key``.

    ``columns`` are the data columns, by default all but ``id_col``.
    """
    fields = fields or FieldMap()
    columns = columns or [c for c in df.columns if c != id_col]
    staged = df.select(
        F.col(id_col).alias("record_id"),
        *[value.alias(field) for field, value in fields.cleaned(columns).items()],
    )
    by_field = {field: F.col(f"`{field}`") for field in fields.sources(columns)}
    return staged.withColumn("primary_key", composite_key_of_columns(by_field))


def records_from_columns(
    df: DataFrame, id_col: str, columns: list[str] | None = None, fields: FieldMap | None = None
) -> DataFrame:
    """Wide path to the ``record_id, raw, canonical, normalized, primary_key`` schema."""
    fields = fields or FieldMap()
    columns = columns or [c for c in df.columns if c != id_col]
    cleaned = {field: (f"clean {field}", value) for field, value in fields.cleaned(columns).items()}
    by_field = {field: F.col(f"`{staged}`") for field, (staged, _) in cleaned.items()}
    canonical = df.select(
        F.col(id_col).alias("record_id"),
        raw_map(columns).alias("raw"),
        *[value.alias(staged) for staged, value in cleaned.values()],
    ).select(
        "record_id",
        "raw",
        map_of(by_field).alias("canonical"),
        composite_key_of_columns(by_field).alias("primary_key"),
    )
    normalized = normalized_map(F.col("raw"), F.col("canonical"))
    return canonical.select("record_id", "raw", "canonical", normalized.alias("normalized"), "primary_key")


def records_from_maps(df: DataFrame, raw: str = "raw", fields: FieldMap | None = None) -> DataFrame:
    """Map path: add ``canonical``, ``normalized`` and ``primary_key`` to rows with a raw map."""
    fields = fields or FieldMap()
    return (
        df.withColumn("canonical", fields.clean_map(F.col(raw)))
        .withColumn("normalized", normalized_map(F.col(raw), F.col("canonical")))
        .withColumn("primary_key", composite_key(F.col("canonical")))
    )


def match_rows(records: DataFrame) -> DataFrame:
    """The narrow rows the tiers work on: ``id``, key digest, identifiers, name and contexts.

    ``records`` has either a ``canonical`` map or one column per canonical field; a missing value is
    NULL in the result.
    """
    if "canonical" in records.columns:
        present = {f: F.try_element_at(F.col("canonical"), F.lit(f)) for f in MATCH_FIELDS}
    else:
        present = {f: F.when(F.col(f) != "", F.col(f)) for f in MATCH_FIELDS if f in records.columns}
    return records.select(
        F.col("record_id").alias("id"),
        digest(F.col("primary_key")).alias("digest"),
        *[value.alias(field) for field, value in present.items()],
    )
