"""Records from cell grids: worksheets and document tables.

Input: ``source_file, grid_id, row_no, cells ARRAY<STRING>``, where row 1 of a grid is its header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowkin.functions.fields import last_per_key
from rowkin.functions.text import strip
from rowkin.operators.skew import left_join_by_key
from rowkin.scratch import store
from rowkin.sources.cards import paragraph_records


def _names(cells: Column, blank_named: bool) -> Column:
    """Header names; a missing cell, or with ``blank_named`` also a blank one, becomes ``col_i``."""

    def name(cell: Column, i: Column) -> Column:
        fallback = F.concat(F.lit("col_"), i.cast("string"))
        text = F.coalesce(strip(cell), fallback)
        return F.when(text == "", fallback).otherwise(text) if blank_named else text

    return F.transform(cells, name)


def grid_records(grids: DataFrame, file_type: str = "Excel (.xlsx)", blank_named: bool = False) -> DataFrame:
    """Raw records of grids; rows without any cell are skipped.

    ``blank_named``: a blank header cell is named like a missing one, as in document tables; otherwise
    it keeps its empty name.
    """
    # The length keeps the two parts of the key apart.
    identity = F.concat(F.length("source_file").cast("string"), F.lit(":"), "source_file", F.col("grid_id").cast("string"))
    grids = grids.withColumn("_grid", identity)
    headers = grids.where("row_no = 1").select("_grid", _names(F.col("cells"), blank_named).alias("names"))
    # Settled once per grid; cells beyond the header are named by their place and could only clash with
    # a header cell of that very name.
    plain = (F.size(F.array_distinct("names")) == F.size("names")) & ~F.exists("names", lambda n: n.rlike(r"^col_\d+$"))
    headers = headers.withColumn("plain", plain | (F.size("names") == 0))
    present = (lambda c: F.coalesce(strip(c), F.lit("")) != "") if blank_named else (lambda c: c.isNotNull())
    body = grids.where("row_no > 1").where(F.exists("cells", present))
    entries = F.transform(
        "cells",
        lambda cell, i: F.struct(
            F.coalesce(F.get("names", i), F.concat(F.lit("col_"), i.cast("string"))).alias("key"),
            F.coalesce(strip(cell), F.lit("")).alias("value"),
        ),
    )
    # A grid may hold a large share of all rows, so its header is joined by the number of its rows.
    sizes = body.groupBy("_grid").agg(F.count(F.lit(1)).alias("n"))
    sized = store(headers.join(sizes, "_grid"), "grids", total=F.sum("n"))
    total = sized.figures["total"] or 0
    named = left_join_by_key(body, sized.table, "_grid", F.col("row_no"), total=total).where("n is not null")
    return named.select(
        "source_file",
        F.lit(file_type).alias("file_type"),
        F.col("row_no").cast("bigint").alias("line_number"),
        F.when(F.col("plain"), F.map_from_entries(entries)).otherwise(last_per_key(entries)).alias("raw"),
    )


def document_records(grids: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Records of documents: their tables, or their paragraph cards where no table gives a record."""
    tables = grid_records(grids, "Word (.docx)", blank_named=True)
    rest = paragraphs.join(tables.select("source_file").distinct(), "source_file", "left_anti")
    return tables.unionByName(paragraph_records(rest))
