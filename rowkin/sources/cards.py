"""Records written as text: key-value cards, delimited lines, report rows, paragraphs.

A document is one row; documents are parallel, the boundary between two cards is a fold over the
lines of a document, as it depends on the keys seen since the last boundary.  The fold goes piece by piece:
finished cards are only copied within the piece of ``PIECE`` lines they end in, so the work grows with the
number of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowkin.functions.fields import last_per_key
from rowkin.functions.text import BLANK, BLANK_CHARS, document_lines, let, strip
from rowkin.sources.files import read_documents, with_path

# A line that separates cards, and a line that holds a field.
SEPARATOR_LINE = r"(?iU)^(?:[-=_*]{3,}|record\s*#?\d+|student\s*#?\d+|employee\s*#?\d+)"
FIELD_LINE = rf"^([A-Za-z0-9_{BLANK_CHARS}]{{2,25}}){BLANK}*[:=\-]{BLANK}*(.+)$"

# Delimiters of plain text tables in order of preference, and of report rows.
TEXT_DELIMITERS = (",", "|", "\t", ";")
REPORT_DELIMITERS = r"[,|\t]"

#: Lines that are folded together.
PIECE = 256

_ENTRIES = "array<struct<key:string,value:string>>"
_CARDS = f"array<struct<line_number:bigint,fields:{_ENTRIES}>>"


def fold_cards(lines: Column, closes) -> Column:
    """``(line_number, raw)`` cards of an array of lines.

    ``closes(line)`` tells a line that ends the card without adding to it.  A field whose key, ignoring
    case, is already on the card also ends it, and starts the next one.
    """
    key = lambda line: strip(F.regexp_extract(line, FIELD_LINE, 1))
    parsed = F.transform(
        lines,
        lambda line, i: F.struct(
            (i + 1).cast("bigint").alias("line_number"),
            closes(line).alias("closes"),
            key(line).alias("key"),
            strip(F.regexp_extract(line, FIELD_LINE, 2)).alias("value"),
        ),
    )
    none = F.array()
    nothing = none.cast(_CARDS).alias("done")
    start = F.struct(
        none.cast("array<string>").alias("seen"),
        none.cast(_ENTRIES).alias("fields"),
        none.cast(f"array<{_CARDS}>").alias("pieces"),
    )

    def close(state: Column, line_number: Column) -> Column:
        card = F.struct(line_number.alias("line_number"), state["fields"].alias("fields"))
        return F.when(F.size(state["seen"]) > 0, F.concat(state["done"], F.array(card))).otherwise(state["done"])

    def step(state: Column, line: Column) -> Column:
        is_field = ~line["closes"] & (line["key"] != "")
        lowered = F.lower(line["key"])
        ends = line["closes"] | (is_field & F.array_contains(state["seen"], lowered))
        seen = F.when(ends, none.cast("array<string>")).otherwise(state["seen"])
        fields = F.when(ends, none.cast(_ENTRIES)).otherwise(state["fields"])
        entry = F.struct(line["key"].alias("key"), line["value"].alias("value"))
        grown = F.struct(
            F.when(is_field, F.concat(seen, F.array(lowered))).otherwise(seen).alias("seen"),
            F.when(is_field, F.concat(fields, F.array(entry))).otherwise(fields).alias("fields"),
            F.when(ends, close(state, line["line_number"])).otherwise(state["done"]).alias("done"),
        )
        return F.when(is_field | ends, grown).otherwise(state)

    def fold_piece(state: Column, piece: Column) -> Column:
        inner = F.aggregate(piece, F.struct(state["seen"], state["fields"], nothing), step)
        return let(
            inner,
            lambda r: F.struct(r["seen"], r["fields"], F.concat(state["pieces"], F.array(r["done"])).alias("pieces")),
        )

    def finish(state: Column) -> Column:
        last = F.struct(state["seen"], state["fields"], nothing)
        return F.flatten(F.concat(state["pieces"], F.array(close(last, F.size(lines).cast("bigint")))))

    def fold(found: Column) -> Column:
        starts = F.when(F.size(found) > 0, F.sequence(F.lit(1), F.size(found), F.lit(PIECE))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(F.transform(starts, lambda i: F.slice(found, i, F.lit(PIECE))), start, fold_piece, finish)

    return F.transform(
        let(parsed, fold),
        lambda card: F.struct(card["line_number"], F.map_from_entries(card["fields"]).alias("raw")),
    )


def text_cards(text: Column) -> Column:
    """Cards of a text document; line numbers count its non-empty lines."""
    return let(document_lines(text), lambda lines: fold_cards(lines, _separates))


def _separates(line: Column) -> Column:
    return line.rlike(SEPARATOR_LINE)


def paragraph_cards(paragraphs: Column) -> Column:
    """Cards of a list of paragraphs, where a blank paragraph ends the card."""
    return let(F.transform(paragraphs, strip), lambda lines: fold_cards(lines, lambda line: line == ""))


def delimited_rows(text: Column) -> Column:
    """``(line_number, raw)`` rows of a text table: its first line is the header."""

    def rows(lines: Column) -> Column:
        header = F.get(lines, F.lit(0))
        sep = F.lit(None).cast("string")
        for mark in reversed(TEXT_DELIMITERS):
            sep = F.when(F.contains(header, F.lit(mark)), F.lit(mark)).otherwise(sep)
        pattern = F.concat(F.lit("\\Q"), sep, F.lit("\\E"))
        cells = lambda line: F.transform(F.split(line, pattern), strip)

        def with_names(names: Column) -> Column:
            def row(line: Column, i: Column) -> Column:
                entries = F.transform(
                    cells(line),
                    lambda cell, c: F.struct(
                        F.coalesce(F.get(names, c), F.concat(F.lit("col_"), c.cast("string"))).alias("key"),
                        cell.alias("value"),
                    ),
                )
                return F.struct((i + 1).cast("bigint").alias("line_number"), last_per_key(entries).alias("raw"))

            numbered = F.filter(F.transform(lines, row), lambda r: r["line_number"] > 1)
            return F.filter(numbered, lambda r: F.exists(F.map_values(r["raw"]), lambda v: v != ""))

        return F.when(sep.isNotNull(), let(cells(header), with_names))

    return let(document_lines(text), rows)


def report_rows(text: Column) -> Column:
    """``(line_number, raw)`` rows of a report: cells named ``field_1``, ... and blank cells left out."""

    def row(line: Column, i: Column) -> Column:
        entries = F.transform(
            F.split(line, REPORT_DELIMITERS),
            lambda cell, c: F.struct(
                F.concat(F.lit("field_"), (c + 1).cast("string")).alias("key"), strip(cell).alias("value")
            ),
        )
        kept = F.filter(entries, lambda e: e["value"] != "")
        return F.struct((i + 1).cast("bigint").alias("line_number"), F.map_from_entries(kept).alias("raw"))

    return let(
        document_lines(text),
        lambda lines: F.filter(
            F.transform(lines, lambda line, i: F.when(line.rlike(REPORT_DELIMITERS), row(line, i))),
            lambda r: r.isNotNull() & (F.size(r["raw"]) > 0),
        ),
    )


def _records(documents: DataFrame, file_type: str, found: Column) -> DataFrame:
    path = with_path(documents)
    return documents.select("source_file", F.lit(file_type).alias("file_type"), F.inline(found), *path).select(
        "source_file", "file_type", "line_number", "raw", *path
    )


def _cards_or(cards: Column, other: Column) -> Column:
    return let(cards, lambda found: F.when(F.size(found) > 0, found).otherwise(other))


def text_records(documents: DataFrame) -> DataFrame:
    """Raw records of ``(source_file, text)``: cards, or a delimited table if there is no card."""
    text = F.col("text")
    return _records(documents, "TXT", _cards_or(text_cards(text), delimited_rows(text)))


def report_records(documents: DataFrame) -> DataFrame:
    """Raw records of the extracted text of reports: cards, or rows of cells if there is no card."""
    text = F.col("text")
    return _records(documents, "PDF", _cards_or(text_cards(text), report_rows(text)))


def paragraph_records(documents: DataFrame) -> DataFrame:
    """Raw records of ``(source_file, paragraphs)``."""
    return _records(documents, "Word (.docx)", paragraph_cards(F.col("paragraphs")))


def scan_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return text_records(read_documents(spark, paths))
