"""Records of delimited files whose quoted cells may hold line breaks, read by as many tasks as a file has splits.

Whether a line break ends a record depends on all quotes before it, so a reader that only knows this rule has to
take a file from its start.  Here every split is read once, for both cases: that it starts outside and that it
starts inside a quoted cell.  Each split then is a function of two values, a fold over the splits of a file tells
which case is the true one, and so every line knows whether it starts a record, and which.  Lines that are a
record by themselves, nearly all, are parsed where they are; only the others are gathered by their record.

Cells follow the usual rules of the format: a quote opens a cell only at its start, a doubled one stands for
itself, and what follows a closing quote belongs to the cell as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowkin.functions.text import let, strip
from rowkin.scratch import write_out
from rowkin.sources.files import own_path

_MARK = b"\xef\xbb\xbf"  # the byte order mark, no part of the first cell

_LINES = (
    "path string, block bigint, at bigint, sep string, encoding string, value binary, "
    "inside0 boolean, inside1 boolean, open0 boolean, open1 boolean, start0 bigint, start1 bigint, nth0 bigint, nth1 bigint"
)


def stays_open(line: bytes, sep: bytes, inside: bool) -> bool:
    """Whether a line that starts outside or ``inside`` a quoted cell ends within one."""
    at = 0
    while True:
        if not inside:
            if not line.startswith(b'"', at):
                at = line.find(sep, at) + len(sep)
                if at < len(sep):
                    return False
                continue
            at += 1
        inside = False
        while (at := line.find(b'"', at)) >= 0 and line.startswith(b'"', at + 1):
            at += 2
        if at < 0:
            return True
        # Behind a closing quote all is part of the cell, up to the next delimiter.
        at = line.find(sep, at + 1) + len(sep)
        if at < len(sep):
            return False


class _Case:
    """What a split knows of its lines if it starts outside, or inside, a quoted cell."""

    def __init__(self, inside: bool):
        self.inside, self.start, self.nth = inside, -1, 0

    def told(self, first: int, blank: np.ndarray, quoted: list[tuple[int, bytes, bytes]]) -> list[pa.Array]:
        """(inside, open, start, nth) of further lines, the first of which has the given place in the split."""
        n = len(blank)
        # Only a line with a quote can change the state.
        inside, at = np.empty(n, bool), 0
        for k, line, sep in quoted:
            inside[at : k + 1], at = self.inside, k + 1
            self.inside = stays_open(line, sep, self.inside)
        inside[at:] = self.inside
        starts = ~inside & ~blank
        places = np.maximum.accumulate(np.where(starts, first + np.arange(n), self.start))
        nth = self.nth + np.cumsum(starts)
        ends = np.append(inside[1:], self.inside)
        self.start, self.nth = int(places[-1]), int(nth[-1])
        return [pa.array(inside), pa.array(ends), pa.array(places, mask=places < 0), pa.array(nth)]


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with what both cases say, split after split."""
    names = [part.split()[0] for part in _LINES.split(", ")]
    split, cases, place = None, [], 0
    for batch in batches:
        keys = pa.StructArray.from_arrays([batch["path"], batch["block"]], ["path", "block"])
        changes = np.flatnonzero([a != b for a, b in zip(keys[1:], keys[:-1], strict=True)]) + 1 if _differ(batch) else []
        bounds = [0, *changes, len(batch)]
        for a, b in zip(bounds, bounds[1:], strict=False):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            value = part["value"]
            if (mine := keys[a].as_py()) != split:
                split, cases, place = mine, [_Case(False), _Case(True)], 0
                if mine["block"] == 0 and value[0].as_py().startswith(_MARK):
                    value = pa.concat_arrays([pa.array([value[0].as_py()[3:]], value.type), value[1:]])
            blank = pc.is_in(value, pa.array([b"", b"\r"], value.type)).to_numpy(zero_copy_only=False)
            marked = np.flatnonzero(pc.match_substring(value, '"').to_numpy(zero_copy_only=False))
            quoted = [(int(k), value[int(k)].as_py(), part["sep"][int(k)].as_py().encode()) for k in marked]
            told = [case.told(place, blank, quoted) for case in cases]
            at = pa.array(place + np.arange(len(part)))
            place += len(part)
            columns = [part["path"], part["block"], at, part["sep"], part["encoding"], value]
            columns += [told[case][k] for k in range(4) for case in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names)


def _differ(batch: pa.RecordBatch) -> bool:
    return any(len(pc.unique(batch[c])) > 1 for c in ("path", "block"))


_SPLITS = "path string, block bigint, inside boolean, before bigint, from_block bigint, from_at bigint"


def _folded(table: pa.Table) -> pa.Table:
    """The splits of one file: the true case, the records before, and the record that goes on into the split."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    inside, before, going, out = False, 0, (None, None), []
    for r in rows:
        out.append((r["path"], r["block"], inside, before, *going))
        case = "1" if inside else "0"
        if r[f"start{case}"] is not None:
            going = (r["block"], r[f"start{case}"])
        before += r[f"nth{case}"]
        inside = r[f"open{case}"]
    names = [part.split()[0] for part in _SPLITS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def records(spark: SparkSession, patterns: list[str], kinds: DataFrame) -> DataFrame:
    """``(path, encoding, sep, number, text binary)``: the records of files, numbered from 1, the header included.

    ``kinds`` has path, sep and encoding of every file.  Lines end with a line feed, before which a carriage
    return is no part of the record; within a quoted cell both stay.
    """
    lines = spark.read.option("lineSep", "\n").text(patterns).select(
        own_path().alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")
    )
    # One row per file, as in the listing.
    known = lines.join(F.broadcast(kinds.select("path", "sep", "encoding")), "path")
    told = write_out(known.select("path", "block", "sep", "encoding", "value").mapInArrow(_told, _LINES), "lines")
    splits = told.groupBy("path", "block").agg(
        *[F.max_by(f"open{c}", "at").alias(f"open{c}") for c in (0, 1)],
        *[F.max(f"{name}{c}").alias(f"{name}{c}") for name in ("start", "nth") for c in (0, 1)],
    )
    folded = write_out(splits.groupBy("path").applyInArrow(_folded, _SPLITS), "splits")

    def true(name: str) -> Column:
        return F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    placed = told.join(folded, ["path", "block"]).select(
        "path", "encoding", "sep", "block", "at", "value", true("inside").alias("goes_on"), true("open").alias("open"),
        (F.col("before") + true("nth")).alias("number"), true("start").alias("start"), "from_block", "from_at",
    )
    whole = placed.where(~F.col("goes_on") & ~F.col("open") & ~F.col("value").isin(b"", b"\r"))
    own = F.col("start").isNotNull()
    parts = placed.where(F.col("goes_on") | F.col("open")).select(
        "path", "encoding", "sep", "number", F.struct("block", "at", "value").alias("line"),
        F.when(own, F.col("block")).otherwise(F.col("from_block")).alias("start_block"),
        F.coalesce("start", "from_at").alias("start_at"),
    )
    joined = parts.groupBy("path", "start_block", "start_at").agg(
        F.first("encoding").alias("encoding"), F.first("sep").alias("sep"), F.min("number").alias("number"),
        F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x["value"].cast("string")), "\n").cast("binary").alias("value"),
    )
    columns = ("path", "encoding", "sep", "number", "value")
    return whole.select(*columns).unionByName(joined.select(*columns))


def parsed(text: str, sep: str) -> list[str]:
    """The cells of a record."""
    cells, at = [], 0
    while True:
        pieces = []
        if text.startswith('"', at):
            at += 1
            while (end := text.find('"', at)) >= 0 and text.startswith('"', end + 1):
                pieces.append(text[at : end + 1])
                at = end + 2
            if end < 0:  # never closed
                return [*cells, "".join([*pieces, text[at:]])]
            pieces.append(text[at:end])
            at = end + 1
        end = text.find(sep, at)
        cells.append("".join([*pieces, text[at:] if end < 0 else text[at:end]]))
        if end < 0:
            return cells
        at = end + len(sep)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records with quotes as lists of cells."""
    for batch in batches:
        values = zip(*(batch[c].to_pylist() for c in ("value", "sep", "encoding")), strict=True)
        cells = [parsed(value.removesuffix(b"\r").decode(encoding, "replace"), sep) for value, sep, encoding in values]
        yield pa.RecordBatch.from_arrays([batch["path"], batch["number"], pa.array(cells, pa.list_(pa.string()))], ["path", "number", "cells"])


def cells_of(found: DataFrame, separators: list[str]) -> DataFrame:
    """``(path, number, cells array<string>)`` of records; those without a quote are split by native expressions."""
    quoted = F.contains("value", F.lit(b'"'))
    text = F.when(F.col("encoding") == "UTF-8", F.col("value").cast("string")).otherwise(F.decode("value", "ISO-8859-1"))
    plain = F.regexp_replace(text, "\r$", "")
    split = F.coalesce(*[F.when(F.col("sep") == sep, F.split(F.col("plain"), f"\\Q{sep}\\E", -1)) for sep in separators])
    simple = found.where(~quoted).withColumn("plain", plain).select("path", "number", split.alias("cells"))
    complex_ = found.where(quoted).select("path", "number", "value", "sep", "encoding")
    return simple.unionByName(complex_.mapInArrow(_cells, "path string, number bigint, cells array<string>"))


def raw_maps(cells: DataFrame) -> DataFrame:
    """``(path, number, raw)`` of the records behind the headers: cells stripped, missing ones "", extra ones dropped."""

    def named(cell: Column, k: Column) -> Column:
        return F.when(cell != "", strip(cell)).otherwise(F.concat(F.lit("col_"), k.cast("string")))

    def picks(names: Column) -> Column:
        # Of several cells with one name the last counts.
        last = lambda name: (F.size(names) - F.array_position(F.reverse(names), name)).cast("int")
        return F.transform(F.array_distinct(names), lambda name: F.struct(name.alias("name"), last(name).alias("at")))

    headers = cells.where("number = 1").select("path", let(F.transform("cells", named), picks).alias("header"))
    rows = cells.where("number > 1").join(headers, "path")
    value = lambda pick: strip(F.coalesce(F.get("cells", pick["at"]), F.lit("")))
    raw = F.map_from_arrays(F.transform("header", lambda pick: pick["name"]), F.transform("header", value))
    return rows.select("path", "number", raw.alias("raw"))
