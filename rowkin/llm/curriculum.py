"""Mixing sources to target weights along a time-varying curriculum.

1. Targets.  Each source's share of the budget follows its weight, but never more than ``max_epochs``
   times its words; what a full source cannot take is shared again by weight until none is above.
2. What is taken.  The documents of a source stand in a fixed pseudo-random order (by digest of the id).
   Going round that order, words are taken until the target is reached: whole documents, and a part of
   the one in which the target falls.
3. When.  A source's weight at time t in [0, 1] is ``weight * (1 + tilt * (2 t - 1))``; its integral is
   the share of the target used up by t.  The inverse of that integral gives every taken document its
   training position, and the plan is range-sorted by position.

All of it is built-in column functions.  A source may hold any share of the rows: running totals are
formed inside hash slices of a source and then over the slices' sums, never over a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowkin.operators.numbering import number_rows
from rowkin.llm.rows import bounded, keyed
from rowkin.scratch import store, write_out

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
MAX_EPOCHS = 2
#: Tilts by rank of the source, repeating like the weights: late, even, early.
TILTS = (0.5, 0.0, -0.5)
#: Rows that a slice of a source holds on average; slices are never fewer than LEAST_SLICES.
ROWS_PER_SLICE = 4000
LEAST_SLICES = 64
SEED = "mix-1"


def _cyclic(values, rank: Column) -> Column:
    """values[(rank - 1) mod len(values)]"""
    out = F.lit(values[0])
    for k, value in enumerate(values[1:], start=1):
        out = F.when((rank - 1) % len(values) == k, F.lit(value)).otherwise(out)
    return out


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget_percent=BUDGET_PERCENT, max_epochs=MAX_EPOCHS) -> DataFrame:
    """From (source, source_size): the same with ``weight``, ``tilt`` and ``target`` (double).

    Sources are ranked by code point, null last.  One aggregate per round finds the level at which the
    sources that are not full share what is left; a round that fills no further source is the last.
    ``sizes`` has a row per source, and only sums over it reach the driver.
    """
    named = sizes.withColumn("_last", F.col("source").isNull())
    ranked = number_rows(named, ["_last", "source"], "_rank").drop("_last")
    rows = write_out(
        ranked.select(
            "source",
            "source_size",
            _cyclic(weights, F.col("_rank")).cast("long").alias("weight"),
            _cyclic(TILTS, F.col("_rank")).alias("tilt"),
        ),
        "mix-sources",
    )
    most = F.col("source_size") * max_epochs
    level = 0.0
    while True:
        # Full: reached its cap at the present level (the level only rises).
        full = most <= F.col("weight") * F.lit(level)
        got = rows.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(full, most)), F.lit(0)).alias("capped"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        if not got["open"]:
            break
        # In units of 1/100 of a word the numerator is a whole number, so no rounding creeps in.
        new = (got["total"] * budget_percent - 100 * got["capped"]) / (100 * got["open"])
        if new <= level:
            break
        level = new
    share = F.col("weight") * F.lit(level)
    return rows.withColumn("target", F.least(most.cast("double"), share))


def _part(upto: Column, size: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(size, upto))


def plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    key: Column | None = None,
    weights=WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """A row per row of ``docs``: the id, ``size`` (words), ``source``, ``source_size``, ``target``,
    ``taken`` (words, repeats counted), ``tilt`` and ``start`` (words of its source before it).

    Null texts and texts of spaces have size 0 and are never taken.  A null source is a source of its
    own.  Rows that repeat an id stand next to each other in the order; equal rows are interchangeable.
    An empty table gives no rows.  Other columns are not read; a ``key`` is carried along as ``key``.
    """
    size = F.size(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), 0)).cast("long")
    carried = F.lit(None).cast("long") if key is None else key
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), carried.alias("key")
    )
    # The words are counted once; what follows reads the narrow table.
    saved = store(rows.withColumn("turn", F.md5(F.concat_ws(":", F.lit(SEED), F.col("doc_id").cast("string")))), "mix-sizes")
    slices = max(LEAST_SLICES, saved.rows // ROWS_PER_SLICE)
    # The leading hex digits of the digest are the place in the order, so slices are ranges of it.
    place = F.conv(F.substring("turn", 1, 7), 16, 10).cast("long")
    rows = saved.table.withColumn("slice", F.floor(place * slices / F.lit(16**7)).cast("int"))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, budget_percent, max_epochs)

    sums = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .alias("o")
        .join(targets.alias("g"), F.expr("o.source <=> g.source"))
        .select(
            F.col("o.source").alias("source"), "slice", "before", "source_size", "target", "tilt",
        )
    )
    within = (
        Window.partitionBy("source", "slice").orderBy("turn", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = placed.alias("p").join(offsets.alias("o"), F.expr("p.source <=> o.source and p.slice = o.slice"))
    start = (F.col("inner") + F.col("before")).cast("long")
    goal = F.round("target").cast("long")
    taken = F.lit(0).cast("long")
    for epoch in range(max_epochs):
        taken = taken + _part(goal - start - epoch * F.col("source_size"), F.col("size"))
    return joined.select(
        F.col("p.doc_id").alias(id_col),
        "key",
        "size",
        F.col("p.source").alias("source"),
        "source_size",
        "target",
        taken.alias("taken"),
        "tilt",
        start.alias("start"),
    )


def position(share: Column, tilt: Column) -> Column:
    """The time at which a source has used up ``share`` of its target.

    The used share at time t is the integral of ``1 + tilt * (2 s - 1)`` from 0 to t, that is
    ``tilt * t**2 + (1 - tilt) * t``; this is its inverse.
    """
    a, b = tilt, 1 - tilt
    curved = (F.sqrt(b * b + 4 * a * share) - b) / (2 * a)
    return F.when(tilt == 0, share).otherwise(curved)


def _words(epoch: int) -> Column:
    """The words taken from a row of the plan in an epoch, counted from 0."""
    return _part(F.round("target").cast("long") - F.col("start") - epoch * F.col("source_size"), F.col("size"))


def _placed(epoch: int) -> Column:
    """The position of a row's first word in an epoch; null where nothing is taken then."""
    share = (F.col("start") + epoch * F.col("source_size")) / F.greatest(F.col("target"), F.lit(1.0))
    return F.when(_words(epoch) > 0, position(F.least(share, F.lit(1.0)), F.col("tilt")))


def with_positions(planned: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The plan's rows and columns with ``position_1``, ``position_2``, ...: the training position (in [0, 1], of its
    first word) of the document each time it is taken, null where it is not."""
    return planned.select(*planned.columns, *[_placed(epoch).alias(f"position_{epoch + 1}") for epoch in range(max_epochs)])


def scheduled(planned: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """A row per time a document is taken: the plan's columns with ``epoch``, ``words`` (taken that
    time) and ``position`` (in [0, 1], of its first word), sorted by position over all partitions."""
    times = F.array(
        *[
            F.struct(F.lit(epoch).alias("epoch"), _words(epoch).alias("words"), _placed(epoch).alias("position"))
            for epoch in range(max_epochs)
        ]
    )
    rows = planned.select(*planned.columns, F.inline(times)).where(F.col("words") > 0)
    return rows.repartitionByRange("position").sortWithinPartitions("position", "source", "start")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents of the mix in training order, with the columns of ``docs``.

    A document appears once per time it is taken; where the target falls inside one, its text is cut
    after the words taken (the spaces between them stay).
    """
    kept = keyed(docs, "mix-docs")
    rows = kept.select("key", *[F.col(f"doc.`{c}`").alias(c) for c in dict.fromkeys((id_col, text_col, source_col))])
    planned = plan(rows, id_col, text_col, source_col, key=F.col("key"))
    times = store(scheduled(planned).select("key", "words", "size", "position"), "mix-times")
    joined = kept.join(bounded(times.table, times.rows), "key").repartitionByRange("position").sortWithinPartitions("position", "key")
    parts = F.regexp_extract_all(F.col(f"doc.`{text_col}`"), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), 0)
    cut = F.when(F.col("words") < F.col("size"), F.array_join(F.slice(parts, F.lit(1), F.col("words").cast("int")), ""))
    text = F.coalesce(cut, F.col(f"doc.`{text_col}`"))
    return joined.select(*[text.alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
