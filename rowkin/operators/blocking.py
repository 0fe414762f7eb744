"""Candidate generation for the similarity join on names: no misses, no cross join.

Two names match when their similarity reaches ``LOOSE`` and they share a context (department, company
or address), or when it reaches ``STRICT`` with no context needed.  A threshold bounds the number of
edits t by the longer length L, so the shorter name cut into t + 1 pieces keeps at least one piece
intact in the longer one (pigeonhole; Li, Deng, Wang, Feng 2011, "Pass-Join: A Partition-based Method
for Similarity Joins").  Equal pieces turn the theta join into a hash join.

One short piece says little where very many names share a context, and candidates grow with the square of
the names.  There the shorter name is cut into t + 2 pieces, two of which must be intact, in places that leave
enough edits before, between and behind them; the pair is the key.  Names of up to 13 letters have three edits
at most, so one half of the shorter name has at most one: there the halves are the keys, with any one letter left
out.  Before any two names are compared, the letters that only one of them has bound their distance.

Rows that describe names here are ``(id, name, scope)``: ``scope`` is "" for the strict tier and
``field=value`` for a shared context.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from itertools import combinations, product
from math import inf

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rowkin.functions.similarity import bounded_distance, least_edits, letter_marks, max_edits, ratio_of
from rowkin.operators.skew import left_join_by_key
from rowkin.scratch import Stored, store, write_out
from rowkin.settings import DEFAULTS, MatchSettings, tasks_for

# The two thresholds, the shortest comparable name, and the context fields.
STRICT = 0.85
LOOSE = 0.70
MIN_NAME = 3
CONTEXT_FIELDS = ("department", "company", "address")

# Up to this longer length the pieces are keyed by both lengths, their number and place, which is
# the most selective key.  The number of such keys grows with the cube of the edits, so longer names
# use pieces keyed by their text alone, which grows linearly.
_PLACED_LENGTH = 40
# Up to this longer length two pieces may be asked for; the ways to place them grow fast with the edits.
_PAIRED_LENGTH = 23
# Up to this longer length the loose tier has at most three edits, so one of two halves has at most one.
_HALVED_LENGTH = 13
# Rows that a scoped name is cut into, as seen on names of 12 letters in large contexts; it only sets numbers of tasks.
_KEYS_PER_NAME = 40
# Ways to place two pieces of a name of 12 letters, beyond those to place one: the measure of ``large_context``.
_USUAL_PLACES = 240


def scoped_names(
    nodes: DataFrame, settings: MatchSettings = DEFAULTS, total: int | None = None
) -> DataFrame:
    """``(id, name, marks, len, scope, direct, members)``: the strict scope of every name and each context it shares.

    A context with one member has no pair to offer and is dropped.  ``direct`` marks the contexts
    small enough to compare all their members, a bounded number of comparisons per name.  ``members`` is
    the size of a context, 0 for the strict scope.
    """
    named = nodes.where(F.length("name") >= MIN_NAME).select("*", letter_marks(F.col("name")).alias("marks"))
    strict = named.select(
        "id", "name", "marks", F.length("name").alias("len"), F.lit("").alias("scope"), F.lit(False).alias("direct"),
        F.lit(0).cast("bigint").alias("members"),
    )
    contexts = [
        F.when(F.col(field) != "", F.concat(F.lit(f"{field}="), F.col(field))) for field in CONTEXT_FIELDS
    ]
    shared = named.select("id", "name", "marks", F.explode(F.array_compact(F.array(*contexts))).alias("scope"))
    members = shared.groupBy("scope").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sized = left_join_by_key(
        shared,
        members,
        "scope",
        F.col("id"),
        settings=settings,
        total=None if total is None else total * len(CONTEXT_FIELDS),
    ).where("n is not null")
    return strict.unionByName(
        sized.select(
            "id",
            "name",
            "marks",
            F.length("name").alias("len"),
            "scope",
            (F.col("n") <= settings.small_context).alias("direct"),
            F.col("n").alias("members"),
        )
    )


def store_names(scoped: DataFrame) -> Stored:
    """Write scoped names and observe which kinds of blocks they call for."""
    return store(
        scoped,
        "names",
        longest=F.coalesce(F.max("len"), F.lit(0)),
        direct=F.count_if("direct"),
        members=F.coalesce(F.max("members"), F.lit(0).cast("bigint")),
        # One bit per length in use: lengths nobody has need no block.
        lengths=F.coalesce(
            F.bit_or(
                F.when(
                    F.col("len") <= _PLACED_LENGTH,
                    F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("len")),
                )
            ),
            F.lit(0).cast("bigint"),
        ),
    )


KEYED = ("scope", "block", "id", "name", "marks")


def short_side(scoped: DataFrame, figures: dict, settings: MatchSettings = DEFAULTS) -> DataFrame:
    """Names cut into pieces, to be found inside names as long or longer, as ``KEYED`` says."""
    return _keyed(scoped, _short_placed, _short_free, figures, settings, "short")


def long_side(scoped: DataFrame, figures: dict, settings: MatchSettings = DEFAULTS) -> DataFrame:
    """The substrings of names where a piece may turn up, as ``KEYED`` says."""
    return _keyed(scoped, _long_placed, _long_free, figures, settings, "long")


def _keyed(scoped: DataFrame, placed, free, figures: dict, settings: MatchSettings, side: str) -> DataFrame:
    # A task that cuts names holds what it makes of them until it is sent.
    tasks = tasks_for(scoped.sparkSession, figures["rows"] * _KEYS_PER_NAME)
    scoped = scoped.repartition(tasks, "id") if tasks else scoped
    cut = scoped.where("not direct").withColumn("theta", _theta())
    in_use = [n for n in range(_PLACED_LENGTH + 1) if figures["lengths"] >> n & 1]
    halved = [n for n in in_use if n <= _HALVED_LENGTH] if figures["members"] >= settings.halved_context else []
    paired = {n: least for n in in_use if (least := _least_members(n, settings)) <= figures["members"]}
    # In a context that asks for halves or two pieces of a length, one piece is no key.
    most = {**paired, **{n: min(paired.get(n, inf), settings.halved_context) for n in halved}}
    single = [F.when(F.col("long_len") == n, F.col("members") < least) for n, least in most.items()]
    parts = [placed(cut, in_use).where(F.coalesce(*single, F.lit(True)))]
    if halved:
        parts.append(_halved(cut.where(F.col("members") >= settings.halved_context), side, halved))
    paired = {n: least for n, least in paired.items() if n not in halved or least < settings.halved_context}
    if paired:
        two = _paired(cut, side, paired, in_use)
        parts.append(two.where(~F.col("long_len").isin(halved) | (F.col("members") < settings.halved_context)) if halved else two)
    if figures["longest"] > _PLACED_LENGTH:
        parts.append(free(cut))
    if figures["direct"]:
        parts.append(scoped.where("direct").withColumn("block", F.lit(0).cast("bigint")))
    whole = parts[0].select(*KEYED)
    for part in parts[1:]:
        whole = whole.unionByName(part.select(*KEYED))
    # The block tells the contexts apart, too: it is sorted and counted by alone.
    return whole.withColumn("block", F.xxhash64("scope", "block"))


@cache
def halves(in_use: tuple[int, ...], side: str) -> list[tuple]:
    """``(len, part, size, kind, dropped, at, width)``: the keys of names of these lengths, as one half of the shorter one.

    Of a name and one as long or longer, both of at most ``_HALVED_LENGTH`` letters, one half of the shorter has at most
    one edit; up to one edit in all it is the whole name.  Its counterpart stands at the same end, is as wide or wider
    or narrower by one, and is told by ``part``.  ``dropped`` is the letter left out, none if -1.  Equal and replaced
    letters (``same``) leave out the same one on both sides, an added letter is left out of the longer name, and a lost
    letter of the shorter.
    """
    found = set()
    for longer in in_use:
        t = max(d for d in range(longer) if 1.0 - d / longer >= LOOSE)
        for shorter in (n for n in in_use if max(MIN_NAME, longer - t) <= n <= longer):
            front = (shorter + 1) // 2
            parts = [("whole", shorter)] if t <= 1 else [("front", front), ("back", shorter - front)]
            for part, size in parts:
                for kind, more in (("same", 0), ("added", 1), ("lost", -1)):
                    beside = longer - shorter - more
                    if beside and part == "whole" or abs(beside) + abs(more) > t:
                        continue
                    of, width = (shorter, size) if side == "short" else (longer, size + more)
                    whole = kind == ("added" if side == "short" else "lost")
                    for dropped in [-1] if whole else range(width):
                        at = of - width if part == "back" else 0
                        found.add((of, part, size, kind, dropped, at, width))
    return sorted(found)


def _halved(scoped: DataFrame, side: str, in_use: list[int]) -> DataFrame:
    ways = scoped.sparkSession.createDataFrame(
        halves(tuple(in_use), side), "len int, part string, size int, kind string, dropped int, at int, width int"
    )
    letters = lambda start, count: F.substring(F.col("name"), F.col("at") + start + 1, count)
    left, right = letters(F.lit(0), F.col("dropped")), letters(F.col("dropped") + 1, F.col("width") - F.col("dropped") - 1)
    piece = F.when(F.col("dropped") < 0, letters(F.lit(0), F.col("width"))).otherwise(F.concat(left, right))
    # Which letter was left out only counts where it is the same one on both sides.
    place = F.when(F.col("kind") == "same", F.col("dropped")).otherwise(-1)
    # A fixed table of some 700 rows.
    found = scoped.join(F.broadcast(ways), "len")
    return found.withColumn("block", F.xxhash64(F.lit("half"), "part", "size", "kind", place, piece))


@cache
def places(longer: int, side: str) -> list[tuple[int, ...]]:
    """Ways to place two of the t + 2 pieces of a shorter name in one of ``longer`` letters, loose tier:
    ``(len, short_len, long_len, a, b, at_a, size_a, at_b, size_b)``.

    A piece that is moved by s takes s edits before it, and the letters behind the last one have to make up
    for the rest of the difference in length.
    """
    t = max(d for d in range(longer) if 1.0 - d / longer >= LOOSE)
    found = []
    for shorter in range(max(MIN_NAME, longer - t), longer + 1):
        small, larger = divmod(shorter, t + 2)
        sizes = [small + (k >= t + 2 - larger) for k in range(t + 2)]
        starts = [sum(sizes[:k]) for k in range(t + 2)]
        for a, b in combinations(range(t + 2), 2):
            pair = (shorter, longer, a, b)
            if side == "short":
                found.append((shorter, *pair, starts[a], sizes[a], starts[b], sizes[b]))
                continue
            for x, y in product(range(-t, t + 1), repeat=2):
                at_a, at_b = starts[a] + x, starts[b] + y
                room = at_a >= 0 and at_b >= at_a + sizes[a] and at_b + sizes[b] <= longer
                if room and abs(x) + abs(y - x) + abs(longer - shorter - y) <= t:
                    found.append((longer, *pair, at_a, sizes[a], at_b, sizes[b]))
    return found


def _least_members(longer: int, settings: MatchSettings) -> float:
    """Members of a context from which on names of this longer length are found by two pieces."""
    if longer > _PAIRED_LENGTH:
        return inf
    return max(1.0, len(places(longer, "long")) / _USUAL_PLACES) * settings.large_context


def _paired(scoped: DataFrame, side: str, paired: dict[int, float], in_use: list[int]) -> DataFrame:
    rows = [(*row, least) for n, least in paired.items() for row in places(n, side) if row[1] in in_use]
    ways = scoped.sparkSession.createDataFrame(
        rows, "len int, short_len int, long_len int, a int, b int, at_a int, size_a int, at_b int, size_b int, least double"
    )
    piece = lambda k: F.substring(F.col("name"), F.col(f"at_{k}") + 1, F.col(f"size_{k}"))
    block = F.xxhash64(F.lit("pair"), "short_len", "long_len", "a", "b", piece("a"), piece("b"))
    # A fixed table of at most some 30,000 rows.
    found = scoped.join(F.broadcast(ways), "len").where(F.col("members") >= F.col("least"))
    return found.withColumn("block", block)


def _theta() -> Column:
    return F.when(F.col("scope") == "", F.lit(STRICT)).otherwise(F.lit(LOOSE))


def _longest_partner(length: Column) -> Column:
    """No name longer than this can match a name of the given length: L - l <= t(L) <= (1-theta) L."""
    return F.floor(length / F.col("theta")).cast("int") + 1


def _short_placed(scoped: DataFrame, in_use: list[int]) -> DataFrame:
    longest = F.least(_longest_partner(F.col("len")), F.lit(_PLACED_LENGTH))
    return (
        scoped.where(F.col("len") <= _PLACED_LENGTH)
        .withColumn("long_len", F.explode(F.sequence(F.col("len"), longest)))
        .where(F.col("long_len").isin(in_use))
        .withColumn("t", max_edits(F.col("long_len"), F.col("theta")))
        .where(F.col("long_len") - F.col("len") <= F.col("t"))
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("t"))))
        .withColumn("start", _piece_start(F.col("len")))
        .withColumn("piece", F.substring(F.col("name"), F.col("start") + 1, _piece_size(F.col("len"))))
        .withColumn("block", _placed_block(F.col("len"), F.col("long_len")))
    )


def _long_placed(scoped: DataFrame, in_use: list[int]) -> DataFrame:
    shortest = F.greatest(F.col("len") - F.col("t"), F.lit(MIN_NAME))
    # A piece can only have moved as far as the edits that the length difference leaves over.
    gap = F.col("len") - F.col("short_len")
    low = F.greatest(F.lit(0), F.col("start") - F.floor((F.col("t") - gap) / 2).cast("int"))
    high = F.least(
        F.col("len") - F.col("size"), F.col("start") + F.floor((F.col("t") + gap) / 2).cast("int")
    )
    return (
        scoped.where(F.col("len") <= _PLACED_LENGTH)
        .withColumn("t", max_edits(F.col("len"), F.col("theta")))
        .withColumn("long_len", F.col("len"))
        .withColumn("short_len", F.explode(F.sequence(shortest, F.col("len"))))
        .where(F.col("short_len").isin(in_use))
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("t"))))
        .withColumn("start", _piece_start(F.col("short_len")))
        .withColumn("size", _piece_size(F.col("short_len")))
        .where(low <= high)
        .withColumn("at", F.explode(F.sequence(low, high)))
        .withColumn("piece", F.substring(F.col("name"), F.col("at") + 1, F.col("size")))
        .withColumn("block", _placed_block(F.col("short_len"), F.col("len")))
    )


def _short_free(scoped: DataFrame) -> DataFrame:
    """One piece size per shorter length, small enough for its longest partner."""
    return (
        scoped.where(_longest_partner(F.col("len")) > _PLACED_LENGTH)
        .withColumn("size", _free_size(F.col("len")))
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.floor(F.col("len") / F.col("size")).cast("int") - 1)))
        .withColumn("piece", F.substring(F.col("name"), F.col("k") * F.col("size") + 1, F.col("size")))
        .withColumn("block", _free_block())
    )


def _long_free(scoped: DataFrame) -> DataFrame:
    """Every substring of each piece size in use among the admissible shorter lengths, a few numbers."""
    shortest = F.col("len") - max_edits(F.col("len"), F.col("theta"))
    sizes = F.array_distinct(F.transform(F.sequence(shortest, F.col("len")), _free_size))
    return (
        scoped.where(F.col("len") > _PLACED_LENGTH)
        .withColumn("size", F.explode(sizes))
        .withColumn("at", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("size"))))
        .withColumn("piece", F.substring(F.col("name"), F.col("at") + 1, F.col("size")))
        .withColumn("block", _free_block())
    )


def _piece_start(length: Column) -> Column:
    """Start of piece k when ``length`` is cut into t + 1 pieces as even as possible, longer ones last."""
    pieces = F.col("t") + 1
    base = F.floor(length / pieces).cast("int")
    longer = length - base * pieces
    return F.col("k") * base + F.greatest(F.lit(0), F.col("k") - (pieces - longer))


def _piece_size(length: Column) -> Column:
    pieces = F.col("t") + 1
    base = F.floor(length / pieces).cast("int")
    longer = length - base * pieces
    return base + F.when(F.col("k") >= pieces - longer, F.lit(1)).otherwise(F.lit(0))


def _placed_block(short_len: Column, long_len: Column) -> Column:
    return F.xxhash64(short_len, long_len, F.col("k"), F.col("piece"))


def _free_size(length: Column) -> Column:
    """Size of the pieces of a name of this length: enough whole pieces for its longest partner."""
    edits = max_edits(_longest_partner(length), F.col("theta"))
    return F.greatest(F.lit(1), F.floor(length / (edits + 1)).cast("int"))


def _free_block() -> Column:
    return F.xxhash64(F.lit("free"), F.col("size"), F.col("piece"))


@dataclass(frozen=True)
class Candidates:
    """The two keyed sides of a candidate join, its size, the blocks to split, and the number of tasks if it is large."""

    short: DataFrame
    long: DataFrame
    pairs: float
    hot: DataFrame | None
    tasks: int | None = None


def measure(
    short: DataFrame, long: DataFrame, settings: MatchSettings = DEFAULTS, names: int = 0
) -> Candidates:
    """Count the candidates of every block, before any is formed.

    One job writes the counts and observes their total.  A block is too large for one task from a task's
    share of pairs on, or from ``total / settings.hot_keys`` on where that is more: no more than
    ``settings.hot_keys`` blocks can be, so the list is complete and may be broadcast.  ``names`` is the number
    of scoped names of both sides, from which the number of tasks is set.
    """
    per_task = _pairs_per_task(settings)
    both = short.select("block", F.lit(True).alias("is_short")).unionByName(long.select("block", F.lit(False).alias("is_short")))
    tasks = tasks_for(short.sparkSession, names * _KEYS_PER_NAME)
    # Most blocks have a row or two: counting them before they are dealt only fills the memory of a task.
    both = both.repartition(tasks, "block") if tasks else both
    counts = store(
        both.groupBy("block")
        .agg(F.count_if("is_short").alias("shorts"), F.count_if(~F.col("is_short")).alias("longs"))
        .withColumn("pairs", F.col("shorts").cast("double") * F.col("longs"))
        # Most blocks are small; of those only the total counts.
        .observe(seen := Observation(), F.coalesce(F.sum("pairs"), F.lit(0.0)).alias("pairs"))
        .where(F.col("pairs") > per_task),
        "large-blocks",
    )
    total = seen.get["pairs"]
    least = max(per_task, total / settings.hot_keys)
    hot = counts.table.where(F.col("pairs") > least).select(
        "block", F.ceil(F.sqrt(F.col("pairs") / least)).cast("int").alias("parts")
    )
    return Candidates(short, long, total, hot if counts.rows else None, tasks)


def _pairs_per_task(settings: MatchSettings) -> float:
    return 10.0 * settings.hot_rows


def verified_pairs(candidates: Candidates) -> DataFrame:
    """``(i, j, similarity)`` of the matching pairs among block neighbours, each pair once.

    ``i`` is the later record.  Hot blocks are split over a grid of tasks, by the bounded broadcast list
    of :func:`measure`.
    """
    left, right = (
        side.select("scope", "block", *[F.col(c).alias(f"{c}_{end}") for c in ("name", "marks")], F.col("id").alias(end))
        for side, end in ((candidates.short, "a"), (candidates.long, "b"))
    )
    # The block first: a sort tells rows apart by it alone.
    keys = ["block", "scope"]
    if candidates.hot is not None:
        left = _on_grid(left, candidates.hot, "a", "salt_a", "salt_b")
        right = _on_grid(right, candidates.hot, "b", "salt_b", "salt_a")
        keys += ["salt_a", "salt_b"]
    if candidates.tasks:
        left, right = (side.repartition(candidates.tasks, *keys).hint("merge") for side in (left, right))
    size_a, size_b = F.length("name_a"), F.length("name_b")
    # Names of one length play both roles, so a pair of them would come twice without the id test.
    ordered = (size_a < size_b) | ((size_a == size_b) & (F.col("a") < F.col("b")))
    distance = bounded_distance(F.col("name_a"), F.col("name_b"), _theta())
    return (
        left.join(right, keys)
        .where(ordered & (F.greatest(size_b - size_a, least_edits(F.col("marks_a"), F.col("marks_b"))) <= max_edits(size_b, _theta())))
        .where(distance >= 0)
        .groupBy(F.greatest("a", "b").alias("i"), F.least("a", "b").alias("j"))
        .agg(F.max(ratio_of(distance, F.col("name_a"), F.col("name_b"))).alias("similarity"))
    )


def _on_grid(side: DataFrame, hot: DataFrame, id_col: str, own: str, other: str) -> DataFrame:
    """Spread a side of a hot block over parts x parts cells: salted one way, copied the other way."""
    copies = F.coalesce(F.col("parts"), F.lit(1))
    return (
        side.join(F.broadcast(hot), "block", "left")
        .withColumn(own, F.pmod(F.xxhash64(id_col), copies.cast("bigint")).cast("int"))
        .withColumn(other, F.explode(F.sequence(F.lit(0), copies - 1)))
        .drop("parts")
    )
