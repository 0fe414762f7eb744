"""Prefix trie of rebuilt conversations by composable fingerprints.

A conversation is rebuilt from the first turns of its base and its own turns behind as many.  No rebuilt text
is ever made: a sequence of turns has a fingerprint, the product of its turns' affine maps x -> B x + t
modulo a Mersenne prime, and products of stretches combine.  With one running product per original turn, a
rebuilt prefix is the base's head times the quotient of two of the conversation's own products.

1. Turns are put into order by ranges of (conversation, turn), so a conversation of any size may span tasks.
   Every task forms running products; what a conversation brings from the task before, a count and a product,
   is combined with them (one row per task passes the driver).
2. Rows of members are (conversation, depth, product, product of the parent, reference of the last turn).
   Their number is that of the turns plus at most ``MOST_HEAD`` + 1 per conversation.
3. Members with equal depth and product are a node.  Equality is verified, not believed: the last turns that
   its members refer to must have one turn hash and its parent's product must be one, and all turns of one
   hash must have the same role and text.  By induction members then hold the same turns.  Should that ever
   fail, everything is done again with other hashes.
4. A node belongs to its smallest member.  What a conversation owns is the lower end of its path, so sums over
   subtrees need no walk from level to level: the nodes below v are what v's members own at its depth or
   below.  Suffix sums over the owned ends, added up over the members, give leaves, tokens and children.

Aggregates combine before they are shuffled, joins spread hot conversations and hot parents, and running sums
over long conversations are made in blocks.  The members' ids of a node pass SHA-256, which is sequential, so
they are sorted and streamed through one task in constant memory, eight bytes a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowkin.operators.skew import left_join_by_key
from rowkin.scratch import Stored, store

PRIME = (1 << 127) - 1
#: The base of a conversation is the next multiple of this below its id; it gives up to five turns.
FAMILY = 100
HEADS = 6
MOST_HEAD = HEADS - 1
#: Depths whose running sums are made together.
BLOCK = 4096
#: Hash functions tried before a table is given up whose turns always collide.
ATTEMPTS = 4
#: A prefix is told by its depth and its product, kept as two bigints.
NODE = ("depth", "f1", "f2")
_LOW = (1 << 64) - 1


class Products:
    """The monoid of turn sequences: numbers modulo a prime, joined by ``head * B ** len(tail) + tail``."""

    def __init__(self, seed: int, prime: int = PRIME):
        self.prime = prime
        self.base = int.from_bytes(hashlib.sha256(f"trie-{seed}".encode()).digest()) % prime
        self.power = lru_cache(1 << 16)(lambda n: pow(self.base, n, prime))

    def __reduce__(self):
        return (_products, (self.base, self.prime))

    def joined(self, head: int, tail: int, length: int) -> int:
        return (head * self.power(length) + tail) % self.prime

    def after(self, value: int, turn: int) -> int:
        return (value * self.base + turn) % self.prime

    def of(self, turns: list[int]) -> int:
        value = 0
        for turn in turns:
            value = self.after(value, turn)
        return value


def _products(base: int, prime: int) -> Products:
    made = Products(0, prime)
    made.base = base
    return made


def _whole(high: list[int], low: list[int]) -> list[int]:
    """Numbers from their upper and lower 64 bits."""
    return [((a & _LOW) << 64) | (b & _LOW) for a, b in zip(high, low, strict=True)]


def _halves(values: list[int]) -> list[pa.Array]:
    high = np.array([v >> 64 for v in values], np.uint64).view(np.int64)
    low = np.array([v & _LOW for v in values], np.uint64).view(np.int64)
    return [pa.array(high), pa.array(low)]


def content() -> tuple[Column, Column]:
    return tuple(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))


def hashes(seed: int) -> tuple[Column, Column]:
    role, text = content()
    first, second = F.xxhash64(F.lit(2 * seed), role, text), F.xxhash64(F.lit(2 * seed + 1), text, role)
    return first.alias("d1"), second.alias("d2")


def ordered_turns(conversations: DataFrame, seed: int) -> DataFrame:
    """(conv_id, turn, r, t, d1, d2, n_chars): what a turn is ordered by, its hash and its code points.

    Turns of one number are in order of role and text, of which the first 64 code points count, then by hash.
    """
    role, text = content()
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.left(role, F.lit(64)).alias("r"),
        F.left(text, F.lit(64)).alias("t"), *hashes(seed), F.length(text).cast("bigint").alias("n_chars"),
    )


def one_text_per_hash(conversations: DataFrame, seed: int) -> bool:
    """Whether all turns of one hash have the same role and text; a task sends the least and the greatest of each."""
    role, text = content()
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        *hashes(seed), F.struct(role.alias("role"), text.alias("text")).alias("c")
    )
    groups = turns.groupBy("d1", "d2").agg(F.min("c").alias("least"), F.max("c").alias("most"))
    return groups.where(F.col("least") != F.col("most")).isEmpty()


def running(turns: DataFrame, products: Products) -> Stored:
    """(part, conv_id, place, b1, b2, d1, d2, n_chars) and a row without a hash at the end of every part.

    ``place`` and ``b1, b2``, the product of the turns before, are those within the part.
    """
    names = ["part", "conv_id", "place", "b1", "b2", "d1", "d2", "n_chars"]
    order = ("conv_id", "turn", "r", "t", "d1", "d2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, place, value = None, 0, 0
        for batch in batches:
            ids, places, before = batch["conv_id"].to_pylist(), [], []
            for name, turn in zip(ids, _whole(batch["d1"].to_pylist(), batch["d2"].to_pylist()), strict=True):
                if name != conv:
                    conv, place, value = name, 0, 0
                place += 1
                places.append(place)
                before.append(value)
                value = products.after(value, turn)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(ids), pa.int64()), batch["conv_id"], pa.array(places, pa.int64()), *_halves(before),
                 batch["d1"], batch["d2"], batch["n_chars"]], names
            )
        if conv is not None:
            none = pa.array([None], pa.int64())
            ends = [pa.array([x], pa.int64()) for x in (part, conv, place)]
            yield pa.RecordBatch.from_arrays([*ends, *_halves([value]), none, none, none], names)

    placed = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "d1", "d2", "n_chars")
    return store(placed.mapInArrow(run, ", ".join(f"{n} long" for n in names)), "trie-running")


def carried(running_turns: DataFrame, products: Products) -> DataFrame:
    """``running`` with places and products from the start of the conversation: (conv_id, place, b1, b2, d1, d2, n_chars)."""
    spark = running_turns.sparkSession
    ends = running_turns.where(F.col("d1").isNull()).select("part", "conv_id", "place", "b1", "b2").collect()
    carries, conv, place, value = [], None, 0, 0
    for end in sorted(ends):
        if conv is not None:
            carries.append((end["part"], conv, place, (value >> 64), (value & _LOW) - ((value & (1 << 63)) << 1)))
        mine = _whole([end["b1"]], [end["b2"]])[0]
        if end["conv_id"] == conv:
            place, value = place + end["place"], products.joined(value, mine, end["place"])
        else:
            conv, place, value = end["conv_id"], end["place"], mine
    brought = spark.createDataFrame(carries, "part long, conv_id long, places long, c1 long, c2 long")
    names = ["conv_id", "place", "b1", "b2", "d1", "d2", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch["place"].to_numpy()
            more = batch["places"].fill_null(0).to_numpy()
            if not more.any():
                yield batch.select(names)
                continue
            before = _whole(batch["b1"].to_pylist(), batch["b2"].to_pylist())
            head = _whole(batch["c1"].fill_null(0).to_pylist(), batch["c2"].fill_null(0).to_pylist())
            value = [products.joined(h, b, int(n) - 1) for h, b, n in zip(head, before, places, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], pa.array(places + more), *_halves(value), batch["d1"], batch["d2"], batch["n_chars"]], names
            )

    rows = running_turns.where(F.col("d1").isNotNull()).join(F.broadcast(brought), ["part", "conv_id"], "left")
    return rows.drop("part").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def rebuilt(turns: DataFrame, products: Products) -> DataFrame:
    """A row per conversation: conv_id, n_own, base_id, head (hashes and sizes of the turns from the base), h, length,
    and s1, s2: what a product of own turns is raised by when the head takes the place of the first h."""
    first = F.when(F.col("place") <= MOST_HEAD, F.struct("place", "d1", "d2", "n_chars"))
    own = turns.groupBy("conv_id").agg(F.max("place").alias("n_own"), F.sort_array(F.collect_list(first)).alias("first"))
    base = own.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base_id"), F.col("first").alias("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    some = F.coalesce("base", F.array().cast(own.schema["first"].dataType))
    joined = (
        own.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % FAMILY).join(base, "base_id", "left")
        .withColumn("h", h).withColumn("head", F.slice(some, F.lit(1), F.col("h")))
        .withColumn("own", F.slice("first", F.lit(1), F.col("h")))
        .withColumn("length", F.size("head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
        .select("conv_id", "base_id", "n_own", "h", "length", "head", "own")
    )
    shape = joined.drop("own").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shift = []
            for head, own in zip(batch["head"].to_pylist(), batch["own"].to_pylist(), strict=True):
                there, here = (products.of(_whole([t["d1"] for t in part], [t["d2"] for t in part])) for part in (head, own))
                shift.append((there - here) % products.prime)
            columns = [batch[f.name] for f in shape]
            yield pa.RecordBatch.from_arrays([*columns, *_halves(shift)], [*[f.name for f in shape], "s1", "s2"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shape) + ", s1 long, s2 long"
    return joined.mapInArrow(run, schema)


MEMBER = (
    "conv_id long, depth long, f1 long, f2 long, p1 long, p2 long, d1 long, d2 long, n_chars long, length long, "
    "turn_conv_id long, turn_place long"
)
_MEMBER_NAMES = [part.split()[0] for part in MEMBER.split(", ")]


def members(turns: DataFrame, conversations: DataFrame, n_turns: int, products: Products) -> DataFrame:
    """A row per conversation and depth, from the root on, as ``MEMBER`` says."""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values, parents = [], [], []
            for conv, base, length, head in zip(*(batch[c].to_pylist() for c in ("conv_id", "base_id", "length", "head")), strict=True):
                rows.append((conv, 0, None, None, 0, length, None, None))
                values.append(0)
                parents.append(0)
                value = 0
                for depth, turn in enumerate(head, 1):
                    rows.append((conv, depth, turn["d1"], turn["d2"], turn["n_chars"], length, base, depth))
                    parents.append(value)
                    value = products.after(value, _whole([turn["d1"]], [turn["d2"]])[0])
                    values.append(value)
            columns = zip(*rows, strict=True) if rows else [()] * 8
            conv, depth, d1, d2, chars, length, source, place = (pa.array(c, pa.int64()) for c in columns)
            yield pa.RecordBatch.from_arrays(
                [conv, depth, *_halves(values), *_halves(parents), d1, d2, chars, length, source, place], _MEMBER_NAMES
            )

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, h = batch["place"].to_numpy(), batch["h"].to_numpy().astype(np.int64)
            before = _whole(batch["b1"].to_pylist(), batch["b2"].to_pylist())
            shift = _whole(batch["s1"].to_pylist(), batch["s2"].to_pylist())
            turn = _whole(batch["d1"].to_pylist(), batch["d2"].to_pylist())
            parents = [products.joined(s, b, n) for s, b, n in zip(shift, before, (places - 1 - h).tolist(), strict=True)]
            values = [products.after(p, t) for p, t in zip(parents, turn, strict=True)]
            depth = pa.array(places - h + batch["n_head"].to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], depth, *_halves(values), *_halves(parents), batch["d1"], batch["d2"], batch["n_chars"],
                 batch["length"], batch["conv_id"], batch["place"]], _MEMBER_NAMES
            )

    info = conversations.select("conv_id", "n_own", "h", F.size("head").cast("bigint").alias("n_head"), "s1", "s2", "length")
    own = left_join_by_key(turns, info, "conv_id", F.col("place"), count="n_own", total=n_turns).where(F.col("place") > F.col("h"))
    narrow = conversations.select("conv_id", "base_id", "length", "head")
    return own.mapInArrow(tails, MEMBER).unionByName(narrow.mapInArrow(heads, MEMBER))


def grouped(rows: DataFrame) -> Stored:
    """The nodes, with the number of those whose members turn out to differ as ``mixed``."""
    nodes = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_chars").alias("n_chars"),
        F.max("length").alias("longest"), *[F.min(c).alias(c) for c in ("p1", "p2")],
        F.min(F.struct("conv_id", "turn_conv_id", "turn_place")).alias("reference"),
        *[F.max(c).alias(f"{c}_most") for c in ("p1", "p2", "d1", "d2")], *[F.min(c).alias(f"{c}_least") for c in ("d1", "d2")],
    )
    same = (
        (F.col("p1") == F.col("p1_most")) & (F.col("p2") == F.col("p2_most"))
        & F.col("d1_least").eqNullSafe(F.col("d1_most")) & F.col("d2_least").eqNullSafe(F.col("d2_most"))
    )
    checked = nodes.select(
        *NODE, "conv_id", "n_convs", "p1", "p2", same.alias("same"),
        F.col("reference.turn_conv_id").alias("turn_conv_id"), F.col("reference.turn_place").alias("turn_place"),
        ((F.col("n_convs") - 1) * F.col("n_chars")).alias("tokens"), (F.col("longest") == F.col("depth")).cast("bigint").alias("leaf"),
    )
    return store(checked, "trie-nodes", mixed=F.count(F.when(~F.col("same"), 1)))


def below(nodes: DataFrame) -> DataFrame:
    """Nodes with the sums over what their conversation owns from there on: tokens_below, leaves_below."""
    block = F.floor(F.col("depth") / BLOCK)
    rows = nodes.withColumn("block", block)
    inside = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth"))
    beyond = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "block").agg(F.sum("tokens").alias("t"), F.sum("leaf").alias("l"))
    later = totals.select(
        "conv_id", "block", *[F.coalesce(F.sum(c).over(beyond), F.lit(0)).alias(f"{c}_later") for c in ("t", "l")]
    )
    sums = rows.join(later, ["conv_id", "block"])
    return sums.select(
        *nodes.columns, (F.sum("tokens").over(inside) + F.col("t_later")).alias("tokens_below"),
        (F.sum("leaf").over(inside) + F.col("l_later")).alias("leaves_below"),
    )


def ends(rows: DataFrame) -> DataFrame:
    """(depth, f1, f2, ends_sha256) of the nodes where conversations end: their ids, streamed in order."""
    names = [*NODE, "ends_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        done: list[tuple] = []
        for batch in batches:
            for *key, conv in zip(*(batch[c].to_pylist() for c in (*NODE, "conv_id")), strict=True):
                if key != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            yield emitted(done)
            done = []
        if node is not None:
            yield emitted([(*node, digest.hexdigest())])

    def emitted(done: list[tuple]) -> pa.RecordBatch:
        columns = zip(*done, strict=True) if done else ([], [], [], [])
        types = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    last = rows.where(F.col("depth") == F.col("length")).select(*NODE, "conv_id")
    placed = last.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
    return placed.mapInArrow(run, "depth long, f1 long, f2 long, ends_sha256 string")


def key(depth: Column, high: str, low: str) -> Column:
    return F.struct(depth.alias("depth"), F.col(high).alias("f1"), F.col(low).alias("f2"))


def trie(conversations: DataFrame, products: type[Products] = Products) -> DataFrame:
    """A row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, and turn_conv_id, turn_place: where its last turn stands among the original ones.

    Null turns come first, a null role or text counts as empty.  Turns of one number are in order of role and text
    (64 code points of each, then a hash); repeated rows are turns of their own.  Rows without a conversation
    take no part, other columns are not read.  The base of a negative id is the next multiple of 100 towards
    zero.  An empty table has no conversation, hence no root and no rows.
    """
    for seed in range(ATTEMPTS):
        made = products(seed)
        raw = running(ordered_turns(conversations, seed), made)
        turns = store(carried(raw.table, made), "trie-turns")
        info = store(rebuilt(turns.table, made), "trie-conversations").table
        rows = store(members(turns.table, info, turns.rows, made), "trie-members")
        nodes = grouped(rows.table)
        if not nodes.figures["mixed"] and one_text_per_hash(conversations, seed):
            return _described(rows, nodes)
    raise ValueError(f"{ATTEMPTS} different hashes of turns all collide")


def _described(rows: Stored, nodes: Stored) -> DataFrame:
    owned = store(below(nodes.table), "trie-owned").table
    # The highest node that a conversation owns; the lowest is its end.
    tops = owned.groupBy("conv_id").agg(
        F.min("depth").alias("top"), (F.max("depth") + 1).alias("n"), F.max("tokens_below").alias("all_tokens"),
        F.max("leaves_below").alias("all_leaves"), F.min_by(F.struct("p1", "p2"), "depth").alias("parent"),
    )
    above = left_join_by_key(rows.table, tops, "conv_id", F.col("depth"), total=rows.rows).where(F.col("depth") < F.col("top"))
    none = F.lit(0)
    parts = (
        owned.select(*NODE, "tokens_below", "leaves_below", none.alias("child"))
        .union(above.select(*NODE, "all_tokens", "all_leaves", none))
        .union(owned.where(F.col("depth") > 0).select(F.col("depth") - 1, "p1", "p2", none, none, F.lit(1)))
    )
    sums = parts.groupBy(*NODE).agg(
        F.sum("tokens_below").alias("saved_tokens"), F.sum("leaves_below").alias("n_leaves"), F.sum("child").alias("n_children")
    )
    summed = store(owned.drop("tokens_below", "leaves_below").join(sums, list(NODE)), "trie-sums").table

    parents = summed.where(F.col("n_children") > 0).select(
        key(F.col("depth"), "f1", "f2").alias("node"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n")
    )
    wanted = tops.where(F.col("top") > 0).select(
        F.col("conv_id"), F.col("top").alias("depth"), key(F.col("top") - 1, "parent.p1", "parent.p2").alias("node")
    )
    found = left_join_by_key(wanted, parents, "node", F.col("conv_id")).select("conv_id", "depth", "parent_conv_id")
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        summed.join(found, ["conv_id", "depth"], "left").join(ends(rows.table), list(NODE), "left")
        .select(
            "conv_id", "depth",
            F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id"),
            "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
            "turn_conv_id", "turn_place",
        )
    )
