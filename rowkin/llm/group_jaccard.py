"""Jaccard self-join of documents on word n-grams by grouped prefixes, and the components of its links.

Shingles are put into one order for all documents; two sets with similarity t or more share a shingle
among the first ``n - ceil(t n) + 1`` of each, their prefixes.

1. Every task collapses equal sets and writes the rest with their texts to the shared folder.
2. Shingles that many documents hold are moved to the end of the order, so that prefixes are made of
   what sets a document apart.  The list is bounded and made from all documents: every task counts the
   shingles it meets several times.  Only the order, and so the work, depends on it; no result does.
3. Prefix entries (shingle, document, size, place: some 12 bytes packed, however many buckets there are) go to
   buckets by shingle in blocks; entries whose shingle nobody else has, or nobody whom sizes and places allow, end
   there.  Only documents with entries left are read again, for the digest of their prefix.
   A document also gets a sketch: one bit per hash class, flipped by each of its shingles.  Bits in which
   two sketches differ stand for shingles that only one of them has, so they bound the overlap.  There are
   at least twice as many classes as shingles; of two sketches the longer is folded to the length of the other.
   Lists of the same documents lead to the same pairs, so one of them stays: near copies share most of their prefixes.
4. Documents with one prefix and size are a group: in a shingle's list they stand together, and a
   pair of groups is filtered once, by size and place, for all its members.
   Entries left carry the sketch folded to 128 bits, which bounds the overlap of shorter documents at once, and the
   first names of their document's lists: after the first round a pair comes from the first list that both are in.
5. Pairs that pass, and whose whole sketches allow it, are verified on whole sets, in rounds: a round takes as partners the first 1, 8, 64, ...
   entries of every list, and leaves out pairs already in one component, so a large group of copies
   costs a comparison or two per document and not all pairs.  Within a round every document is compared with
   its likeliest partner first; the other pairs follow as far as they are not in one component by then.
   Rounds end when every list is in one component or used up; no pair is left out for any other reason.
6. Components grow by large-star and small-star steps on the links found, all in Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowkin.llm.rows import bounded, keyed, plain_reads, releasing, short_shuffles, small_batches
from rowkin.scratch import dropping, store, write_out

WORDS = 4
PERCENT = 85
#: A shingle counted more often than this is moved to the end of the order; the list's bound is 8 MB.
OFTEN = 8
MOST_OFTEN = 1_000_000
#: Shingles that are counted together: 16 MB.
TOGETHER = 1 << 21
#: Prefix entries that a task packs together, and those that a bucket holds on average: some 10 MB.
FLUSHED = 1 << 18
BUCKET_ENTRIES = 1 << 18
#: Entries of a list whose pairs are all looked at in its bucket, to leave out those that cannot have a partner there.
SHORT_LIST = 64
#: Partners per list in the first round, and by how much each round has more.
PARTNERS = 1
GROWTH = 8
#: First names of lists that a document's entries carry.
FIRST_LISTS = 8
#: Pairs of 16 bytes that are broadcast; more are joined by a shuffle.
BROADCAST_PAIRS = 1_000_000
#: Least bits of a sketch, and least bits per shingle.
SKETCH = 1024
SKETCH_PER_SHINGLE = 2
_COUNTER_BITS = 33
_M = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def shingles(text: str | bytes | None, words: int = WORDS) -> np.ndarray:
    """Distinct word n-grams of a text as sorted 64-bit numbers; a shorter text is one n-gram, an empty
    one (or null) none.  A-Z are lower-cased; words are split at ASCII white space."""
    if not text:
        return np.empty(0, np.uint64)
    parts = (text.encode() if isinstance(text, str) else text).lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    n = min(words, len(parts))
    count = len(parts) - n + 1
    out = np.full(count, n, np.uint64)
    for k in range(n):
        out = (out ^ h[k : k + count]) * _M[k % 4]
        out ^= out >> np.uint64(31)
    return np.unique(out)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketch(made: np.ndarray) -> bytes:
    """One bit per hash class, set if an odd number of shingles is in it; their number is a power of two."""
    bits = max(SKETCH, 1 << (SKETCH_PER_SHINGLE * len(made) - 1).bit_length())
    flipped = np.bincount(((made >> np.uint64(20)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flipped.astype(bool)).tobytes()


def differing(one: list[bytes], two: list[bytes]) -> np.ndarray:
    """In how many bits the sketches of each pair differ, the longer one folded to the length of the shorter."""
    out = np.zeros(len(one), np.int64)
    lengths = np.array([(len(a), len(b)) for a, b in zip(one, two, strict=True)]).reshape(-1, 2)
    for a, b in np.unique(lengths, axis=0):
        at = np.flatnonzero((lengths == (a, b)).all(axis=1))
        size = min(a, b) // 8
        folded = [
            np.bitwise_xor.reduce(np.frombuffer(b"".join(side[i] for i in at), np.uint64).reshape(len(at), -1, size), axis=1)
            for side in (one, two)
        ]
        out[at] = np.bitwise_count(folded[0] ^ folded[1]).sum(axis=1, dtype=np.int64)
    return out


def _collapsed(words: int):
    """(node, same_as, id, n, digest, sketch, text): sketch and text only where no earlier row of the task has the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = TaskContext.get().partitionId() << _COUNTER_BITS
        first: dict[bytes, int] = {}
        for batch in batches:
            nodes, same, sizes, digests, sketches, texts = [], [], [], [], [], []
            for value in batch.column(1):
                text = (value.as_py() or "").encode()
                made = shingles(text, words)
                digest = hashlib.md5(made.tobytes(), usedforsecurity=False).digest()
                fresh = len(made) and digest not in first
                nodes.append(node)
                same.append(first.setdefault(digest, node) if len(made) else node)
                sizes.append(len(made))
                digests.append(digest)
                sketches.append(sketch(made) if fresh else None)
                texts.append(len(text).to_bytes(8, "little") + pa.compress(text, codec="zstd", asbytes=True) if fresh else None)
                node += 1
            columns = [pa.array(nodes, pa.int64()), pa.array(same, pa.int64()), batch.column(0), pa.array(sizes, pa.int64())]
            columns += [pa.array(x, pa.binary()) for x in (digests, sketches, texts)]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "same_as", "id", "n", "digest", "sketch", "text"])

    return run


def _plain(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def _ordered(made: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The shingles of a set in the common order: by number, those of ``often`` last."""
    if not len(often):
        return made
    at = np.minimum(np.searchsorted(often, made), len(often) - 1)
    late = often[at] == made
    return np.concatenate([made[~late], made[late]])


def _bucketed(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0])
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def _count_blocks(buckets: int, words: int):
    """Shingles that some ``TOGETHER`` shingles of a task hold twice or more, with their counts there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(found: list[np.ndarray]) -> pa.RecordBatch:
            every = np.concatenate(found)
            found.clear()
            every.sort()  # in place: nothing else here is as large
            keys, counts = np.unique(every[1:][every[1:] == every[:-1]], return_counts=True)
            counts += 1
            blocks = [(b, keys[w].tobytes() + counts[w].astype("<i4").tobytes()) for b, w in _bucketed(keys, buckets)]
            columns = [pa.array([b for b, _ in blocks], pa.int32()), pa.array([d for _, d in blocks], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["bucket", "data"])

        found, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                found.append(shingles(_plain(text.as_py()), words))
                size += len(found[-1])
                if size >= TOGETHER:
                    yield counted(found)
                    found, size = [], 0
        if found:
            yield counted(found)

    return run


def _often(often: int):
    def run(rows: pa.Table) -> pa.Table:
        keys, counts = [], []
        for block in rows["data"]:
            data = block.as_buffer()
            n = data.size // 12
            keys.append(np.frombuffer(data, "<u8", n))
            counts.append(np.frombuffer(data, "<i4", n, 8 * n))
        distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(where, np.concatenate(counts)).astype(np.int64)
        many = total > often
        return pa.table({"shingle": distinct[many].view(np.int64), "documents": total[many]})

    return run


_ENTRY = np.dtype([("shingle", "<u8"), ("node", "<i8"), ("n", "<i4"), ("place", "<i4")])


def _planes(values: np.ndarray) -> bytes:
    """All first bytes, all second bytes, and so on: the high bytes of small numbers are equal then."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _packed(entries: np.ndarray) -> bytes:
    """Entries in order of their documents; a node is kept as its distance from the one before."""
    columns = {name: np.ascontiguousarray(entries[name]) for name in _ENTRY.names}
    columns["node"] = np.diff(columns["node"], prepend=0)
    return pa.compress(b"".join(map(_planes, columns.values())), codec="zstd", asbytes=True)


def _unpacked(data: pa.Buffer, n: int) -> dict[str, np.ndarray]:
    plain, at, columns = pa.decompress(data, n * _ENTRY.itemsize, codec="zstd"), 0, {}
    for name in _ENTRY.names:
        kind = _ENTRY[name]
        planes = np.frombuffer(plain, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        columns[name] = np.ascontiguousarray(planes.T).view(kind).reshape(n)
        at += n * kind.itemsize
    columns["node"] = np.cumsum(columns["node"])
    return columns


def _prefix(made: np.ndarray, percent: int, often: np.ndarray) -> np.ndarray:
    return _ordered(made, often)[: prefix_length(len(made), percent)]


def _entry_blocks(buckets: int, words: int, percent: int, often: np.ndarray):
    """Prefix entries by bucket.  Entries of frequent shingles need no partner search there, so they are
    spread over all buckets by document."""

    def blocks(found: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(found)
        keys = every["shingle"].copy()
        if len(often):
            late = often[np.minimum(np.searchsorted(often, keys), len(often) - 1)] == keys
            keys[late] ^= every["node"][late].astype(np.uint64) * _M[0] >> np.uint64(20)
        packed = [(b, _packed(every[w]), len(w)) for b, w in _bucketed(keys, buckets)]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in packed], kind) for k, kind in enumerate((pa.int32(), pa.binary(), pa.int64()))],
            names=["bucket", "data", "entries"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            for node, text in zip(batch.column(1).to_pylist(), batch.column(0), strict=True):
                made = shingles(_plain(text.as_py()), words)
                prefix = _prefix(made, percent, often)
                part = np.empty(len(prefix), _ENTRY)
                part["shingle"], part["node"], part["n"] = prefix, node, len(made)
                part["place"] = np.arange(len(prefix))
                found.append(part)
                size += len(part)
                if size >= FLUSHED:
                    yield blocks(found)
                    found, size = [], 0
        if found:
            yield blocks(found)

    return run


def _details(words: int, percent: int, often: np.ndarray):
    """The digest of every document's prefix, and its sketch folded to 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, low, high = [], [], []
            for text, whole in zip(batch.column(1), batch.column(2), strict=True):
                digests.append(xxhash.xxh3_64_intdigest(_prefix(shingles(_plain(text.as_py()), words), percent, often).tobytes()))
                a, b = np.bitwise_xor.reduce(np.frombuffer(whole.as_buffer(), "<i8").reshape(-1, 2))
                low.append(a)
                high.append(b)
            columns = [batch.column(0), pa.array(np.array(digests, np.uint64).view(np.int64)), pa.array(low, pa.int64()), pa.array(high, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "prefix", "low", "high"])

    return run


def _with_partner(e: dict[str, np.ndarray], percent: int) -> np.ndarray:
    """Which entries, in order of their shingles, share a list with one that sizes, places and sketches (if given) allow.

    A list of more than ``SHORT_LIST`` entries keeps all of them.
    """
    keys = e["shingle"]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    length = np.repeat(np.diff(np.append(starts, len(keys))), np.diff(np.append(starts, len(keys))))
    kept = length > SHORT_LIST
    n, place = e["n"].astype(np.int64), e["place"].astype(np.int64)
    for step in range(1, min(SHORT_LIST, len(keys))):
        a = np.flatnonzero((keys[step:] == keys[:-step]) & (length[step:] <= SHORT_LIST))
        if not len(a):
            break
        b = a + step
        sizes = n[a] + n[b]
        reach = np.minimum(place[a], place[b]) + 1 + np.minimum(n[a] - 1 - place[a], n[b] - 1 - place[b])
        differ = sum(np.bitwise_count((e[c][a] ^ e[c][b]).view(np.uint64)).astype(np.int64) for c in ("low", "high") if c in e)
        fits = (100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])) & ((100 + percent) * reach >= percent * sizes)
        fits &= (100 + percent) * (sizes - differ) >= 2 * percent * sizes
        kept[a[fits]] = kept[b[fits]] = True
    return kept


def _lists(keys: np.ndarray, nodes: np.ndarray, late: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers for the list of every entry, the same for lists of the same nodes: a sum of hashes, and the smallest node.

    Entries come in order of their shingles.  A ``late`` shingle's list is not whole here; it goes by the shingle and -1.
    """
    if not len(keys):
        return keys, nodes
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    length = np.diff(np.append(starts, len(keys)))
    mixed = (nodes.astype(np.uint64) + _M[0]) * _M[1]
    mixed = (mixed ^ mixed >> np.uint64(32)) * _M[2]
    mixed ^= mixed >> np.uint64(29)
    of_list = np.repeat(np.add.reduceat(mixed, starts), length), np.repeat(np.minimum.reduceat(nodes, starts), length)
    return np.where(late, keys, of_list[0]), np.where(late, -1, of_list[1])


def _shared(often: np.ndarray, percent: int):
    """Entries that may have a partner in their list, or whose shingle is frequent anyway."""

    def run(rows: pa.Table) -> pa.Table:
        parts: dict[str, list] = {name: [] for name in _ENTRY.names}
        for block, n in zip(rows["data"], rows["entries"].to_pylist(), strict=True):
            for name, column in _unpacked(block.as_buffer(), n).items():
                parts[name].append(column)
        order = np.argsort(np.concatenate(parts["shingle"]), kind="stable")
        columns = {name: np.concatenate(p)[order] for name, p in parts.items()}
        kept = _with_partner(columns, percent)
        keys = columns["shingle"]
        late = often[np.minimum(np.searchsorted(often, keys), len(often) - 1)] == keys if len(often) else np.zeros(len(keys), bool)
        kept |= late
        columns = {name: c[kept] for name, c in columns.items()}
        columns["shingle"], columns["first"] = _lists(columns["shingle"], columns["node"], late[kept])
        return pa.table({name: c.view(np.int64) if c.dtype == np.uint64 else c for name, c in columns.items()})

    return run


_SHARED = "shingle long, node long, n int, place int, first long"
#: What names a list: see ``_lists``.
LIST = ["shingle", "first"]


def _verified(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, theirs = None, np.empty(0, np.uint64)
        for batch in batches:
            x, y = batch.column(0), batch.column(1)
            keep = []
            for mine, partner, other in zip(batch.column(2), y.to_pylist(), batch.column(3), strict=True):
                if partner != last:
                    last, theirs = partner, shingles(_plain(other.as_py()), words)
                keep.append(similar(shingles(_plain(mine.as_py()), words), theirs, percent))
            yield pa.RecordBatch.from_arrays([x, y], names=["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


def _attached(pairs: DataFrame, rows: int, sides: DataFrame) -> DataFrame:
    """Pairs with both sides' ``n`` and ``data``; ``sides`` is (node, n, data)."""
    hint = F.broadcast if rows <= BROADCAST_PAIRS else (lambda df: df)
    theirs = sides.join(hint(pairs.select(F.col("y").alias("node")).distinct()), "node")
    theirs = theirs.select(F.col("node").alias("y"), F.col("n").alias("their_n"), F.col("data").alias("their_data"))
    mine = sides.join(hint(pairs.withColumnRenamed("x", "node")), "node").withColumnRenamed("node", "x")
    return mine.join(theirs.hint("merge"), "y").select("x", "y", "data", "their_data", "n", "their_n")


def _possible(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(4).to_numpy() + batch.column(5).to_numpy()
            differ = differing(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            # The overlap is at most (size - differ) / 2 and must be at least percent / (100 + percent) * size.
            keep = (100 + percent) * (size - differ) >= 2 * percent * size
            apart = differ / np.maximum(size, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(apart)], names=["x", "y", "apart"]).filter(pa.array(keep))

    return run


def verified(pairs: DataFrame, rows: int, sets: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The (x, y) of ``pairs`` whose sets are similar; ``sets`` is (node, n, text)."""
    texts = sets.select("node", "n", F.col("text").alias("data"))
    return _attached(pairs, rows, texts).mapInArrow(releasing(_verified(words, percent)), "x long, y long")


def _between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The ``pairs`` (x, y) of two components with their labels ``of_x`` and ``of_y``."""
    for side in ("x", "y"):
        found = labels.select(F.col("node").alias(side), F.col("label").alias(f"of_{side}"))
        pairs = pairs.join(found, side, "left").withColumn(f"of_{side}", F.coalesce(f"of_{side}", side))
    return pairs.where("of_x <> of_y")


def linked(pairs: DataFrame, rows: int, sets: DataFrame, labels: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``labels`` (node, label) after the links among ``pairs``; ``sets`` is (node, n, sketch, text).

    Texts only travel for pairs that their sketches allow, and whose documents are not connected already:
    first those of every document and its likeliest partner, then those that are still in two components.
    """
    sketches = sets.select("node", "n", F.col("sketch").alias("data"))
    likely = store(_attached(pairs, rows, sketches).mapInArrow(releasing(_possible(percent)), "x long, y long, apart double"), "jaccard-likely")
    if not likely.rows:
        return labels

    def joined_to(now: DataFrame, chosen: DataFrame, count: int) -> DataFrame:
        links = verified(chosen, count, sets, words, percent)
        # What is connected already counts as one node, its label: steps only move what new links reach.
        found = store(components(_between(links, now).select(F.col("of_x").alias("x"), F.col("of_y").alias("y"))), "jaccard-found").table
        moved = now.join(found.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
        fresh = found.join(now.select("node"), "node", "left_anti")
        return moved.select("node", F.coalesce("to", "label").alias("label")).unionByName(fresh)

    best = likely.table.groupBy("x").agg(F.min(F.struct("apart", "y")).alias("best"))
    first = store(best.select("x", F.col("best.y").alias("y")), "jaccard-first")
    labels = joined_to(labels, first.table, first.rows)
    others = likely.table.select("x", "y").join(first.table, ["x", "y"], "left_anti")
    rest = store(_between(others, labels).select("x", "y"), "jaccard-rest")
    return joined_to(labels, rest.table, rest.rows) if rest.rows else labels


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (x, y): label is the smallest node of its component.

    Large-star and small-star steps until nothing changes.  Neighbours are never gathered: a step is an
    aggregate and a join, on rows of two numbers.
    """
    both = edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).where("x <> y").distinct()
    now = store(both, "jaccard-edges", mark=F.sum(F.xxhash64("x", "y") % 1_000_003))
    while now.rows:
        way = now.table.unionByName(now.table.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = way.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = way.join(least, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")).where("x <> y")
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        joined = large.join(least, "x")
        small = joined.select(F.col("y").alias("x"), F.col("m").alias("y")).where("x <> y").unionByName(least.select("x", F.col("m").alias("y"))).distinct()
        new = store(small, "jaccard-edges", mark=F.sum(F.xxhash64("x", "y") % 1_000_003))
        if (new.rows, new.figures["mark"]) == (now.rows, now.figures["mark"]):
            break
        now = new
    stars = now.table
    roots = stars.select(F.col("y").alias("node")).distinct()
    return stars.select(F.col("x").alias("node"), F.col("y").alias("label")).unionByName(roots.select("node", F.col("node").alias("label")))


def _labelled(df: DataFrame, labels: DataFrame) -> DataFrame:
    return df.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _first_list() -> Column:
    """Whether no earlier list is known to hold both documents.

    A pair waits for its first list: that one, too, is in one component in the end, or used up.  In the first
    round every document shall meet the first of each of its lists.
    """
    earlier = F.array_min(F.array_intersect("lists", "p_lists"))
    return F.coalesce(F.xxhash64(*LIST) <= earlier, F.lit(True))


def _required(a: Column, b: Column, percent: int) -> Column:
    """The least overlap of similar sets of sizes a and b."""
    return F.ceil(percent * (a + b) / F.lit(100 + percent))


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The id, ``n_shingles`` and ``component_id`` (the smallest id reachable by links) of every row.

    A null text, or one without words, has no shingle, links with nothing and is its own component.  Rows
    with equal sets are linked, also where they repeat an id.  A null id is reachable but is no component's
    smallest unless it has only null ids.  An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    with small_batches(spark), short_shuffles(spark), plain_reads(spark), dropping(spark) as made:
        result = write_out(_components_of_rows(docs, id_col, text_col, words, percent, made), "jaccard-result")
        made.pop()  # the result stays, all tables that led to it go
    return result


def _components_of_rows(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, made: list[str]) -> DataFrame:
    """The rows of :func:`joined`; the tables they still depend on are added to ``made``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    stored = store(
        rows.mapInArrow(releasing(_collapsed(words)), f"node long, same_as long, id {kind}, n long, digest binary, sketch binary, text binary"), "jaccard-sets",
        entries=F.sum(F.when(F.col("text").isNotNull(), F.floor(F.col("n") * (100 - percent) / 100) + 1)),
    )
    saved = stored.table
    # What a bucket holds does not grow with the table.
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(stored.figures["entries"] or 0) // BUCKET_ENTRIES))
    sets = saved.where("text is not null").select("node", "n", "sketch", "text")
    counted = sets.select("text").mapInArrow(releasing(_count_blocks(buckets, words)), "bucket int, data binary")
    found = counted.groupBy("bucket").applyInArrow(_often(OFTEN), "shingle long, documents long")
    top = found.orderBy(F.desc("documents"), "shingle").limit(MOST_OFTEN).select("shingle").toArrow()
    often = np.sort(top["shingle"].to_numpy().view(np.uint64))

    blocks = sets.select("text", "node").mapInArrow(releasing(_entry_blocks(buckets, words, percent, often)), "bucket int, data binary, entries long")
    entries = blocks.groupBy("bucket").applyInArrow(_shared(often, percent), _SHARED)
    # Shingles come in one order in all documents, so the smallest places belong to one shingle of those with a list in common.

    # Equal sets of different tasks: the first stands for all of them.
    digests = saved.where("text is not null").select("digest", "node")
    least = digests.groupBy("digest").agg(F.min("node").alias("label"), F.count("*").alias("c")).where("c > 1").drop("c")
    copies = store(digests.join(least, "digest").where("node <> label").select("node", "label"), "jaccard-copies")
    stars = copies.table.unionByName(copies.table.select(F.col("label").alias("node"), "label").distinct())
    labels = store(stars, "jaccard-labels")
    entries = entries.join(bounded(copies.table.select("node"), copies.rows), "node", "left_anti")

    bare = store(entries.groupBy(*LIST, "node", "n").agg(F.min("place").alias("place")), "jaccard-entries")
    names = F.array_sort(F.collect_list(F.xxhash64(*LIST)))
    firsts = bare.table.groupBy("node").agg(F.slice(names, 1, FIRST_LISTS).alias("lists"))
    left = sets.join(bounded(bare.table.select("node").distinct(), bare.rows), "node", "left_semi").select("node", "text", "sketch")
    details = left.mapInArrow(releasing(_details(words, percent, often)), "node long, prefix long, low long, high long")
    lists = store(bare.table.join(firsts.join(details, "node"), "node"), "jaccard-lists")

    low, high = 0, PARTNERS
    open_lists = lists
    while open_lists.rows:
        now = _labelled(open_lists.table.drop("label"), bounded(labels.table, labels.rows))
        span = now.groupBy(*LIST).agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count("*").alias("size"))
        undecided = store(span.where(f"a < b and size > {low}").select(*LIST, "size"), "jaccard-undecided", most=F.max("size"))
        if not undecided.rows:
            break
        open_lists = store(now.join(bounded(undecided.table.select(*LIST), undecided.rows), LIST, "left_semi"), "jaccard-open")
        place = Window.partitionBy(*LIST).orderBy("n", "prefix", "node")
        ranked = open_lists.table.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= high)
        partners = ranked.where(F.col("rank") > low).select(
            *LIST, *[F.col(c).alias(f"p_{c}") for c in ("node", "n", "place", "prefix", "low", "high", "label", "lists")]
        )
        e, p = F.col("n"), F.col("p_n")
        reach = F.least("place", "p_place") + 1 + F.least(e - 1 - F.col("place"), p - 1 - F.col("p_place"))
        differ = sum(F.bit_count(F.col(c).bitwiseXOR(F.col(f"p_{c}"))) for c in ("low", "high"))
        pairs = (
            open_lists.table.join(partners, LIST)
            .where(F.struct("p_n", "p_prefix", "p_node") < F.struct("n", "prefix", "node"))
            .where(F.col("label") != F.col("p_label"))
            .where((100 + percent) * (e + p - differ) >= 2 * percent * (e + p))
            .where((100 * p >= percent * e) & (reach >= _required(e, p, percent)))
            .where(_first_list() if low else F.lit(True))
            .select(F.col("node").alias("x"), F.col("p_node").alias("y"))
            .distinct()
        )
        with dropping(spark) as steps:
            chosen = store(pairs, "jaccard-pairs")
            if chosen.rows:
                labels = store(linked(chosen.table, chosen.rows, sets, labels.table, words, percent), "jaccard-labels")
                made.append(steps.pop())  # the labels stay for now, the tables that led to them go
        if undecided.figures["most"] <= high:
            break
        low, high = high, high * GROWTH

    named = _labelled(saved.select("id", "n", F.col("same_as").alias("node")), bounded(labels.table, labels.rows))
    smallest = named.groupBy("label").agg(F.min("id").alias("component_id"))
    return named.join(smallest, "label").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, nulls last.

    Rows without a word are components of their own and stay.
    """
    rows = keyed(docs, "jaccard-docs")
    found = joined(rows.select("key", F.col(f"doc.`{text_col}`").alias("text")), "key", "text", words, percent)
    order = F.struct(F.col("id").isNull(), "id", "key")
    ids = rows.select("key", F.col(f"doc.`{id_col}`").alias("id"))
    first = found.join(ids, "key").groupBy("component_id").agg(F.min(order).alias("first"))
    with plain_reads(docs.sparkSession):
        chosen = store(first.select(F.col("first.key").alias("key")), "jaccard-chosen")
    return rows.join(bounded(chosen.table, chosen.rows), "key", "left_semi").select("doc.*")
