"""Removal of repeated byte strings by a distributed merge sort of suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else.  Sorting every
suffix would move the text ``LENGTH`` times over, so only anchored suffixes are sorted: each string of
``LENGTH`` bytes picks, by its content alone, the position of its least hashed ``GRAM``-byte gram as its
anchor.  Equal strings have equal anchors, so two strings are equal exactly if the suffixes at their
anchors agree to the right, up to the string's end, and the bytes before the anchors agree to the left.
One anchor serves a run of neighbouring strings; there is about one in 70 bytes.

1. The documents are dealt into cells by digest of the text; copies of a text meet there and count once.
   Tasks drop copies before anything is sent.
2. Cells find their anchors and send the grams' hashes to buckets; a bucket returns the anchors whose
   gram occurs twice.  The others cannot start a repeated string.  (Equal hashes of different grams
   only let an anchor through for nothing; no decision rests on a hash.)
3. Cells sort the suffixes of the anchors that are left and send them to the buckets as sorted runs,
   front-coded: a suffix is its common prefix with the one before it, as a number, and the rest.
   Equal suffixes of a cell travel once, so a passage that a third of all documents hold costs each
   bucket one entry per cell.
4. A bucket merges its runs with a loser tree that knows the common prefix of every waiting suffix with
   the last one put out; it compares bytes only behind prefixes that are equal so far, and never again
   those that are known.  It yields the sorted suffixes and the common prefixes of neighbours.
5. From these, and the order of the bytes before the anchors, follows for every string whether another
   one equals it.  Cells get back the stretches to remove.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 200
GRAM = 64
#: Gram positions inside a string; also the most by which an anchor can lie behind the string's start, plus 1.
PLACES = LENGTH - GRAM + 1
#: Strings looked at together; with its place in the low bits a hash keeps 64 - _PLACE_BITS bits.
CHUNK = 1 << 19
_PLACE_BITS = 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: An anchor: its gram's hash, its place in the cell, and how far behind their starts it lies in its strings.
_ANCHOR = np.dtype([("hash", "<u8"), ("at", "<u4"), ("low", "u1"), ("high", "u1")])
_FOUND = np.dtype([("at", "<u4"), ("low", "u1"), ("high", "u1")])
_STRETCH = np.dtype([("start", "<u4"), ("end", "<u4")])


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        factors = np.full(CHUNK + LENGTH, base, np.uint64)
        factors[0] = 1
        out.append(np.multiply.accumulate(factors))
    return out[0], out[1]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from every position on."""
    up, down = _powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * up[: len(data)], out=sums[1:])
    h = (sums[GRAM:] - sums[:-GRAM]) * down[: len(data) - GRAM + 1]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def _least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The anchors of all strings of ``LENGTH`` bytes in texts laid end to end; ``ends`` are their ends."""
    out = []
    low_bits = np.uint64((1 << _PLACE_BITS) - 1)
    last = len(data) - LENGTH  # the last start
    for begin in range(0, last + 1, CHUNK):
        end = min(begin + CHUNK, last + 1)
        h = gram_hashes(data[begin : end + LENGTH - 1])
        ranked = (h & ~low_bits) | np.arange(len(h), dtype=np.uint64)
        place = (_least_in_window(ranked, PLACES) & low_bits).astype(np.int64)
        starts = np.arange(begin, end)
        inside = starts + LENGTH <= ends[np.searchsorted(ends, starts, side="right")]
        starts, place = starts[inside], place[inside]
        if not len(starts):
            continue
        # A run: neighbouring starts with one anchor.
        first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)])
        lasts = np.r_[first[1:], len(starts)] - 1
        found = np.empty(len(first), _ANCHOR)
        found["hash"] = h[place[first]]
        found["at"] = place[first] + begin
        found["low"] = place[first] + begin - starts[lasts]
        found["high"] = place[first] + begin - starts[first]
        out.append(found)
    return np.concatenate(out) if out else np.empty(0, _ANCHOR)


class Cell:
    """The distinct texts of a cell in order of their digests, laid end to end."""

    def __init__(self, rows: pa.Table):
        keys = rows["key"].to_pylist()
        copies: dict[bytes, int] = {}
        first: dict[bytes, int] = {}
        for k, (key, n) in enumerate(zip(keys, rows["copies"].to_pylist(), strict=True)):
            copies[key] = copies.get(key, 0) + n
            first.setdefault(key, k)
        self.keys = sorted(copies)
        self.copies = [copies[key] for key in self.keys]
        texts = rows["text"].take(pa.array([first[key] for key in self.keys], pa.int64()))
        parts = [t.as_buffer() for t in texts]
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.ends = np.cumsum([p.size for p in parts]) if parts else np.zeros(0, np.int64)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading bytes the rows of a and b have in common."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def _as_strings(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


def _windows(data: np.ndarray, at: np.ndarray, lengths: np.ndarray, width: int, step: int) -> np.ndarray:
    """``lengths`` bytes from every ``at`` on, forwards or backwards, filled up with zeros."""
    offsets = np.arange(width)
    index = at[:, None] + step * offsets[None, :]
    inside = offsets[None, :] < lengths[:, None]
    return np.where(inside, data[np.where(inside, index, 0)], 0).astype(np.uint8)


def encoded_run(data: np.ndarray, found: np.ndarray) -> bytes:
    """A sorted, front-coded run of the suffixes at the anchors ``found``.

    A suffix goes to the end of the anchor's last string, ``LENGTH - low`` bytes; with it go the ``high``
    bytes before it, nearest first, front-coded as well.  Anchors that agree in all are one entry.
    """
    at = found["at"].astype(np.int64)
    low, high = found["low"].astype(np.int64), found["high"].astype(np.int64)
    right = _windows(data, at, LENGTH - low, LENGTH, 1)
    left = _windows(data, at - 1, high, PLACES - 1, -1)
    rows = np.concatenate([right, left, found["low"][:, None], found["high"][:, None]], axis=1)
    order = np.argsort(_as_strings(rows), kind="stable")
    rows, at = rows[order], at[order]
    fresh = np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)]
    first = np.flatnonzero(fresh)
    members = np.diff(np.r_[first, len(rows)])
    rows = rows[first]
    right, left = rows[:, :LENGTH], rows[:, LENGTH:-2]
    low, high = rows[:, -2].astype(np.int64), rows[:, -1].astype(np.int64)
    prefix, before = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    # The merge needs the common prefixes as they are, filling included; what is left out is within the suffix.
    prefix[1:] = _common(right[1:], right[:-1])
    before[1:] = _common(left[1:], left[:-1])

    def rest(block: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
        offsets = np.arange(block.shape[1])[None, :]
        return block[(offsets >= start[:, None]) & (offsets < end[:, None])].tobytes()

    parts = [
        np.array([len(rows), len(at)], "<u4").tobytes(),
        prefix.astype(np.uint8).tobytes(), before.astype(np.uint8).tobytes(),
        low.astype(np.uint8).tobytes(), high.astype(np.uint8).tobytes(),
        members.astype("<u4").tobytes(), at.astype("<u4").tobytes(),
        rest(right, np.minimum(prefix, LENGTH - low), LENGTH - low), rest(left, np.minimum(before, high), high),
    ]
    plain = b"".join(parts)
    return len(plain).to_bytes(8, "little") + pa.compress(plain, codec="zstd", asbytes=True)


class Run:
    """A decoded run: suffixes and left sides filled up with zeros, common prefixes with the one before."""

    def __init__(self, data: bytes):
        plain = memoryview(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True))
        n, m = np.frombuffer(plain[:8], "<u4").tolist()
        at = 8

        def take(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(plain, dtype, count, at)
            at += out.nbytes
            return out

        self.prefix, before = take("u1", n), take("u1", n)
        self.low, self.high = take("u1", n), take("u1", n)
        self.members, self.at = take("<u4", n), take("<u4", m)
        self.suffixes, at = self._unfold(plain, at, self.prefix, LENGTH - self.low.astype(np.int64), LENGTH)
        self.lefts, at = self._unfold(plain, at, before, self.high.astype(np.int64), PLACES - 1)

    @staticmethod
    def _unfold(plain, at: int, prefix: np.ndarray, lengths: np.ndarray, width: int) -> tuple[list[bytes], int]:
        out, last = [], b""
        for p, n in zip(prefix.tolist(), lengths.tolist(), strict=True):
            p = min(p, n)
            end = at + n - p
            last = (last[:p] + bytes(plain[at:end])).ljust(width, b"\0")
            out.append(last)
            at = end
        return out, at


def merged(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """Merge sorted runs of (strings of one length, common prefix of each with the one before it).

    The result, in sorted order: run, index in the run, common prefix with the string before.  In the loser
    tree every waiting string carries its common prefix with the last string put out.  Of two strings the
    one with the longer prefix is the smaller; only if the prefixes are equal are bytes compared, from
    there on, and what is found becomes the loser's prefix.
    """
    leaves = 1
    while leaves < max(1, len(runs)):
        leaves *= 2
    heads: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (leaves - len(runs))
    at = [0] * leaves
    known = [0] * leaves  # common prefix of a run's head with the last string put out
    losers = [-1] * leaves

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's prefix becomes its common prefix with the winner."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        pa_, pb = known[a], known[b]
        if pa_ > pb:
            return a, b
        if pa_ < pb:
            return b, a
        u, v = int.from_bytes(x[pa_:], "big"), int.from_bytes(y[pa_:], "big")
        if u == v:
            if a < b:
                known[b] = len(y)
                return a, b
            known[a] = len(x)
            return b, a
        same = len(x) - (((u ^ v).bit_length() + 7) >> 3)
        if u < v:
            known[b] = same
            return a, b
        known[a] = same
        return b, a

    def build(node: int) -> int:
        if node >= leaves:
            return node - leaves
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    out_run, out_at, out_prefix = [], [], []
    while heads[winner] is not None:
        strings, prefixes = runs[winner]
        k = at[winner]
        out_run.append(winner)
        out_at.append(k)
        out_prefix.append(known[winner])
        k += 1
        at[winner] = k
        if k < len(strings):
            heads[winner], known[winner] = strings[k], prefixes[k]
        else:
            heads[winner], known[winner] = None, 0
        node = (winner + leaves) >> 1
        while node:
            winner, losers[node] = play(winner, losers[node])
            node >>= 1
    return out_run, out_at, out_prefix


def repeated(runs: list[Run]) -> Iterator[tuple[int, np.ndarray]]:
    """(run, stretches to remove): for every anchor, all its strings that another one equals."""
    run_of, index, prefix = merged([(r.suffixes, r.prefix.tolist()) for r in runs])
    if not run_of:
        return
    base = np.cumsum([0, *(len(r.suffixes) for r in runs)])
    entry = base[np.array(run_of)] + np.array(index)  # in merged order
    prefix = np.array(prefix)
    n = len(entry)

    def joined(name: str) -> np.ndarray:
        return np.concatenate([getattr(r, name) for r in runs])[entry].astype(np.int64)

    low, high, members = joined("low"), joined("high"), joined("members")
    lefts = np.frombuffer(b"".join([x for r in runs for x in r.lefts]), np.uint8).reshape(n, PLACES - 1)[entry]
    order = np.argsort(_as_strings(lefts), kind="stable")
    ordered = lefts[order]
    common_left = np.r_[0, _common(ordered[1:], ordered[:-1])] if n > 1 else np.zeros(n, np.int64)
    # Several anchors in one entry are equal in all their strings.
    least = np.where(members > 1, low, PLACES)
    most = np.where(members > 1, high, -1)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(PLACES):
        who = np.flatnonzero((low <= d) & (d <= high))
        if len(who) < 2:
            continue
        np.cumsum(prefix < LENGTH - d, out=right_class)
        left_class[order] = np.cumsum(common_left < d)
        both = right_class[who] * (n + 1) + left_class[who]
        ranked = np.argsort(both, kind="stable")
        same = both[ranked[1:]] == both[ranked[:-1]]
        hit = np.zeros(len(who), bool)
        hit[ranked[1:][same]] = True
        hit[ranked[:-1][same]] = True
        hits = who[hit]
        least[hits] = np.minimum(least[hits], d)
        most[hits] = np.maximum(most[hits], d)
    # The strings of one anchor overlap, so those removed are one stretch.
    back = np.empty(n, np.int64)
    back[entry] = np.arange(n)
    for k, run in enumerate(runs):
        mine = back[base[k] : base[k + 1]]
        nearest, farthest = np.repeat(least[mine], run.members), np.repeat(most[mine], run.members)
        gone = farthest >= 0
        out = np.empty(int(gone.sum()), _STRETCH)
        out["start"] = run.at[gone] - farthest[gone]
        out["end"] = run.at[gone] - nearest[gone] + LENGTH
        if len(out):
            yield k, out


def _dealt(cells: int):
    """Texts by cell, copies that a task meets again sent once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            first: dict[bytes, int] = {}
            copies: dict[bytes, int] = {}
            for k, text in enumerate(texts):
                key = hashlib.md5(text.as_buffer(), usedforsecurity=False).digest()
                first.setdefault(key, k)
                copies[key] = copies.get(key, 0) + 1
            keys = list(first)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int.from_bytes(key[:8], "little") % cells for key in keys], pa.int32()),
                    pa.array(keys, pa.binary()),
                    pa.array([copies[key] for key in keys], pa.int64()),
                    texts.take(pa.array([first[key] for key in keys], pa.int64())),
                ],
                names=["cell", "key", "copies", "text"],
            )

    return run


def _blocks(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array([r[0] for r in rows], pa.int32()),
            "cell": pa.array([r[1] for r in rows], pa.int32()),
            "data": pa.array([r[2] for r in rows], pa.binary()),
        }
    )


_BLOCKS = "bucket int, cell int, data binary"


def _by_bucket(found: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    bucket = ((found["hash"] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0])
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        yield int(bucket[order[a]]), found[order[a:b]]


def _anchor_blocks(buckets: int):
    def run(rows: pa.Table) -> pa.Table:
        cell = Cell(rows)
        found = anchors(cell.data, cell.ends)
        if not len(found):
            return _blocks([])
        return _blocks([(b, rows["cell"][0].as_py(), part.tobytes()) for b, part in _by_bucket(found, buckets)])

    return run


def _met_again(rows: pa.Table) -> pa.Table:
    bucket = rows["bucket"][0].as_py()
    parts = [np.frombuffer(x.as_buffer(), _ANCHOR) for x in rows["data"]]
    _, where, counts = np.unique(np.concatenate([p["hash"] for p in parts]), return_inverse=True, return_counts=True)
    twice = counts[where] > 1
    out, at = [], 0
    for cell, part in zip(rows["cell"].to_pylist(), parts, strict=True):
        mine = part[twice[at : at + len(part)]]
        at += len(part)
        if len(mine):
            kept = np.empty(len(mine), _FOUND)
            for name in _FOUND.names:
                kept[name] = mine[name]
            out.append((bucket, cell, kept.tobytes()))
    return _blocks(out)


def _run_blocks(texts: pa.Table, found: pa.Table) -> pa.Table:
    if not found.num_rows or not texts.num_rows:
        return _blocks([])
    cell = Cell(texts)
    out = []
    for bucket, number, block in zip(*(found[c] for c in ("bucket", "cell", "data")), strict=True):
        part = np.frombuffer(block.as_buffer(), _FOUND)
        out.append((bucket.as_py(), number.as_py(), encoded_run(cell.data, part)))
    return _blocks(out)


def _merged_blocks(rows: pa.Table) -> pa.Table:
    bucket, cells = rows["bucket"][0].as_py(), rows["cell"].to_pylist()
    order = np.argsort(cells, kind="stable").tolist()
    runs = [Run(rows["data"][k].as_py()) for k in order]
    return _blocks([(bucket, cells[order[k]], s.tobytes()) for k, s in repeated(runs)])


_RESULT = "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cleaned(with_kept: bool):
    def run(texts: pa.Table, stretches: pa.Table) -> pa.Table:
        cell = Cell(texts)
        marks = np.zeros(len(cell.data) + 1, np.int32)
        for block in stretches["data"] if stretches.num_rows else []:
            part = np.frombuffer(block.as_buffer(), _STRETCH)
            np.add.at(marks, part["start"], 1)
            np.add.at(marks, part["end"], -1)
        gone = np.cumsum(marks)[:-1] > 0
        columns: dict[str, list] = {name: [] for name in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        at = 0
        for end, copies in zip(cell.ends.tolist(), cell.copies, strict=True):
            data, out = cell.data[at:end], gone[at:end]
            if copies > 1 and len(data) >= LENGTH:  # all of its strings start in its copies, too
                out = np.ones(len(data), bool)
            kept = data[~out].tobytes()
            columns["n_bytes"].append(len(data))
            columns["n_removed"].append(int(out.sum()))
            columns["n_spans"].append(int(np.count_nonzero(out[1:] & ~out[:-1]) + bool(len(out) and out[0])))
            columns["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            columns["kept"].append(kept if with_kept else None)
            at = end
        kinds = dict.fromkeys(("n_bytes", "n_removed", "n_spans"), pa.int64()) | {"kept_sha256": pa.string(), "kept": pa.binary()}
        return pa.table({"key": pa.array(cell.keys, pa.binary()), **{c: pa.array(v, kinds[c]) for c, v in columns.items()}})

    return run


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """The id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, on demand, the ``kept`` bytes of every row.

    Texts are UTF-8 bytes, and a null one is empty.  Strings never cross texts.  Rows with one text, whatever
    their ids, are copies of each other: all of a text of ``LENGTH`` bytes or more goes.  Texts below that
    length stay whole.  An empty table gives no rows; other columns are not read.

    There are as many cells and buckets as shuffle partitions, so that setting bounds what a task holds.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    texts = docs.select(text.alias("text")).mapInArrow(_dealt(parts), "cell int, key binary, copies long, text binary")
    by_cell = texts.groupBy("cell")
    found = by_cell.applyInArrow(_anchor_blocks(parts), _BLOCKS).groupBy("bucket").applyInArrow(_met_again, _BLOCKS)
    runs = by_cell.cogroup(found.groupBy("cell")).applyInArrow(_run_blocks, _BLOCKS)
    stretches = runs.groupBy("bucket").applyInArrow(_merged_blocks, _BLOCKS)
    results = by_cell.cogroup(stretches.groupBy("cell")).applyInArrow(_cleaned(with_kept), _RESULT)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.unhex(F.md5(text)).alias("key"))
    wanted = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_kept else [])]
    return rows.join(results, "key").select(F.col("_id").alias(id_col), *wanted)
