"""Periodic runs of words by maximal pairs of a bottom-up LCP-interval tree.

A run is a stretch of words with smallest period q and length ``max(LEAST, EXPONENT * q)`` or more that no
neighbouring word extends.  Two occurrences of one word string, q words apart, differing in the word to
their left and in the word to their right, are a maximal pair; if the string has l words, the stretch that
both cover has q + l words and period q, and cannot be extended.  So the maximal pairs with
``q + l >= max(LEAST, EXPONENT * q)`` are the runs, without any extension of what was found: pairs of the
same stretch tell multiples of its period, and the smallest distance is the period.

1. The length constraint asks for common prefixes of ``SHORTEST`` words or more.  Words that lie in no
   window of ``SHORTEST`` words which its document holds twice are left out, a gap becoming one word of its
   own: nothing of that depth is changed, and ordinary prose all but vanishes.
2. The suffixes of what remains are sorted by prefix doubling over many documents at once; words of
   different documents are different, so no interval spans two.  The ranks of the doublings give the LCPs.
3. The LCP intervals are closed bottom-up.  A node holds its positions in ascending order, each with its
   left-word class.  When a child is merged into its node, positions of different children within reach
   (a third of the node's depth) and of different classes are maximal pairs.  Occurrences of a string of l
   words within l / 2 words stand in arithmetic progression, all but the first after the same word, all but
   the last in one child: so only the lowest and the highest position in reach can be a partner, and the
   smaller side is always looked up in the larger one.  That bounds the work at n log n, also where one word
   fills a document.

Each document is worked on by itself inside ``mapInArrow``; nothing is shuffled, and memory is a batch of
documents of ``BATCH_WORDS`` words, or one longer document.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run has at least so many words, and so many periods.
LEAST = 6
EXPONENT = 4
#: Documents are sorted together up to so many words.
BATCH_WORDS = 1 << 18

SCHEMA = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
    "collapsed_sha256 string, n_words long, n_dropped long"
)


def shortest(least: int = LEAST, exponent: int = EXPONENT) -> int:
    """The common words that any run's maximal pair has at least: max(least, exponent * q) - q over all q."""
    return min(max(least, exponent * q) - q for q in range(1, least + 1))


def rebuilt_order(doc_id: int | None, n: int) -> np.ndarray:
    """For each word the number of the original word that stands there: one document in ten gets a periodic
    tail, chosen by the CRC of its id.  A null id changes nothing."""
    order = np.arange(n)
    if doc_id is None or n == 0:
        return order
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0:
        g = h // 10
        a = g % n
        order[a:] = a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return order


def _repeated_windows(words: np.ndarray, width: int) -> np.ndarray:
    """Which words lie in a window of ``width`` words that occurs twice.

    Windows are compared by a 64-bit mix, so a few more words may be kept: that adds work, never a pair.
    """
    n = len(words) - width + 1
    kept = np.zeros(len(words), bool)
    if n < 2:
        return kept
    mix = np.zeros(n, np.uint64)
    for k in range(width):
        mix = (mix ^ words[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mix ^= mix >> np.uint64(29)
    order = np.argsort(mix, kind="stable")
    same = mix[order[1:]] == mix[order[:-1]]
    again = np.zeros(n, np.int64)
    again[order[1:][same]] = 1
    again[order[:-1][same]] = 1
    open_windows = np.zeros(len(words) + 1, np.int64)
    open_windows[:n] += again
    open_windows[width : width + n] -= again
    return np.cumsum(open_windows[:-1]) > 0


def _without_gaps(words: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, their positions): the kept words, a word of its own before every stretch of them and at the end."""
    at = np.flatnonzero(kept)
    heads = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    fresh = int(words.max(initial=0)) + 1
    short = np.insert(words[at], heads, fresh + np.arange(len(heads)))
    where = np.insert(at, heads, -1)
    return np.append(short, fresh + len(heads)), np.append(where, -1)


def suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, lcp): ``lcp[k]`` is the common prefix of suffixes k and k + 1.  The last word is unique."""
    n = len(words)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    levels, step = [rank.astype(np.int32)], 1
    while True:
        later = np.zeros(n, np.int64)
        later[: n - step] = rank[step:] + 1 if step < n else 0
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank = new
        if rank[order[-1]] == n - 1:
            break
        levels.append(rank.astype(np.int32))
        step *= 2
    left, right = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        ranks = levels[k]
        inside = (left < n) & (right < n)
        same = np.zeros(n - 1, bool)
        same[inside] = ranks[left[inside]] == ranks[right[inside]]
        grown = same.astype(np.int64) << k
        lcp += grown
        left += grown
        right += grown
    return order, lcp


def maximal_pairs(
    order: list[int], lcp: list[int], where: list[int], lefts: list[int], least: int, exponent: int
) -> Iterator[tuple[int, int, int]]:
    """(first position, distance, common words) of the maximal pairs that satisfy the length constraint.

    ``order`` and ``lcp`` are of the shortened words, ``where`` and ``lefts`` give a suffix's position and the
    word before it.
    """
    depth = shortest(least, exponent)
    left_class: dict[int, int] = {}
    found: list[tuple[int, int, int]] = []

    def merged(words: int, node: list[int], child: list[int]) -> list[int]:
        if len(child) > len(node):
            node, child = child, node
        reach = words // (exponent - 1)
        for at in child:
            mine = left_class[at]
            place = bisect_left(node, at)
            low = bisect_left(node, at - reach, 0, place)
            if low < place and left_class[node[low]] != mine:
                found.append((node[low], at - node[low], words))
            if place < len(node) and node[place] <= at + reach:
                other = node[bisect_left(node, at + reach + 1, place) - 1]
                if left_class[other] != mine:
                    found.append((at, other - at, words))
        if len(child) < 8:
            for at in child:
                insort(node, at)
            return node
        return sorted(node + child)

    stack: list[tuple[int, list[int]]] = []
    for suffix, common in zip(order, [*lcp, 0], strict=True):
        if not stack and common < depth:
            continue
        at = where[suffix]
        left_class[at] = lefts[suffix]
        current = [at]
        while stack and stack[-1][0] > common:
            words, node = stack.pop()
            current = merged(words, node, current)
        if common >= depth:
            if stack and stack[-1][0] == common:
                stack[-1] = (common, merged(common, stack[-1][1], current))
            else:
                stack.append((common, current))
    for first, distance, words in found:
        if distance + words >= max(least, exponent * distance):
            yield first, distance, words


def runs(words: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """(start, length, period) of all runs of a sequence of word numbers, by start, then period."""
    kept = _repeated_windows(words, shortest(least, exponent))
    if not kept.any():
        return np.empty((0, 3), np.int64)
    short, where = _without_gaps(words, kept)
    order, lcp = suffixes(short)
    lefts = np.concatenate(([-1], short[:-1]))
    smallest: dict[tuple[int, int], int] = {}
    for first, distance, common in maximal_pairs(
        order.tolist(), lcp.tolist(), where.tolist(), lefts.tolist(), least, exponent
    ):
        stretch = (first, distance + common)
        smallest[stretch] = min(distance, smallest.get(stretch, distance))
    rows = sorted((start, length, period) for (start, length), period in smallest.items())
    rows.sort(key=lambda r: (r[0], r[2]))
    return np.array(rows, np.int64).reshape(-1, 3)


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """Numbers of the words that stay: those that no run holds behind its first period."""
    ends = np.zeros(n + 1, np.int64)
    np.add.at(ends, found[:, 0] + found[:, 2], 1)
    np.add.at(ends, found[:, 0] + found[:, 1], -1)
    return np.flatnonzero(np.cumsum(ends[:-1]) == 0)


def _described(words: list[bytes], order: np.ndarray, found: np.ndarray) -> tuple:
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in found.tolist())
    stay = kept_words(len(words), found) if len(found) else np.arange(len(words))
    text = b" ".join([words[k] for k in order[stay].tolist()])
    if len(found):
        s, length, p = min(found.tolist(), key=lambda r: (-r[1], r[0], r[2]))
        longest = (s, length, p, 1000 * length // p)
    else:
        longest = (None,) * 4
    return (
        len(found), *longest, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest(),
        len(words), len(words) - len(stay),
    )


def _batch(texts: list[list[bytes]], ids: list[int | None], least: int, exponent: int) -> list[tuple]:
    """The result of every document of a batch, whose suffixes are sorted together."""
    orders = [rebuilt_order(i, len(words)) for i, words in zip(ids, texts, strict=True)]
    flat = pa.array([w for words in texts for w in words], pa.large_binary()).dictionary_encode()
    kinds, numbers = max(len(flat.dictionary), 1), flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum([len(words) for words in texts])))
    joined = np.empty(len(numbers), np.int64)
    for k, order in enumerate(orders):
        # Words of different documents differ, so no window and no suffix is shared by two.
        joined[offsets[k] : offsets[k + 1]] = k * kinds + numbers[offsets[k] + order]
    found = runs(joined, least, exponent)
    document = np.searchsorted(offsets, found[:, 0], side="right") - 1
    bounds = np.searchsorted(document, np.arange(len(texts) + 1))
    out = []
    for k, words in enumerate(texts):
        mine = found[bounds[k] : bounds[k + 1]] - np.array([offsets[k], 0, 0])
        out.append(_described(words, orders[k], mine))
    return out


def found_runs(
    docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per document: doc_id, n_runs, the longest run (start, length, period, exponent_milli), the digests
    of all runs and of the collapsed text, and further n_words and n_dropped.

    A null text has no words; a null id is null in the result and its text is taken as it is.  Repeated rows are
    judged each; other columns are not read.  A document without runs has nulls for the longest one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, {SCHEMA}"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("t"))
    names = ["doc_id", *[part.split()[0] for part in SCHEMA.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, start, size = batch["doc_id"].to_pylist(), [], 0, 0
            for k, value in enumerate(batch["t"]):
                # Splits at exactly the six blank ASCII characters.
                words = (value.as_py() or b"").split()
                if texts and size + len(words) > BATCH_WORDS:
                    yield emitted(batch, start, ids[start:k], texts)
                    texts, start, size = [], k, 0
                texts.append(words)
                size += len(words)
            if texts:
                yield emitted(batch, start, ids[start:], texts)

    def emitted(batch: pa.RecordBatch, start: int, ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        columns = list(zip(*_batch(texts, ids, least, exponent), strict=True))
        types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()] * 2
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays([batch["doc_id"].slice(start, len(ids)), *arrays], names)

    return rows.mapInArrow(run, schema)
