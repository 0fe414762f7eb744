"""Packing documents into windows of equal capacity by Karmarkar-Karp multiway differencing.

Every task tokenises its rows in order and packs them block by block, a block being about
``BLOCK_WINDOWS`` windows' worth of tokens, so memory is bounded and nothing is shuffled.

A document longer than a window gives full windows of its own and a rest.  The rests of a block are the
items; some of them are cut into grains first, as small items are what makes near-equal sums possible.
Differencing starts with one partial partition per item (the item in one subset, the other k - 1 empty)
and always merges the two with the largest imbalance, the heaviest subset of the one going to the
lightest of the other.  The last partition left is the packing.  If a subset exceeds the capacity, the
window count rises and the block is packed anew.
"""

from __future__ import annotations

import heapq
import json
import zlib
from bisect import insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
BLOCK_WINDOWS = 256
#: One rest in GRAIN_EVERY is cut into grains of GRAIN tokens.
GRAIN_EVERY = 6
GRAIN = 32
END = 0  # the id behind every document
_COUNTER_BITS = 33


#: The split of a text into pieces by a byte-level BPE of this family (fixed by the tokenizer file's pre-tokenizer).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same where white space never stands next to white space: without look-ahead a much faster matcher serves.
PLAIN_PIECES = PIECES.replace(r"\s+(?!\S)|", "")
#: What a text must not hold for that: two of the usual blanks together, or any unusual one.
UNUSUAL = ("  ", " \n", "\n ", "\n\n", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"))


def _byte_letters() -> dict[str, int]:
    """The letters that a byte-level vocabulary writes bytes with: printable Latin-1 as itself, the rest from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts by the tokenizer file at ``path``.

    A plain byte-level BPE file is run by the faster of the two libraries that read such vocabularies; any
    other file, and texts that hold a special token's string, by the library the file is made for.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fast = self._fast(path, PIECES)
        self.plain = self._fast(path, PLAIN_PIECES)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    @staticmethod
    def _fast(path: str, pieces: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        model, split = made["model"], made.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or made.get("normalizer"):
            return None
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        ids = [model["vocab"][m.replace(" ", "")] for m in merges]
        if ids != sorted(ids):  # merge order is not id order
            return None
        special = {t["content"] for t in made["added_tokens"]}
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        return tiktoken.Encoding("file", pat_str=pieces, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids, without any id for the end."""
        if not text:
            return b""
        if self.fast is None or any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        elif any(s in text for s in UNUSUAL):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.plain.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _merged(a: list, b: list, k: int, after: list[int]) -> list:
    """Two partial partitions in one: the heaviest subsets of the one meet the lightest of the other.

    A partition is the list of its non-empty subsets, ascending: (sum, first item, last item); the items
    of a subset are linked by ``after``.  Empty subsets are the lightest, so two subsets only meet where
    both partitions together have more than k of them.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(b) == 1:  # by far the most frequent case: a single item
        total, head, tail = b[0]
        if len(a) == k:
            low, first, last = a.pop(0)
            after[last] = head
            total, head = total + low, first
        insort(a, (total, head, tail))
        return a
    meet = max(0, len(a) + len(b) - k)
    out = a[meet:] + b[meet:]
    for (low, first, last), (total, head, tail) in zip(a[:meet], reversed(b[:meet]), strict=True):
        after[last] = head
        out.append((low + total, first, tail))
    out.sort()
    return out


def difference(sizes: list[int], k: int) -> tuple[list[int], list[int]]:
    """Karmarkar-Karp for k subsets: the subset of each item, and the sums of the non-empty subsets."""
    after = [-1] * len(sizes)
    heap = [(-size, i) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    partial: dict[int, list] = {}
    made = len(sizes)

    def opened(key: int) -> list:
        return partial.pop(key, None) or [(sizes[key], key, key)]

    while len(heap) > 1:
        _, x = heapq.heappop(heap)
        _, y = heapq.heappop(heap)
        new = partial[made] = _merged(opened(x), opened(y), k, after)
        lightest = new[0][0] if len(new) == k else 0
        heapq.heappush(heap, (lightest - new[-1][0], made))
        made += 1
    subset = [0] * len(sizes)
    last = opened(heap[0][1]) if heap else []
    for s, (_, i, _) in enumerate(last):
        while i >= 0:
            subset[i] = s
            i = after[i]
    return subset, [x[0] for x in last]


def packed(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, window, offset) of a block of documents with these lengths.

    Every token lies in exactly one piece; no window exceeds ``capacity``; offsets are gapless from 0.
    """
    out, items, windows = [], [], 0
    for doc, length in enumerate(lengths):
        full = length // capacity
        for w in range(full):
            out.append((doc, w * capacity, capacity, windows, 0))
            windows += 1
        rest, at = length - full * capacity, full * capacity
        if rest and doc % GRAIN_EVERY == 0:
            for start in range(at, length, GRAIN):
                items.append((doc, start, min(GRAIN, length - start)))
        elif rest:
            items.append((doc, at, rest))
    if not items:
        return out
    sizes = [i[2] for i in items]
    k = -(-sum(sizes) // capacity)
    while True:
        subset, sums = difference(sizes, k)
        if sums[-1] <= capacity:
            break
        k += 1
    at = [0] * k
    # Grains of one document that meet again in a window lie next to each other and become one piece.
    last: dict[int, list] = {}
    for (doc, start, length), s in zip(items, subset, strict=True):
        piece = last.get(s)
        if piece and piece[0] == doc and piece[1] + piece[2] == start:
            piece[2] += length
        else:
            last[s] = piece = [doc, start, length, windows + s, at[s]]
            out.append(piece)
        at[s] += length
    return [tuple(p) for p in out]



def _pack(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << _COUNTER_BITS
        keys, ids, tokens, key_type = [], [], 0, None

        def flush():
            nonlocal number, keys, ids, tokens
            lengths = [len(x) // 4 for x in ids]
            pieces = packed(lengths, capacity)
            cut = [ids[doc][4 * start : 4 * (start + length)] for doc, start, length, _, _ in pieces]
            columns = [
                pa.array([keys[p[0]] for p in pieces], key_type),
                pa.array([p[1] for p in pieces], pa.int64()),
                pa.array([p[2] for p in pieces], pa.int64()),
                pa.array([zlib.crc32(c) for c in cut], pa.int64()),
                pa.array([lengths[p[0]] for p in pieces], pa.int64()),
                pa.array([number + p[3] for p in pieces], pa.int64()),
                pa.array([p[4] for p in pieces], pa.int64()),
            ]
            names = ["_key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array(cut, pa.binary()))
                names.append("ids")
            number += 1 + max((p[3] for p in pieces), default=0)
            keys, ids, tokens = [], [], 0
            return pa.RecordBatch.from_arrays(columns, names=names)

        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            key_type = batch.schema.field(0).type
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                made = encoder.ids(text.as_py()) + end
                keys.append(key.as_py())
                ids.append(made)
                tokens += len(made) // 4
                if tokens >= BLOCK_WINDOWS * capacity:
                    yield flush()
        if keys:
            yield flush()

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """A row per piece: the id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset`` and, on demand, the piece's ``ids`` (little-endian 32-bit).

    A null or empty text is its end id alone.  Every row is a document of its own, also where ids repeat
    or are null.  Sequence ids are unique over the table; they follow the order of the rows, so the same
    table read in the same splits gives the same sequences.  Other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_key"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    schema = rows.select("_key").schema
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"):
        schema = schema.add(name, "long")
    if with_ids:
        schema = schema.add("ids", "binary")
    out = rows.mapInArrow(_pack(tokenizer, capacity, with_ids), schema)
    return out.withColumnRenamed("_key", id_col)
