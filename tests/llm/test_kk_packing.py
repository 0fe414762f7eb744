import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rowkin.llm import kk_packing as K

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizer(plain):
    rng = random.Random(2)
    cases = ["", "a", " a", "a ", "a  b", "a\n\nb \n", "don't I'll x's", "<|endoftext|>", "a<|endoftext|> b", "\ttab", "éü\u00a0x\u2028y", "日本語 text 😀", "\0\x1c\x85"]
    cases += ["".join(rng.choice("ab'st 1\n.é\t\u3000") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    encoder = K._encoder(PATH)
    for text in cases:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == plain(text), repr(text)


def _sound(lengths, capacity):
    pieces = K.packed(lengths, capacity)
    spans, windows = defaultdict(list), defaultdict(list)
    for doc, start, length, window, offset in pieces:
        assert length > 0
        spans[doc].append((start, length))
        windows[window].append((offset, length))
    for doc, length in enumerate(lengths):
        at = 0
        for start, n in sorted(spans[doc]):
            assert start == at
            at += n
        assert at == length
    fill = []
    for parts in windows.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
        fill.append(at)
    return fill


def test_every_token_once_and_no_window_too_full():
    rng = random.Random(7)
    for lengths in ([1], [1024], [1025], [5000], [1] * 3000, [700] * 50, [513] * 40, [rng.randint(1, 3000) for _ in range(400)]):
        _sound(lengths, 1024)
    fill = _sound([rng.randint(1, 2000) for _ in range(400)], 1024)
    assert sum(fill) / (1024 * len(fill)) > 0.985


def test_differencing_balances():
    rng = random.Random(1)
    sizes = [rng.randint(1, 100) for _ in range(300)]
    subset, sums = K.difference(sizes, 7)
    by = defaultdict(int)
    for size, s in zip(sizes, subset, strict=True):
        by[s] += size
    assert sorted(by.values()) == sorted(sums) and max(sums) - min(sums) <= 2
    assert K.difference([], 3) == ([], [])


def test_pieces_round_trip(spark, plain):
    texts = ["one two", "", None, "word " * 3000, "one two", "x"] + [f"text {i} " * (i % 90) for i in range(200)]
    docs = spark.createDataFrame([(i // 2, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, offset int").repartition(3)
    rows = K.pack(docs, PATH, with_ids=True).collect()
    got, expected = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        got[r["doc_id"]].append((r["start"], ids))
    for i, t in enumerate(texts):
        expected[i // 2].append([*plain(t or ""), 0])
    for key, parts in expected.items():
        # Two documents share an id here: compare the ids as multisets of tokens, and the totals.
        assert sorted(x for p in parts for x in p) == sorted(x for _, ids in got[key] for x in ids)
    used = defaultdict(list)
    for r in rows:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in used.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    assert K.pack(docs.limit(0), PATH).collect() == []
