import random

import numpy as np

from rowkin.llm import suffix_dedup as S
from tests.llm.brute import suffix_removal


def _texts(seed: int) -> list:
    rng = random.Random(seed)

    def prose(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(n))

    passage, near = prose(80), prose(200).split(" ")
    texts = [prose(rng.randint(1, 150)) for _ in range(12)]
    texts += [prose(30) + passage + prose(30), passage + prose(9), prose(5) + passage[50:420], passage[10:260]]
    for _ in range(6):  # near copies: a few words changed
        words = list(near)
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = prose(1)
        texts.append(" ".join(words))
    texts += [texts[0]] * 3 + ["Le " * 400, "ab" * 150, "ab" * 99, "x" * 199, "x" * 200, "x" * 201, "", None]
    texts += [prose(40) + "\0" * 230 + prose(3), "\0" * 205, prose(20) + prose(0) + texts[1] + texts[1][:230]]
    return texts


def test_against_every_string(spark):
    for seed in range(3):
        texts = _texts(seed)
        rows = [(i, t, "extra") for i, t in enumerate(texts)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string").repartition(5)
        found = {r["doc_id"]: tuple(r)[1:] for r in S.deduplicated(docs).collect()}
        expected = suffix_removal(texts)
        assert [found[i] for i in range(len(texts))] == expected


def test_repeated_ids_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a" * 300), (1, "a" * 300), (None, "b"), (2, None)], "doc_id long, text string")
    found = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"]) for r in S.deduplicated(docs).collect())
    assert found == [(0, 1, 0, 0), (1, 300, 300, 1), (1, 300, 300, 1), (2, 0, 0, 0)]
    assert S.deduplicated(docs.limit(0)).collect() == []


def test_kept_bytes(spark):
    shared = "".join(chr(97 + i * i % 23) + chr(97 + i % 19) for i in range(150))
    docs = spark.createDataFrame([(1, "head " + shared), (2, shared + " tail")], "doc_id long, text string")
    kept = {r["doc_id"]: bytes(r["kept"]) for r in S.deduplicated(docs, with_kept=True).collect()}
    assert kept == {1: b"head ", 2: b" tail"}


def test_strings_across_chunks():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 123, S.CHUNK + 5000).astype(np.uint8)
    found = S.anchors(data, np.array([len(data)]))
    # Every string has exactly one anchor, and it lies inside the string.
    assert (found["high"].astype(int) - found["low"] + 1).sum() == len(data) - S.LENGTH + 1
    assert found["high"].max() < S.PLACES


def test_loser_tree_sorts_and_knows_prefixes():
    rng = random.Random(3)
    for runs in (0, 1, 2, 5, 9):
        made = []
        for _ in range(runs):
            strings = sorted(bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(rng.randint(0, 40)))
            prefixes = [0] + [_common(a, b) for a, b in zip(strings, strings[1:], strict=False)]
            made.append((strings, prefixes[: len(strings)]))
        run, at, prefix = S.merged(made)
        out = [made[r][0][k] for r, k in zip(run, at, strict=True)]
        assert out == sorted(s for strings, _ in made for s in strings)
        assert prefix[1:] == [_common(a, b) for a, b in zip(out, out[1:], strict=False)]


def _common(a: bytes, b: bytes) -> int:
    n = 0
    while n < len(a) and a[n] == b[n]:
        n += 1
    return n
