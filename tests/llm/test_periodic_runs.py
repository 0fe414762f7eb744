import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowkin.llm import periodic_runs as P

DRAWN = random.Random(11)


def brute_runs(words, least=P.LEAST, exponent=P.EXPONENT):
    """Every stretch that keeps period q and cannot be extended, by scanning for each q."""
    smallest = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                smallest.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in smallest.items()), key=lambda r: (r[0], r[2]))


def brute_document(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and words and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    head = (*longest, 1000 * longest[1] // longest[2]) if longest else (None,) * 4
    digests = ("".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(w for i, w in enumerate(words) if i not in dropped))
    return (doc_id, len(runs), *head, *[hashlib.sha256(d.encode()).hexdigest() for d in digests])


def drawn(n, kinds):
    """Words with repeated stretches of short periods, some of them powers of shorter ones."""
    words = []
    while len(words) < n:
        period = [DRAWN.randrange(kinds) for _ in range(DRAWN.randrange(1, 7))] * DRAWN.choice([1, 1, 2, 3])
        words += (period * DRAWN.randrange(1, 9))[: DRAWN.randrange(1, 40)]
    return words[:n]


@pytest.mark.parametrize("kinds", [1, 2, 3, 5])
def test_runs_against_a_scan_for_every_period(kinds):
    for _ in range(400):
        n = DRAWN.randrange(90)
        words = drawn(n, kinds) if DRAWN.random() < 0.6 else [DRAWN.randrange(kinds) for _ in range(n)]
        assert [tuple(r) for r in P.runs(np.array(words, np.int64)).tolist()] == brute_runs(words)


@pytest.mark.parametrize("least, exponent", [(4, 3), (10, 5), (20, 4)])
def test_other_length_constraints(least, exponent):
    for _ in range(200):
        words = drawn(DRAWN.randrange(90), 2)
        assert [tuple(r) for r in P.runs(np.array(words, np.int64), least, exponent).tolist()] == brute_runs(words, least, exponent)


def test_long_runs_take_time_in_proportion():
    """Documents in which all pairs of equal words, or of equal windows, would not end."""
    assert P.runs(np.zeros(150_000, np.int64)).tolist() == [[0, 150_000, 1]]
    assert P.runs(np.arange(120_000) % 400).tolist() == [[0, 120_000, 400]]
    nested = P.runs(np.array(([0] * 50 + [1]) * 2000))
    assert len(nested) == 2001 and nested[1].tolist() == [0, 102_000, 51]


def test_documents_against_brute_force(spark):
    texts = [" ".join(f"w{k}" for k in drawn(DRAWN.randrange(200), 4)) for _ in range(150)]
    texts += [None, "", " \t\n", "é " * 9, "a b " * 6, "x " * 5, "x " * 6, "\x0b".join("abcabcabcabc"), "ein wort " * 600]
    rows = list(enumerate(texts)) + [(7, texts[7]), (7, "p q " * 12), (None, "p q " * 12), (None, None)]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, start string, n_runs int").repartition(3)
    got = P.found_runs(df).drop("n_words", "n_dropped").collect()
    key = str
    assert sorted(map(tuple, got), key=key) == sorted((brute_document(*r) for r in rows), key=key)
    assert any(r["n_runs"] > 1 for r in got) and sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5


def test_small_batches_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(P, "BATCH_WORDS", 50)
    texts = [b"a b " * 20, b"a b " * 20, b"", b"c " * 70]
    assert [r[0] for r in P._batch([t.split() for t in texts], [None] * 4, 6, 4)] == [1, 1, 0, 1]
    df = spark.createDataFrame([(i, "a b " * 20) for i in (1, 2, 3)], "doc_id int, text string").coalesce(1)
    got = P.found_runs(df)
    assert [(r["doc_id"], r["n_runs"], r["period"], r["n_dropped"]) for r in got.collect()] == [(i, 1, 2, 38) for i in (1, 2, 3)]
    assert got.schema["doc_id"].dataType.simpleString() == "int"
    assert P.found_runs(df.where(F.lit(False))).collect() == []
