import random

import numpy as np

import pytest

from rowkin.llm import group_jaccard as J
from tests.llm.brute import jaccard_components


def _docs(seed: int) -> list:
    rng = random.Random(seed)

    def words(n):
        return ["".join(rng.choice("abcdef") for _ in range(rng.randint(1, 5))) for _ in range(n)]

    shared, docs = words(30), []
    for size in (6, 12, 40, 90):
        base = words(size)
        for _ in range(14):
            near = list(base)
            for _ in range(rng.randint(0, 4)):
                near[rng.randrange(size)] = words(1)[0]
            docs.append(near)
    docs += [words(rng.randint(20, 120)) + shared + words(rng.randint(5, 90)) for _ in range(25)]
    docs += [shared, shared[:29], shared + ["end"], ["A", "b"], ["a", "B"], ["a"], ["a"] * 50, ["a"] * 60]
    texts = [rng.choice([" ", "\n", "\t "]).join(d) for d in docs] + ["", None, " \n", "É a b c", "é a b c"]
    rng.shuffle(texts)
    return [(rng.randint(1, 10**6), t) for t in texts] + [(5, texts[0]), (5, texts[1]), (None, texts[2])]


@pytest.mark.parametrize("often", [1, 50])
def test_components_against_all_pairs(spark, monkeypatch, often):
    monkeypatch.setattr(J, "OFTEN", often)
    for seed in (1, 2):
        docs = _docs(seed)
        rows = [(i, t, "x") for i, t in docs]
        df = spark.createDataFrame(rows, "doc_id long, text string, node string").repartition(4)
        found = sorted((tuple(r) for r in J.joined(df).collect()), key=repr)
        assert found == sorted(jaccard_components(docs), key=repr)


def test_shuffled_joins_instead_of_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(J, "BROADCAST_PAIRS", 0)
    docs = _docs(3)
    found = J.joined(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(jaccard_components(docs), key=repr)


def test_empty_table_and_one_row(spark):
    df = spark.createDataFrame([(7, "one two")], "doc_id long, text string")
    assert J.joined(df.limit(0)).collect() == []
    assert [tuple(r) for r in J.joined(df).collect()] == [(7, 1, 7)]


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (300, 300)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "x long, y long")
    labels = {r["node"]: r["label"] for r in J.components(df).collect()}
    assert labels == {**{i: 0 for i in range(61)}, 100: 100, 200: 100}


def test_entries_without_a_possible_partner_leave_their_list(monkeypatch):
    """Against all pairs of every short list; longer lists keep everything."""
    monkeypatch.setattr(J, "SHORT_LIST", 6)
    rng = np.random.default_rng(2)
    n = 3000
    size = rng.integers(20, 40, n)
    e = {
        "shingle": np.sort(rng.integers(0, 900, n)).astype(np.uint64), "n": size.astype(np.int32),
        "place": rng.integers(0, 8, n).astype(np.int32),
        # Sketches that differ in few bits, the sign among them.
        **{c: rng.integers(0, 1 << 63, 1)[0] ^ (rng.integers(0, 2, (n, 6)) << np.array([0, 5, 9, 33, 62, 63])).sum(axis=1) for c in ("low", "high")},
    }
    kept = J._with_partner(e, 85)
    for key in np.unique(e["shingle"]):
        at = np.flatnonzero(e["shingle"] == key)
        for a in at:
            fits = len(at) > 6
            for b in at[at != a]:
                small, large = sorted((int(e["n"][a]), int(e["n"][b])))
                before, behind = min(int(e["place"][x]) for x in (a, b)), min(int(e["n"][x]) - 1 - int(e["place"][x]) for x in (a, b))
                differ = sum(bin((int(e[c][a]) ^ int(e[c][b])) & (1 << 64) - 1).count("1") for c in ("low", "high"))
                fits |= 100 * small >= 85 * large and 185 * (before + 1 + behind) >= 85 * (small + large) and 185 * (small + large - differ) >= 170 * (small + large)
            assert kept[a] == fits
    assert 0.1 < kept.mean() < 0.9


def test_sketches_of_any_length_bound_the_difference():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 30, 400, 513, 5000, 40_000)]
    sets += [np.union1d(s[: len(s) * 9 // 10], rng.integers(0, 1 << 63, 1 + len(s) // 20).astype(np.uint64)) for s in sets]
    made = [J.sketch(s) for s in sets]
    assert all(8 * len(m) >= max(1024, 2 * len(s)) for m, s in zip(made, sets))
    one, two = zip(*[(a, b) for a in range(len(sets)) for b in range(len(sets))])
    differ = J.differing([made[a] for a in one], [made[b] for b in two])
    for a, b, d in zip(one, two, differ):
        apart = len(np.setxor1d(sets[a], sets[b]))
        assert d <= apart and (d - apart) % 2 == 0
        if abs(a - b) == 6 and len(sets[a]) > 300:  # a text and its near copy
            assert d > 0.8 * apart
    assert len(J.differing([], [])) == 0


def test_links_are_the_same_whether_pairs_come_first_or_later(spark):
    """Every pair of a table, so that a document's likeliest partner is one among many."""
    docs = [(k, t or "") for k, (_, t) in enumerate(_docs(5))]
    texts = {k: t for k, t in docs if len(J.shingles(t))}
    rows = [(k, len(J.shingles(t)), J.sketch(J.shingles(t)), len(t.encode()).to_bytes(8, "little") + J.pa.compress(t.encode(), codec="zstd", asbytes=True)) for k, t in texts.items()]
    sets = spark.createDataFrame(rows, "node long, n long, sketch binary, text binary")
    every = [(a, b) for a in texts for b in texts if b < a]
    none = spark.createDataFrame([], "node long, label long")
    labels = {r["node"]: r["label"] for r in J.linked(spark.createDataFrame(every, "x long, y long"), len(every), sets, none).collect()}
    group = {k: k for k in texts}

    def top(k):
        return k if group[k] == k else top(group[k])

    for a, b in every:
        if J.similar(J.shingles(texts[a]), J.shingles(texts[b])):
            one, two = sorted((top(a), top(b)))
            group[two] = one
    assert {k: labels.get(k, k) for k in texts} == {k: top(k) for k in texts}


def test_lists_of_the_same_nodes_have_one_name():
    keys = np.array([1, 1, 3, 3, 5, 5, 5, 8, 8, 9], np.uint64)
    nodes = np.array([7, 2, 2, 7, 2, 7, 9, 7, 2, 2])
    late = keys == 8
    names = list(zip(*(x.tolist() for x in J._lists(keys, nodes, late))))
    assert len(set(names[:4])) == 1 and len({names[0], names[4], names[7], names[9]}) == 4
    assert len(set(names[4:7])) == 1 and names[7] == names[8] == (8, -1)
    assert [len(x) for x in J._lists(keys[:0], nodes[:0], late[:0])] == [0, 0]


def test_entries_take_few_bytes_however_many_buckets():
    rng = np.random.default_rng(6)
    texts = [" ".join(map(str, rng.integers(0, 10**6, 300))).encode() for _ in range(600)]
    packed = [len(t).to_bytes(8, "little") + J.pa.compress(t, codec="zstd", asbytes=True) for t in texts]
    nodes = [(3 << 33) + k for k in range(600)]
    batch = J.pa.RecordBatch.from_arrays([J.pa.array(packed, J.pa.binary()), J.pa.array(nodes, J.pa.int64())], names=["text", "node"])
    often = np.sort(J.shingles(texts[0])[:3])
    for buckets in (4, 60):
        blocks = list(J._entry_blocks(buckets, 4, 85, often)([batch]))
        size = sum(len(d) for b in blocks for d in b["data"].to_pylist())
        assert size < 16 * sum(n for b in blocks for n in b["entries"].to_pylist())
        found = [J._unpacked(d.as_buffer(), n.as_py()) for b in blocks for d, n in zip(b["data"], b["entries"])]
        got = sorted(zip(*(np.concatenate([f[c] for f in found]).tolist() for c in ("node", "place", "n", "shingle"))))
        made = [J.shingles(t) for t in texts]
        assert got == [(i, k, len(m), int(x)) for i, m in zip(nodes, made) for k, x in enumerate(J._prefix(m, 85, often))]


def test_a_pair_comes_from_its_first_list_after_the_first_round(spark):
    lists = [(k, -1) for k in range(30)]
    df = spark.createDataFrame(lists, "shingle long, first long").withColumn("name", J.F.xxhash64("shingle", "first"))
    names = sorted(r["name"] for r in df.collect())
    # One document is in all lists, the other in all but the two first; names beyond the first eight are not known.
    both = df.withColumns({"lists": J.F.lit(names[: J.FIRST_LISTS]), "p_lists": J.F.lit(names[2 : 2 + J.FIRST_LISTS])}).where(J.F.col("name") >= names[2])
    assert [r["name"] for r in both.where(J._first_list()).collect()] == [names[2]]
    apart = df.withColumns({"lists": J.F.lit(names[:8]), "p_lists": J.F.lit(names[8:16])})
    assert apart.where(J._first_list()).count() == 30


def test_copies_in_other_tasks_have_no_entries(spark, monkeypatch):
    stored, nodes = J.store, {}

    def store(df, label, **figures):
        out = stored(df, label, **figures)
        if label == "jaccard-entries":
            nodes["with entries"] = out.table.select("node").distinct().count()
        return out

    monkeypatch.setattr(J, "store", store)
    text = " ".join(f"w{k}" for k in range(80))
    docs = [(k, text + (" end" if k in (11, 23) else "")) for k in range(40)]
    found = J.joined(spark.createDataFrame(docs, "doc_id long, text string").repartition(8))
    assert {tuple(r)[::2] for r in found.collect()} == {(k, 0) for k in range(40)}
    assert nodes["with entries"] == 2
