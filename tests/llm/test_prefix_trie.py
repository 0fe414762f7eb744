import hashlib
import random
import zlib

import pytest

from rowkin.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The trie of rebuilt lists of turns, node by node."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    lists = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - (abs(conv) % 100) * (1 if conv >= 0 else -1)
        lists[conv] = own.get(base, [])[:h] + turns[h:]
    nodes = {}
    for conv, turns in lists.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(conv)
    out = []
    for path, convs in nodes.items():
        under = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in under if len(p) == len(path) + 1]
        leaves = [p for p in under if not any(q[: len(p)] == p and len(q) > len(p) for q in under)]
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(lists[c]) == len(path)))
        out.append((
            min(convs), len(path), min(nodes[path[:-1]]) if path else None, len(convs), len(children), len(leaves),
            sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in under if p), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(df, **settings):
    return sorted((tuple(r)[:8] for r in T.trie(df, **settings).collect()), key=str)


def drawn(seed, n, kinds=3, most=9):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        conv = rng.choice([rng.randrange(0, 30), rng.randrange(100, 130), 100 * rng.randrange(8), rng.randrange(-120, 0), 10**9 + rng.randrange(300)])
        for turn in range(rng.randrange(1, most)):
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(["user", None, ""]), "é" * rng.randrange(kinds)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_lists_of_turns(spark, monkeypatch, seed):
    monkeypatch.setattr(T, "BLOCK", 3)
    rows = drawn(seed, 90) + [(None, 1, "user", "x"), (777, 0, "user", "only"), (700, 5, None, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", depth string, length int").repartition(3)
    assert found(df) == brute(rows)


def test_copies_of_one_conversation_and_a_long_one(spark):
    """A third of all conversations are one, and a third of all turns are one conversation's, over several tasks."""
    same = [(c, t, "user", f"turn {t}") for c in range(300, 360) for t in range(5)]
    long = [(5, t, "user", f"word {t % 7}") for t in range(160)]
    other = [(c, t, "user", f"turn {t if t < 3 else c}") for c in range(400, 420) for t in range(5)]
    rows = same + long + other
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df) == brute(rows)


def test_a_conversation_over_several_parts(spark):
    """What a conversation brings from the parts before is combined with the products inside a part."""
    made = T.Products(0)
    rows = [(3, t, "user", str(t % 5)) for t in range(300)] + [(9, t, "user", "b") for t in range(4)]
    raw = T.running(T.ordered_turns(spark.createDataFrame(rows, SCHEMA), 0).repartition(4), made).table
    assert raw.where("d1 is null").count() > 1 or spark.conf.get("spark.sql.adaptive.enabled") == "true"
    got = sorted(map(tuple, T.carried(raw, made).collect()))
    assert [r[:2] for r in got] == [(3, t + 1) for t in range(300)] + [(9, t + 1) for t in range(4)]
    turns = T._whole([r[4] for r in got], [r[5] for r in got])
    before = T._whole([r[2] for r in got], [r[3] for r in got])
    assert before == [made.of(turns[:k]) for k in range(300)] + [made.of(turns[300 : 300 + k]) for k in range(4)]


def test_carries_over_many_parts(spark, monkeypatch):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(3, t, "user", str(t % 5)) for t in range(300)] + [(103, t, "user", str(t % 3)) for t in range(40)] + [(0, 0, "user", "q")]
        df = spark.createDataFrame(rows, SCHEMA).repartition(4)
        raw = T.running(T.ordered_turns(df, 0), T.Products(0)).table
        assert raw.where("d1 is null and conv_id = 3").count() > 1
        assert found(df) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_colliding_products_are_noticed(spark):
    """Products modulo a small prime collide; the members of such nodes differ, and the next hash is taken."""
    tried = []

    def products(seed):
        tried.append(seed)
        return T.Products(seed, 13 if seed == 0 else T.PRIME)

    rows = drawn(5, 60, kinds=9)
    assert found(spark.createDataFrame(rows, SCHEMA), products=products) == brute(rows)
    assert tried == [0, 1]
    with pytest.raises(ValueError, match="collide"):
        T.trie(spark.createDataFrame(rows, SCHEMA), products=lambda seed: T.Products(seed, 13))


def test_products_are_a_monoid():
    p, rng = T.Products(3), random.Random(1)
    for _ in range(50):
        turns = [rng.getrandbits(128) for _ in range(rng.randrange(1, 40))]
        cut = rng.randrange(len(turns) + 1)
        assert p.joined(p.of(turns[:cut]), p.of(turns[cut:]), len(turns) - cut) == p.of(turns)


def test_small_and_empty_tables(spark):
    rows = [(101, 0, "user", "a"), (101, 0, "user", "a")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_references_lead_to_the_turns(spark):
    rows = [(c, t, "user", f"{c}/{t}") for c in (0, 1, 2, 100, 101) for t in range(7)]
    for r in T.trie(spark.createDataFrame(rows, SCHEMA)).collect():
        assert (r["turn_place"] is None) == (r["depth"] == 0)
        if r["depth"]:
            assert r["turn_conv_id"] in (r["conv_id"], r["conv_id"] // 100 * 100) and r["turn_place"] == r["depth"]
