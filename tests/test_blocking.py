import random

import pytest
from pyspark.sql import functions as F

from rowkin.functions.similarity import least_edits, letter_marks
from rowkin.operators import blocking, names
from rowkin.settings import MatchSettings
from tests.model import distance, similar

SCHEMA = "id bigint, name string, department string"


def edited(rng, text, edits, letters):
    text = list(text)
    for _ in range(edits):
        at = rng.randrange(len(text) + 1)
        text[at : at + rng.choice((0, 1, 1))] = rng.choice(("", rng.choice(letters)))
    return "".join(text)


@pytest.mark.parametrize("letters, most", [("abc", 12), ("abcdefghij", 24)])
def test_two_pieces_miss_no_pair(spark, letters, most):
    """Every context asks for two pieces; the pairs are those of comparing all names."""
    rng = random.Random(len(letters))
    bases = ["".join(rng.choice(letters) for _ in range(rng.randint(3, most))) for _ in range(14)]
    rows = [(i, edited(rng, rng.choice(bases), rng.choice((0, 1, 2, 3, 5, 7)), letters), rng.choice(("x", "y"))) for i in range(260)]
    rows = [r for r in rows if len(r[1]) >= 3]
    settings = MatchSettings(small_context=1, large_context=1)
    df = spark.createDataFrame(rows, SCHEMA)
    found = {(r["i"], r["j"]): r["similarity"] for r in names.possible_pairs(df, settings).collect()}
    firsts = {}
    for i, name, dept in rows:
        firsts.setdefault((name, dept), (i, {"name": name, "department": dept}))
    kept = sorted(firsts.values(), key=lambda r: r[0])
    expected = {(i, j): s for n, (i, a) in enumerate(kept) for j, b in kept[:n] if (s := similar(a, b)) is not None}
    assert found == expected and len(expected) > 100


def test_marks_never_exceed_the_distance(spark):
    rng = random.Random(3)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("abcdéß漢 z") for _ in range(rng.randint(1, 12)))
        pairs.append((a, edited(rng, a, rng.randint(0, 6), "abcé漢 q") or "x"))
    df = spark.createDataFrame(pairs, "a string, b string")
    bound = least_edits(letter_marks(F.col("a")), letter_marks(F.col("b")))
    found = df.select("a", "b", bound.alias("n")).collect()
    assert all(r["n"] <= distance(r["a"], r["b"]) for r in found) and sum(r["n"] for r in found) > 400


def candidates(spark, count, settings):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)), "d") for i in range(count)]
    scoped = blocking.store_names(blocking.scoped_names(names.name_profiles(spark.createDataFrame(rows, SCHEMA)), settings))
    sides = names._candidates(scoped.table, scoped.table, scoped.figures, settings)
    other = sides.long.select("scope", "block", F.col("id").alias("other"))
    return sides.short.join(other, ["scope", "block"]).where("id <> other").count()


def test_candidates_of_unrelated_names_grow_clearly_below_the_square(spark):
    settings = MatchSettings(large_context=1500)
    few, many = candidates(spark, 1000, settings), candidates(spark, 4000, settings)
    assert few > 300 and many < 8 * few
    assert many < 0.2 * candidates(spark, 4000, MatchSettings())


def test_longer_names_ask_for_two_pieces_later():
    needed = [blocking._least_members(n, MatchSettings()) for n in range(3, 30)]
    assert needed == sorted(needed) and needed[9 - 3] == 50_000 and needed[24 - 3] == float("inf")


@pytest.mark.parametrize("letters", ["abc", "abcdefghij"])
def test_halves_miss_no_pair(spark, letters):
    """Every context asks for halves of short names; the pairs are those of comparing all names."""
    rng = random.Random(len(letters) + 1)
    bases = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 15))) for _ in range(14)]
    rows = [(i, edited(rng, rng.choice(bases), rng.choice((0, 1, 2, 3, 5)), letters), rng.choice(("x", "y"))) for i in range(260)]
    rows = [r for r in rows if len(r[1]) >= 3]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = {(r["i"], r["j"]): r["similarity"] for r in names.possible_pairs(df, MatchSettings(small_context=1000)).collect()}
    for settings in (MatchSettings(small_context=1, halved_context=1), MatchSettings(small_context=1, halved_context=130, large_context=1)):
        found = {(r["i"], r["j"]): r["similarity"] for r in names.possible_pairs(df, settings).collect()}
        assert found == whole and len(found) > 100


def test_halves_of_unrelated_names_offer_few_candidates(spark):
    one, halved = candidates(spark, 4000, MatchSettings()), candidates(spark, 4000, MatchSettings(halved_context=1000))
    assert 0 < halved < 0.05 * one and halved < 4000
