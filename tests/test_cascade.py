import random

import pytest

from rowkin.operators.groups import group_attributes, group_members, groups, summary
from rowkin.operators.details import details
from rowkin.operators.names import possible_pairs
from rowkin.plans.detect import detect
from rowkin.plans.records import clean_columns, records_from_maps
from rowkin.settings import MatchSettings
from tests.model import cascade, distance, similar

FIELDS = ("name", "email", "phone", "department", "address", "id_code")

# Settings that push every row through the paths meant for very large or skewed data.
HARSH = MatchSettings(hot_rows=2, hot_keys=3, broadcast_rows=0, small_context=2, pair_budget=300, pairs_per_name=2)


def random_people(seed, count, longest=14):
    rng = random.Random(seed)
    bases = ["".join(rng.choice("abcd") for _ in range(rng.randint(2, longest))) for _ in range(12)]

    def name():
        text = list(rng.choice(bases))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3))):
            at = rng.randrange(len(text) + 1)
            text[at : at + rng.choice((0, 1))] = rng.choice(("", "a", "x"))
        return "".join(text)

    def maybe(share, value):
        return value if rng.random() < share else ""

    return [
        (
            i,
            {
                "name": maybe(0.95, name()),
                "email": maybe(0.3, f"u{rng.randint(1, 40)}@x"),
                "phone": maybe(0.3, str(rng.randint(5000000, 5000030))),
                "department": maybe(0.7, rng.choice(("d1", "d2", "d3"))),
                "address": maybe(0.3, rng.choice(("a1", "a2"))),
                "id_code": maybe(0.2, str(rng.randint(1, 40))),
            },
        )
        for i in sorted(rng.sample(range(1, 10 * count), count))
    ]


def table(spark, rows):
    schema = "id bigint, " + ", ".join(f"{f} string" for f in FIELDS)
    shuffled = random.Random(1).sample(rows, len(rows))
    return spark.createDataFrame([(i, *[f[k] or None for k in FIELDS]) for i, f in shuffled], schema)


def outcome_of(df):
    names = {"primary_key": "exact"}
    return {
        r["record_id"]: (r["duplicate_of_id"], names.get(r["matched_on"], r["matched_on"]), r["confidence"])
        if r["is_duplicate"]
        else None
        for r in df.collect()
    }


@pytest.mark.parametrize(
    "seed, count, longest, settings",
    [(1, 150, 14, MatchSettings()), (2, 60, 30, HARSH)],
)
def test_cascade_equals_the_sequential_model(spark, seed, count, longest, settings):
    rows = random_people(seed, count, longest)
    found = detect(clean_columns(table(spark, rows), "id"), settings)
    assert outcome_of(found) == cascade(rows)


@pytest.mark.parametrize("settings", [MatchSettings(), HARSH])
def test_no_pair_is_missed(spark, settings):
    rng = random.Random(9)
    letters = "abc"
    base = "".join(rng.choice(letters) for _ in range(70))
    rows = []
    for i in range(220):
        size = rng.choice((3, 5, 6, 7, 9, 13, 20, 27, 28, 39, 40, 41, 42, 55))
        text = list(base[:size])
        for _ in range(rng.randint(0, max(1, size // 3))):
            text[rng.randrange(len(text))] = rng.choice(letters)
        extra = rng.choice((0, 0, 1, 2, 5))
        rows.append((i, {"name": "".join(text)[extra:] or "abc", "department": rng.choice(("x", "y", ""))}))
    df = spark.createDataFrame([(i, f["name"], f["department"]) for i, f in rows], "id bigint, name string, department string")
    found = {(r["i"], r["j"]): r["similarity"] for r in possible_pairs(df, settings).collect()}
    firsts = {}
    for i, f in rows:
        firsts.setdefault((f["name"], f["department"]), (i, f))
    kept = sorted(firsts.values(), key=lambda x: x[0])
    expected = {
        (i, j): s
        for n, (i, a) in enumerate(kept)
        for j, b in kept[:n]
        if (s := similar(a, b)) is not None
    }
    assert len(expected) > 200
    assert found == expected


def test_round_limit_is_an_error(spark):
    names = ["aaaaaaaaaa", "aaaaaaaaab", "aaaaaaaabb", "aaaaaaabbb", "aaaaaabbbb"]
    df = spark.createDataFrame(list(enumerate(names)), "id bigint, name string")
    with pytest.raises(RuntimeError):
        detect(clean_columns(df, "id"), MatchSettings(max_rounds=1))


SMALL = [
    (1, {"name": "Arun Kumar", "email": "arun@gmail.com", "phone": "9876543210"}),
    (2, {"name": "Priya Sharma", "email": "priya@gmail.com", "phone": "9841023456"}),
    (3, {"phone": "9876543210", "email": "arun@gmail.com", "name": "ARUN KUMAR"}),
    (4, {"full_name": "Arun", "mail_id": "arun@gmail.com", "age": "20"}),
    (5, {"__source_file__": "x.csv", "customer name": "Priya Sharme"}),
    (6, {"x": "N/A"}),
]


def test_small_mixed_headers(spark):
    records = records_from_maps(spark.createDataFrame(SMALL, "record_id bigint, raw map<string,string>"))
    found = detect(records)
    assert outcome_of(found) == {
        1: None, 2: None, 3: (1, "exact", 100.0), 4: (1, "email", 95.0), 5: (2, "name", 91.7), 6: None,
    }
    texts = {r["record_id"]: r for r in details(records, found).collect()}
    assert sorted(texts[3]["matched_fields"]) == ["email", "name", "phone"]
    assert texts[4]["matched_fields"] == ["email"]
    assert texts[5]["matched_fields"] == ["name"]
    assert texts[3]["explanation"] == (
        "Exact match on normalized composite key: 'email:arun@gmail.com|name:arun kumar|phone:9876543210'."
    )
    assert texts[4]["explanation"] == (
        "Partial match: Identical email ('arun@gmail.com') with varying schema attributes."
    )
    assert texts[5]["explanation"] == "Possible match: Name 'priya sharme' is 91.7% similar to 'priya sharma'."
    listed = groups(found, records).sort("group_id").collect()
    assert [(g["group_id"], g["primary_id"], g["total_records"], g["duplicate_type"]) for g in listed] == [
        (1, 1, 3, "Exact Duplicate"), (2, 2, 2, "Possible Duplicate"),
    ]
    members = sorted(tuple(r) for r in group_members(found).collect())
    assert members == [(1, 1, 0, 1), (1, 1, 1, 3), (1, 1, 2, 4), (2, 2, 0, 2), (2, 2, 1, 5)]
    total = summary(found).first()
    assert (total["total_records"], total["unique_records"], total["duplicate_percentage"]) == (6, 3, 50.0)
    assert total["duplicate_groups_count"] == 2
    assert summary(found.limit(0)).first()["duplicate_percentage"] == 0.0


def test_group_members_over_sparse_ids(spark):
    kinds = "record_id bigint, is_duplicate boolean, duplicate_of_id bigint, duplicate_type string, matched_on string, confidence double"
    rows = [(i, True, 1, "x", "y", 1.0) for i in (5, 9, 2_000_005, 10**15)] + [(7, True, 5, "x", "y", 1.0), (1, False, None, None, None, None)]
    for settings in (HARSH, MatchSettings()):
        found = sorted(tuple(r) for r in group_members(spark.createDataFrame(rows, kinds), settings).collect())
        assert found == [(1, 1, 0, 1), (1, 1, 1, 5), (1, 1, 2, 9), (1, 1, 3, 2_000_005), (1, 1, 4, 10**15), (2, 5, 0, 5), (2, 5, 1, 7)]


def test_invariants(spark):
    rows = random_people(5, 120)
    found = detect(clean_columns(table(spark, rows), "id"))
    result = outcome_of(found)
    assert set(result) == {i for i, _ in rows}
    assert all(v is None or v[0] < i for i, v in result.items())
    duplicates = sum(v is not None for v in result.values())
    sizes = group_attributes(found).agg({"total_records": "sum", "primary_id": "count"}).first()
    assert sizes["sum(total_records)"] - sizes["count(primary_id)"] == duplicates


def test_model_distance():
    assert distance("kitten", "sitting") == 3 and distance("", "ab") == 2
