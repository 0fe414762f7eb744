import pytest
from pyspark.sql import functions as F

from rowkin.functions import cleaning
from rowkin.functions.similarity import bounded_distance, edit_distance, max_edits, similarity_ratio

CASES = {
    "normalize_string": {
        "  Arun   Kumar  ": "arun kumar",
        " A B\u001c": "a b",
        None: "",
        " \t ": "",
    },
    "normalize_name": {
        "Mr. Arun Kumar,": "arun kumar",
        "Mr Mrs Bala": "mrs bala",
        "Er.Anand": "er anand",
        "O'Neil-Smith_jr": "o neil smith jr",
        "mr.": "mr",
        None: "",
    },
    "normalize_email": {"  Arun@Gmail.COM  ": "arun@gmail.com", "a b@c . d": "ab@c.d", None: ""},
    "normalize_phone": {
        "+91-98765-43210": "9876543210",
        "09876543210": "9876543210",
        "1 (212) 555-0100": "2125550100",
        "29876543210": "29876543210",
        "919876543": "919876543",
        "no digits": "",
        None: "",
    },
    "normalize_number": {
        "20.0": "20",
        "020": "20",
        "2.50": "2.5",
        "12d": "12d",
        "E201": "e201",
        "007": "7",
        "-0": "0",
        "+5": "5",
        "1_000": "1000",
        "1__0": "1__0",
        "1e3": "1000",
        ".5": "0.5",
        "5.": "5",
        "0.00001": "1e-05",
        "0.00025": "0.00025",
        "12345678.25": "12345678.25",
        "-Infinity": "-inf",
        "inf": "inf",
        "12345678901234567891": "12345678901234567891",
        " ": "",
        None: "",
    },
    "normalize_date": {
        "05/03/2024": "2024-03-05",
        "12/25/2024": "2024-12-25",
        "2024-1-5": "2024-01-05",
        "Jan 5, 2024": "2024-01-05",
        "5 JAN 2024": "2024-01-05",
        "31.12.1999": "1999-12-31",
        "2024/2/29": "2024-02-29",
        "2023-02-29": "2023-02-29",
        "31/02/2024": "31/02/2024",
        "2024-01-123": "2024-01-123",
        "Soon  Enough": "soon enough",
        None: "",
    },
    "drop_null_tokens": {
        "None": "", "NULL": "", "nan": "", "N/A": "", "na": "", "-": "", "  ": "", " nano ": "nano", "n a": "n a", None: "",
    },
}


@pytest.mark.parametrize("rule", CASES)
def test_rule(apply, rule):
    values = list(CASES[rule])
    assert dict(zip(values, apply(getattr(cleaning, rule), values))) == CASES[rule]


def test_dispatch_agrees_with_plan_time_rules(spark):
    values = [" Mr. A  B ", "+91-98765-43210", "020", "05/03/2024", "N/A", "x@Y.z", "Nan", None]
    fields = ["name", "email", "phone", "id_code", "age", "dob", "Email", "address", "other"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for field in fields:
        both = df.select(cleaning.clean_by_field(F.lit(field), F.col("v")), cleaning.clean_value(field, F.col("v")))
        assert all(row[0] == row[1] for row in both.collect()), field


def test_similarity(spark):
    pairs = [("arun kumar", "arun k"), ("", ""), ("", "a"), ("abcdefghijklmnop", "abcdefghijklmxyz"), ("kitten", "sitting")]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select(edit_distance(F.col("a"), F.col("b")), similarity_ratio(F.col("a"), F.col("b")).alias("s")).withColumn(
        "c", F.bround(F.col("s") * 100, 1)
    ).collect()
    assert [r[0] for r in rows] == [4, 0, 1, 3, 3]
    assert rows[0][1] == 0.6 and rows[1][1] == 1.0 and rows[2][1] == 0.0
    assert rows[3][2] == 81.2  # half-even


def test_max_edits_is_the_largest_admissible_distance(spark):
    df = spark.range(1, 400).select(F.col("id").cast("int").alias("n"))
    for theta in (0.85, 0.70):
        for n, t in df.select("n", max_edits(F.col("n"), F.lit(theta))).collect():
            admissible = [d for d in range(n + 1) if 1.0 - d / n >= theta]
            assert t == max(admissible)


def test_bounded_distance_gives_up_beyond_the_threshold(spark):
    df = spark.createDataFrame([("a" * 20, "a" * 17 + "bbb"), ("a" * 20, "a" * 16 + "bbbb")], "a string, b string")
    assert [r[0] for r in df.select(bounded_distance(F.col("a"), F.col("b"), F.lit(0.85))).collect()] == [3, -1]
