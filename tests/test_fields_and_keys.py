from pyspark.sql import functions as F

from rowkin.functions import keys
from rowkin.functions.fields import FieldMap, sanitize
from rowkin.plans.records import clean_columns, match_rows, records_from_columns, records_from_maps

ALIASES = {
    "student_name": "name", "full_name": "name", "employee_name": "name", "customer_name": "name",
    "mail_id": "email", "email_address": "email", "contact_no": "phone", "mobile": "phone",
    "dept": "department", "roll_no": "id_code", " E-Mail ": "email", "Blood Group!": "blood_group",
}


def test_aliases_on_driver_and_in_data(apply):
    fields = FieldMap()
    assert {a: fields.field(a) for a in ALIASES} == ALIASES
    assert dict(zip(ALIASES, apply(fields.field_column, list(ALIASES)))) == ALIASES
    assert sanitize("  Full - Name (x) ") == "full_name_x"
    assert len(fields.fields()) == 10


def test_custom_aliases_do_not_leak_and_later_fields_win(spark):
    custom = FieldMap({"phone": ["fax"], "pet": ["dog", "email"]})
    assert custom.field("Fax") == "phone" and custom.field("dog") == "pet" and custom.field("email") == "pet"
    assert FieldMap().field("fax") == "fax" and FieldMap().field("email") == "email"
    listed = spark.createDataFrame([("phone", "fax"), ("pet", "dog")], "field string, alias string")
    assert FieldMap.from_table(listed).field("DOG") == "pet"
    assert {r["alias"]: r["field"] for r in custom.table(spark).collect()}["fax"] == "phone"


RAW = [
    (1, {"__source_file__": "x", "mobile": "  ", "Phone No": "N/A", "tel": "5", "Other Col": " A  B "}),
    (2, {"Name": "Dr. Who", " note ": "na", "dob": "1/2/2024", "email": "None"}),
    (3, {"a": "-", "b": " "}),
    (4, {}),
]


def test_map_path(spark):
    # Built from arrays, which keep the order of the keys.
    listed = [(i, list(raw), list(raw.values())) for i, raw in RAW]
    df = spark.createDataFrame(listed, "record_id bigint, k array<string>, v array<string>").select(
        "record_id", F.map_from_arrays("k", "v").alias("raw")
    )
    rows = {r["record_id"]: r for r in records_from_maps(df).collect()}
    assert rows[1]["canonical"] == {"other_col": "a b"}  # the literal N/A blocks the good number behind it
    assert rows[1]["normalized"] == {"Phone No": "n/a", "tel": "5", "Other Col": "a b", "other_col": "a b"}
    assert rows[2]["canonical"] == {"name": "who", "dob": "2024-02-01"}
    assert rows[2]["normalized"] == {"Name": "dr. who", "name": "who", "note": "na", "dob": "1/2/2024"}
    assert rows[2]["primary_key"] == "dob:2024-02-01|name:who"
    assert rows[3]["canonical"] == {} and rows[3]["primary_key"] == "" and rows[4]["primary_key"] == ""
    assert rows[3]["normalized"] == {"a": "-"}


def test_wide_path_equals_map_path(spark):
    columns = ["mobile", "Full Name", "tel", "E-mail", "Zip"]
    data = [(1, " ", "Mr. X Y", "09876543210", "A@b.c", "1 2"), (2, "N/A", None, "7", " ", "-"), (3, None, None, None, None, None)]
    df = spark.createDataFrame(data, "id bigint, " + ", ".join(f"`{c}` string" for c in columns))
    wide = records_from_columns(df, "id")
    raw = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(f"`{c}`"))])
    maps = records_from_maps(df.select(F.col("id").alias("record_id"), raw.alias("raw")))
    pick = lambda d: {r["record_id"]: (r["canonical"], r["normalized"], r["primary_key"]) for r in d.collect()}
    assert pick(wide) == pick(maps)
    keyed = {r["record_id"]: r["primary_key"] for r in clean_columns(df, "id").collect()}
    assert keyed == {k: v[2] for k, v in pick(wide).items()}
    narrow = match_rows(wide).drop("digest").sort("id").collect()
    assert narrow[0]["phone"] == "9876543210" and narrow[1]["phone"] is None and narrow[2]["name"] is None


def test_key_does_not_depend_on_column_order(spark):
    df = spark.createDataFrame(
        [(1, {"email": "arun@gmail.com", "name": "Arun", "phone": "9876543210"}),
         (2, {"phone": "9876543210", "name": "arun", "email": "arun@gmail.com"})],
        "record_id bigint, raw map<string,string>",
    )
    found = {r["primary_key"] for r in records_from_maps(df).collect()}
    assert found == {"email:arun@gmail.com|name:arun|phone:9876543210"}


def test_secondary_keys(spark):
    df = spark.createDataFrame([({"email": "e", "name": "n", "department": "d", "dob": "2000-01-01"},)], "m map<string,string>")
    pairs = [(p["key_type"], p["key"]) for p in df.select(keys.secondary_keys(F.col("m"))).first()[0]]
    assert pairs == [("email", "email:e"), ("name_dept", "name:n|dept:d"), ("name_dob", "name:n|dob:2000-01-01")]


def test_fingerprints(apply):
    values = ["arun", "name:arun kumar|dept:cse", "", "añ😀"]
    assert apply(keys.polynomial_hash, values)[:3] == [3393078, 3119564465, 0]
    assert apply(keys.djb2_hash, values)[:3] == [2090087611, 1430521460, 5381]
    assert apply(keys.fnv1a_hash, values)[:3] == [2984785417, 2903564472, 2166136261]

    def model(text, step, h):
        for c in text:
            h = step(h, ord(c)) % 2**32
        return h

    assert apply(keys.djb2_hash, values)[3] == model(values[3], lambda h, c: h * 33 + c, 5381)
    assert apply(keys.fnv1a_hash, values)[3] == model(values[3], lambda h, c: (h ^ c) * 16777619, 2166136261)
    assert apply(keys.polynomial_hash, values)[3] == sum(ord(c) * 31**i for i, c in enumerate(values[3])) % 2**32
    assert apply(lambda k: keys.fingerprint(k, "djb2"), values)[2] == 0
    key = "address:chennai|email:arun@gmail.com|name:arun kumar|phone:9876543210"
    for algorithm, bucket in (("polynomial", 39), ("djb2", 54), ("fnv1a", 83), ("unknown", 39)):
        assert apply(lambda k: keys.bucket_id(k, 101, algorithm), [key]) == [bucket]


def test_bucket_counts():
    assert [keys.bucket_count(n) for n in (7, 53, 60, 50021, 50022)] == [31, 53, 101, 50021, 50023]


def test_headers_in_data_get_the_fields_of_headers_in_plans(apply):
    """The short way for usual spellings takes no header that sanitising would not give to the same alias."""
    custom = FieldMap({"odd": ["_x", "a__b", "y_", "plain"], "name": ["Künstler Name"]})
    names = [n for field in custom.aliases.values() for n in field]
    headers = names + [n.upper().replace("_", " ") for n in names] + [n.replace("_", "-") for n in names]
    headers += [" name", "name ", "customer  name", "customer - name", "e--mail", "na me", "x", "_x", " x", "a b", "a  b", "a__b", "y", "y ", "E-Mail!", "Mail\tId", ""]
    assert apply(custom.field_column, headers) == [custom.field(h) for h in headers]
