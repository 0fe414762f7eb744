import json

import pytest
from pyspark.sql import functions as F

from rowkin.sources import cards, delimited, files, grids, json_records, scan
from tests.conftest import SMALL


def write(folder, name, content):
    (folder / name).write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(folder / name)


def rows_of(df):
    return [(r["source_file"], r["line_number"], r["raw"]) for r in df.sort("source_file", "line_number").collect()]


def test_csv_rules(spark, tmp_path):
    write(tmp_path, "a.csv", 'name, email ,\n Arun ,"x@y, ""z""",1,extra\n\n,,\nPriya\n"two\nlines",e,2\n')
    write(tmp_path, "b.csv", "a;b\n1;2,5\n3;\n")
    write(tmp_path, "c.csv", "name,city\nJosé,Köln\n".encode("latin-1"))
    assert rows_of(delimited.scan_csv(spark, str(tmp_path))) == [
        ("a.csv", 2, {"name": "Arun", "email": 'x@y, "z"', "col_2": "1"}),
        ("a.csv", 4, {"name": "Priya", "email": "", "col_2": ""}),
        ("a.csv", 5, {"name": "two\nlines", "email": "e", "col_2": "2"}),
        ("b.csv", 2, {"a": "1", "b": "2,5"}),
        ("b.csv", 3, {"a": "3", "b": ""}),
        ("c.csv", 2, {"name": "José", "city": "Köln"}),
    ]


def test_csv_header_names():
    assert delimited.header_names("﻿Name,, x ", ",") == ["Name", "col_1", "x"]


def test_tsv(spark, tmp_path):
    path = write(tmp_path, "t.tsv", "roll\tname\n101\tArun\n102\tPriya, B\n")
    found = delimited.scan_tsv(spark, path)
    assert rows_of(found) == [("t.tsv", 2, {"roll": "101", "name": "Arun"}), ("t.tsv", 3, {"roll": "102", "name": "Priya, B"})]
    assert found.first()["file_type"] == "TSV"


def test_line_numbers_of_a_file_split_over_tasks(spark, tmp_path):
    path = write(tmp_path, "big.csv", "n,pad\n" + "".join(f"{i},{'x' * 40}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = delimited.scan_csv(spark, path, multi_line=False)
        assert found.select("raw").rdd.getNumPartitions() > 0
        wrong = found.where(F.col("line_number") != F.col("raw")["n"].cast("int") + 2).count()
        assert wrong == 0 and found.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


DOCUMENTS = {
    "array": ('[{"b": "x", "a": 20}, 5, "s", null, [1], {"c": {"d": [1]}, "e": null}]', [(1, {"b": "x", "a": "20"}), (6, {"c": '{"d":[1]}', "e": None})]),
    "priority": ('{"items": [{"i": 1}], "data": [{"d": 1}], "records": 3}', [(1, {"d": "1"})]),
    "object": ('{"name": "A", "data": "no list", " k ": true}', [(1, {"name": "A", "data": "no list", "k": "true"})]),
    "string": ('["{\\"a\\": 1}"]', []),
    "scalar": ("7", []),
    "broken": ('{"a": ', []),
}


@pytest.mark.parametrize("name", DOCUMENTS)
def test_json_documents(spark, name):
    text, expected = DOCUMENTS[name]
    df = spark.createDataFrame([(name, text)], "source_file string, text string")
    found = [(r["line_number"], r["raw"]) for r in json_records.records_of_documents(df).sort("line_number").collect()]
    assert found == expected
    assert json_records.broken_documents(df).count() == (name == "broken")


def test_json_keeps_the_order_of_keys(spark):
    df = spark.createDataFrame([("x", '[{"z": "1", "a": "2", "m": "3"}]')], "source_file string, text string")
    keys = json_records.records_of_documents(df).select(F.map_keys("raw")).first()[0]
    assert keys == ["z", "a", "m"]


def test_jsonl(spark, tmp_path):
    path = write(tmp_path, "x.jsonl", '{"a": 1}\n\nbroken\n{"b": "2"} {"c": 3}\n[1]\n {" d ": null, "e": "f"}\n{"a":1},{"b":2}\n')
    assert rows_of(json_records.scan_jsonl(spark, path)) == [("x.jsonl", 1, {"a": "1"}), ("x.jsonl", 6, {"d": None, "e": "f"})]


TEXTS = {
    "cards": ("--- RECORD 1 ---\nName: A\nEmail: a@x\nName: B\n===", [(4, {"Name": "A", "Email": "a@x"}), (5, {"Name": "B"})]),
    "open": ("Student #4\n\nName = A\nnoise\nA-b-c: d\nPhone - 5", [(5, {"Name": "A", "Phone": "5"})]),
    "misread": ("2024-01-01,foo\n2024-01-02,bar", [(2, {"2024": "01-01,foo"}), (2, {"2024": "01-02,bar"})]),
    "table": ("k|v\n1 | 2 | 3\n |\n4", [(2, {"k": "1", "v": "2", "col_2": "3"}), (4, {"k": "4"})]),
    "repeated": ("k,k\n1,2", [(2, {"k": "2"})]),
    "empty": (" \n\n", []),
    "prose": ("just words\nmore words", []),
}


@pytest.mark.parametrize("name", TEXTS)
def test_text(spark, name):
    text, expected = TEXTS[name]
    df = spark.createDataFrame([(name, text)], "source_file string, text string")
    found = [(r["line_number"], r["raw"]) for r in cards.text_records(df).collect()]
    assert found == expected


def test_report_and_paragraphs(spark):
    df = spark.createDataFrame([("r", "Title\nx, ,y|z\n,|\nlast\ta")], "source_file string, text string")
    found = [(r["line_number"], r["raw"]) for r in cards.report_records(df).collect()]
    assert found == [(2, {"field_1": "x", "field_3": "y", "field_4": "z"}), (4, {"field_1": "last", "field_2": "a"})]
    paragraphs = ["Name: A", "---", "  ", "Name: B", "name: C", ""]
    df = spark.createDataFrame([("d", paragraphs)], "source_file string, paragraphs array<string>")
    found = [(r["line_number"], r["raw"]) for r in cards.paragraph_records(df).collect()]
    assert found == [(3, {"Name": "A"}), (5, {"Name": "B"}), (6, {"name": "C"})]


GRID = "source_file string, grid_id string, row_no int, cells array<string>"


def test_grids(spark):
    data = [
        ("w", "1", 1, [" A ", None, ""]), ("w", "1", 2, ["1", None, "3", "4"]), ("w", "1", 3, [None, None]), ("w", "1", 4, ["", ""]),
        ("d", "1", 1, ["only header"]), ("d", "2", 1, ["A", " "]), ("d", "2", 2, ["x", "y"]), ("d", "2", 3, [" ", ""]),
    ]
    df = spark.createDataFrame(data, GRID)
    sheets = rows_of(grids.grid_records(df.where("source_file = 'w'")))
    assert sheets == [("w", 2, {"A": "1", "col_1": "", "": "3", "col_3": "4"}), ("w", 4, {"A": "", "col_1": ""})]
    paragraphs = spark.createDataFrame([("d", ["N1: x"]), ("e", ["N1: y"])], "source_file string, paragraphs array<string>")
    documents = rows_of(grids.document_records(df.where("source_file = 'd'"), paragraphs))
    assert documents == [("d", 2, {"A": "x", "col_1": "y"}), ("e", 1, {"N1": "y"})]


def test_detect_format(apply):
    names = ["data.csv", "a/b/Records.JSON", "students.xlsx", "old.xls", "report.pdf", "notes.docx", "items.txt", "x.ndjson", "unknown.xyz", ".csv", "..csv", "a.csv/b", "t.tsv"]
    assert apply(files.detect_format, names) == [
        "CSV", "JSON", "Excel", "Excel", "PDF", "Word (.docx)", "Plain Text", "JSONL", None, None, None, None, "TSV",
    ]


def test_mixed_files_reports_and_ids(spark, tmp_path):
    write(tmp_path, "a.csv", "name,email\nArun,a@x\nPriya,p@x\n")
    write(tmp_path, "b.json", json.dumps([{"full_name": "Arun", "mail": "A@X"}]))
    write(tmp_path, "c d+e.jsonl", '{"name": "Bala"}\n')
    write(tmp_path, "e.txt", "Name: Chitra\nEmail: c@x\n")
    write(tmp_path, "f.tsv", "name\tmail\nDeva\td@x\n")
    write(tmp_path, "g.json", "{broken")
    write(tmp_path, "h.csv", "name\n")
    write(tmp_path, "i.xyz", "?")
    write(tmp_path, "j.pdf", "%PDF")
    records, reports = scan.scan_files(spark, str(tmp_path))
    numbered = files.with_record_ids(records)
    order = [(r["record_id"], r["source_file"]) for r in numbered.sort("record_id").collect()]
    assert order == [(1, "a.csv"), (2, "a.csv"), (3, "b.json"), (4, "c d+e.jsonl"), (5, "e.txt"), (6, "f.tsv")]
    found = {r["filename"]: (r["record_count"], r["status"]) for r in reports.collect()}
    assert found["a.csv"] == (2, "success") and found["c d+e.jsonl"] == (1, "success")
    assert [found[n] for n in ("g.json", "h.csv", "i.xyz", "j.pdf")] == [(0, "error")] * 4
    errors = {r["filename"]: r["error"] for r in reports.where("error is not null").collect()}
    assert errors["g.json"] == "Error parsing 'g.json': not a JSON document"
    assert errors["i.xyz"].startswith("Unsupported file extension '.xyz'.")
    assert errors["h.csv"].startswith("No records could be extracted from 'h.csv'.")


def test_decode_fallback(spark):
    df = spark.createDataFrame([(bytearray("é".encode("latin-1")),), (bytearray("é".encode()),)], "content binary")
    assert [r[0] for r in df.select(files.decode_text(F.col("content"))).collect()] == ["é", "é"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "Exact Duplicate"), (2, None)], "record_id bigint, duplicate_type string")
    scan.sink_parquet(df, str(tmp_path / "p"))
    scan.sink_json(df, str(tmp_path / "j"))
    assert spark.read.parquet(str(tmp_path / "p")).where("duplicate_type = 'Exact Duplicate'").count() == 1
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert scan.record_documents(df).sort("document").first()[0] == '{"record_id":1,"duplicate_type":"Exact Duplicate"}'


def test_list_files(spark, tmp_path):
    write(tmp_path, "a.csv", "x" * 2048)
    row = files.list_files(spark, str(tmp_path)).first()
    assert (row["filename"], row["format"], row["size_bytes"], row["size_kb"]) == ("a.csv", "CSV", 2048, 2.0)
    assert SMALL.endswith("sf0.001")


def _plain_cards(lines):
    """Cards of stripped lines, in plain Python."""
    done, fields = [], {}
    seen = set()
    for i, line in enumerate(lines, start=1):
        key, mark, value = line.partition(":")
        closes = line.startswith("---")
        is_field = bool(mark) and not closes
        if closes or (is_field and key.lower() in seen):
            if seen:
                done.append((i, fields))
            seen, fields = set(), {}
        if is_field:
            seen.add(key.lower())
            fields[key] = value.strip()
    return done + ([(len(lines), fields)] if seen else [])


def test_many_cards_in_one_document_take_time_in_proportion(spark):
    import time

    def lines_of(n):
        out = []
        for i in range(n):
            out += [f"Name: n{i}", f"Mail: m{i}"] + (["-----"] if i % 7 == 0 else [])
        return out

    seconds = {}
    for n in (1, 300, 4000, 16000):
        lines = lines_of(n)
        df = spark.createDataFrame([("\n".join(lines),)], "text string")
        begun = time.perf_counter()
        found = df.select(F.inline(cards.text_cards(F.col("text")))).collect()
        seconds[n] = time.perf_counter() - begun
        assert [(r["line_number"], r["raw"]) for r in found] == _plain_cards(lines)
    assert seconds[16000] < 8 * seconds[4000] + 2


def test_rows_are_numbered_from_one_scan_whatever_its_splits(spark, tmp_path):
    lines = [json.dumps({"i": i}) for i in range(30_000)]
    path = write(tmp_path, "big.jsonl", "\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
        found = json_records.scan_jsonl(spark, path)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "170000")
        assert found.count() == 30_000
        assert found.where("line_number <> cast(raw['i'] as bigint) + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_repeated_keys_last_wins(spark, tmp_path):
    path = write(tmp_path, "a.jsonl", '{"a":1,"a":2}\n{"a":1," a":3}\n{"b":4}\n')
    assert [raw for _, _, raw in rows_of(json_records.scan_jsonl(spark, path))] == [{"a": "2"}, {"a": "3"}, {"b": "4"}]
    write(tmp_path, "b.json", '[{"a":1,"a":2}, 7, {"b":{"x":1,"x":2}}]')
    write(tmp_path, "c.json", '{"data":[{"k":1,"k":2},{" k":3,"k ":4}]}')
    write(tmp_path, "d.json", '{"a":1,"a":2}')
    found = rows_of(json_records.scan_json(spark, [str(tmp_path / n) for n in ("b.json", "c.json", "d.json")]))
    assert found == [
        ("b.json", 1, {"a": "2"}), ("b.json", 3, {"b": '{"x":1,"x":2}'}),
        ("c.json", 1, {"k": "2"}), ("c.json", 2, {"k": "4"}), ("d.json", 1, {"a": "2"}),
    ]


def test_texts_that_look_like_lists_or_objects_are_not(spark):
    texts = ['[{"a":1},"{}","x"]', '{"records":"[{}]","data":[{"k":1}]}', '{"records":"[1]"}', "[]", '"s"', "{", "", "[1] x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r[0] for r in df.sort("i").select(json_records.json_records(F.col("t"))).collect()]
    plain = [None if f is None else [(r["line_number"], r["raw"]) for r in f] for f in found]
    assert plain == [[(1, {"a": "1"})], [(1, {"k": "1"})], [(1, {"records": "[1]"})], [], [], None, None, []]


def test_json_document_beyond_the_size_of_a_variant(spark, tmp_path):
    filler = "x" * 4000
    with open(tmp_path / "large.json", "w") as out:
        out.write('{"count": 34000, "records": [')
        out.write(",".join(f'{{"i": {i}, "t": "{filler}"}}' for i in range(34_000)))
        out.write("]}")
    found = json_records.scan_json(spark, str(tmp_path / "large.json"))
    assert found.agg(F.count("*"), F.max("line_number"), F.max(F.length(F.col("raw")["t"]))).first() == (34_000, 34_000, 4000)


def test_header_with_a_quoted_line_break(spark, tmp_path):
    path = write(tmp_path, "h.csv", 'name,"email\naddress",phone\nArun,a@b,12\n')
    assert rows_of(delimited.scan_csv(spark, path)) == [("h.csv", 2, {"name": "Arun", "email\naddress": "a@b", "phone": "12"})]


def test_one_overlong_header_fails_its_file_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(delimited, "MOST_HEADER", 150_000)
    write(tmp_path, "good.csv", "name\nArun\n")
    write(tmp_path, "wide.csv", ",".join(f"column{i}" for i in range(12_000)) + "\n1\n")
    write(tmp_path, "bad.csv", "x" * 200_000 + "\n1\n")
    records, reports = scan.scan_files(spark, str(tmp_path))
    assert {name for name, _, _ in rows_of(records)} == {"good.csv", "wide.csv"}
    found = {r["filename"]: (r["record_count"], r["status"], r["error"]) for r in reports.collect()}
    assert found["good.csv"] == (1, "success", None) and found["wide.csv"][:2] == (1, "success")
    assert found["bad.csv"] == (0, "error", "Error parsing 'bad.csv': header line of 200000 characters")


@pytest.mark.parametrize("read", [delimited.scan_csv, delimited.scan_tsv])
def test_an_overlong_header_without_a_report_is_an_error(spark, tmp_path, monkeypatch, read):
    monkeypatch.setattr(delimited, "MOST_HEADER", 1000)
    write(tmp_path, "good.csv", "name\nArun\n")
    assert read(spark, str(tmp_path)).count() == 1
    write(tmp_path, "bad.csv", "x" * 2000 + "\n1\n")
    with pytest.raises(ValueError, match="bad.csv: header line of 2000 characters"):
        read(spark, str(tmp_path))


def test_files_of_one_name_are_told_apart(spark, tmp_path):
    for folder, text in (("a b", "n\n1\n2\n3\n"), ("c+d", "n\n4\n"), ("e", "\n")):
        (tmp_path / folder).mkdir()
        write(tmp_path / folder, "part.csv", text)
        write(tmp_path / folder, "part.json", '[{"k": 1}]' if folder == "e" else "{")
    records, reports = scan.scan_files(spark, [str(tmp_path / f) for f in ("a b", "c+d", "e")])
    found = sorted((r["path"].split("/")[-2:], r["record_count"], r["status"]) for r in reports.collect())
    assert found == [
        (["a b", "part.csv"], 3, "success"), (["a b", "part.json"], 0, "error"), (["c+d", "part.csv"], 1, "success"),
        (["c+d", "part.json"], 0, "error"), (["e", "part.csv"], 0, "error"), (["e", "part.json"], 1, "success"),
    ]
    numbered = files.with_record_ids(records).sort("record_id").collect()
    assert [(r["raw"].get("n"), r["line_number"]) for r in numbered] == [("1", 2), ("2", 3), ("3", 4), ("4", 2), (None, 1)]


ODD_NAMES = ["x 100%.csv", "a%20b.csv", "a b.csv", "a+b.csv", "[1].csv", "x{a,b}.csv", "star*.csv", "q?.csv", "back\\slash.csv", "é ü.csv", "%41.csv", "A.csv"]


def test_any_legal_name_is_read_and_reported_as_its_own(spark, tmp_path):
    for n, name in enumerate(ODD_NAMES):
        write(tmp_path, name, "n\n" + "".join(f"{n}-{k}\n" for k in range(n + 1)))
    write(tmp_path, "x+1%.jsonl", '{"n": "l"}\n')
    write(tmp_path, "y [2]%.json", '[{"n": "d"}, {"n": "e"}]')
    write(tmp_path, "z%2B.txt", "nn: card\n")
    write(tmp_path, "t{}%.tsv", "n\tm\n1\t2\n")
    records, reports = scan.scan_files(spark, str(tmp_path))
    found = {}
    for r in records.collect():
        found.setdefault(r["source_file"], []).append(r["raw"].get("n", r["raw"].get("nn")))
        assert r["source_path"].endswith("/" + r["source_file"])
    expected = {name: sorted(f"{n}-{k}" for k in range(n + 1)) for n, name in enumerate(ODD_NAMES)}
    expected |= {"x+1%.jsonl": ["l"], "y [2]%.json": ["d", "e"], "z%2B.txt": ["card"], "t{}%.tsv": ["1"]}
    assert {k: sorted(v) for k, v in found.items()} == expected
    assert {r["filename"]: (r["record_count"], r["status"]) for r in reports.collect()} == {
        name: (len(rows), "success") for name, rows in expected.items()
    }


def test_files_without_a_byte_are_listed_and_reported(spark, tmp_path):
    for name in ("a%20b.csv", "n.json", "u.xyz", "t.txt", "l.jsonl", "v.tsv"):
        write(tmp_path, name, "")
    write(tmp_path, "one.csv", "n\n1\n")
    listed = {r["filename"]: (r["size_bytes"], r["size_kb"]) for r in files.list_files(spark, str(tmp_path)).collect()}
    assert len(listed) == 7 and listed["a%20b.csv"] == (0, 0.0) and listed["one.csv"] == (4, 0.0)
    records, reports = scan.scan_files(spark, str(tmp_path))
    assert records.count() == 1
    found = {r["filename"]: (r["record_count"], r["status"], r["error"]) for r in reports.collect()}
    assert len(found) == 7 and found.pop("one.csv") == (1, "success", None)
    assert found.pop("u.xyz")[2].startswith("Unsupported file extension '.xyz'.")
    assert all(r == (0, "error", files.NO_RECORDS % name) for name, r in found.items())
