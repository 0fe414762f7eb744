import csv
import io
import random

import pytest

from rowkin.sources import delimited, quoted


@pytest.fixture
def small_splits(spark):
    """Files of a few kilobytes are cut into dozens of splits, as large ones are."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plain(text, sep):
    """What a reader from the start of the file gives: (line number, cells by name)."""
    rows = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=sep) if r]
    out = []
    for n, row in enumerate(rows[1:], 2):
        cells = {(name.strip() if name else f"col_{i}"): (row[i].strip() if i < len(row) else "") for i, name in enumerate(rows[0])}
        if any(cells.values()):
            out.append((n, cells))
    return out


def drawn(seed, sep, end, n=150):
    rng = random.Random(seed)

    def cell():
        text = "".join(rng.choice(["a", "é", "x y", "", "7"]) for _ in range(rng.randrange(4)))
        if rng.random() < 0.35:
            inner = "".join(rng.choice([text, sep, end, '""', end + end, "b", end + '""' + sep]) for _ in range(rng.randrange(6)))
            return f'"{inner}"'
        return text + rng.choice(["", "", "", '"', 'q"q'])  # a quote inside a plain cell is a mark like any other

    lines = [sep.join(cell() for _ in range(rng.randrange(1, 5))) for _ in range(n)]
    lines = [line if not line.startswith('"') or line.count('"') % 2 == 0 else "x" + line for line in lines]
    # A cell that only starts with a stray quote would open it.
    lines = [sep.join(c if c != '"' else "w" for c in line.split(sep)) if end not in line else line for line in lines]
    return f"n1{sep}\"na{end}me\"{sep}n1{end}" + end.join(rng.choice([line, line, line, "", sep + sep]) for line in lines) + rng.choice(["", end])


@pytest.mark.parametrize("seed, sep, end", [(1, ",", "\n"), (2, ";", "\r\n"), (3, "\t", "\n"), (4, "|", "\r\n")])
def test_split_files_equal_files_read_from_their_start(spark, small_splits, tmp_path, seed, sep, end):
    texts = {}
    for k in range(4):
        texts[f"f{k}.csv"] = drawn(10 * seed + k, sep, end)
        (tmp_path / f"f{k}.csv").write_bytes((("﻿" if k == 1 else "") + texts[f"f{k}.csv"]).encode())
    found = {}
    for r in delimited.scan_csv(spark, str(tmp_path), sep=sep).collect():
        found.setdefault(r["source_file"], []).append((r["line_number"], r["raw"]))
    for name, text in texts.items():
        assert sorted(found[name], key=lambda r: r[0]) == plain(text, sep)
    splits = spark.read.option("lineSep", "\n").text(str(tmp_path)).select("_metadata.file_path", "_metadata.file_block_start").distinct().count()
    assert splits > 15


def test_a_line_in_either_case():
    """The state behind a line, from both states before it, against parsing it."""
    rng = random.Random(3)
    for _ in range(3000):
        line = "".join(rng.choice('",ab') for _ in range(rng.randrange(9)))
        for inside in (False, True):
            text = ('"' if inside else "") + line
            rows = list(csv.reader(io.StringIO(text + "\nZ", newline="")))
            assert quoted.stays_open(line.encode(), b",", inside) == (len(rows) == 1), (line, inside)
        assert quoted.parsed(line, ",") == (next(csv.reader([line])) or [""])


def test_a_cell_over_many_splits_and_one_never_closed(spark, small_splits, tmp_path):
    long = "\n".join(f"line {k}" for k in range(400))
    (tmp_path / "a.csv").write_text(f'n,t\n1,"{long}"\n2,b\n3,"open\nto the end\n')
    rows = sorted((r["line_number"], r["raw"]["t"]) for r in delimited.scan_csv(spark, str(tmp_path)).collect())
    assert rows == [(2, long), (3, "b"), (4, "open\nto the end")]


def test_carriage_returns_alone_and_latin_1(spark, tmp_path):
    (tmp_path / "r.csv").write_bytes(b'n,t\r1,"a\rb"\r2,c\r')
    (tmp_path / "l.csv").write_bytes('n,t\n1,"é\nü"\n'.encode("latin-1"))
    (tmp_path / "e.csv").write_bytes(b"\n\n")
    rows = sorted((r["source_file"], r["line_number"], r["raw"]["t"]) for r in delimited.scan_csv(spark, str(tmp_path)).collect())
    assert rows == [("l.csv", 2, "é\nü"), ("r.csv", 2, "a\nb"), ("r.csv", 3, "c")]  # that reader turns its line ends into line feeds
