"""Queries over the test tables, one per operator: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowkin.functions import cleaning, keys
from rowkin.functions.fields import FieldMap, raw_map, sanitize_column
from rowkin.functions.similarity import edit_distance, similarity_ratio
from rowkin.operators import groups as grouping
from rowkin.operators import profile, views
from rowkin.operators.details import details
from rowkin.operators.exact import distinct_first, match_exact
from rowkin.operators.lookup import incremental_match, key_lookup
from rowkin.operators.names import match_names, possible_pairs
from rowkin.operators.numbering import number_rows
from rowkin.plans.detect import detect, match_tier, run_key_tiers, with_outcomes
from rowkin.plans.people import dealt, people
from rowkin.plans.records import clean_columns, match_rows, records_from_maps
from rowkin.scratch import fresh_path, store, write_out
from rowkin.settings import MatchSettings
from rowkin.sources import cards, delimited, files, grids, json_records, scan

QUERIES: dict = {}


def query(build):
    # A trailing underscore keeps a query apart from an imported operator of the same name.
    QUERIES[build.__name__.rstrip("_")] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def people_columns(spark, folder) -> DataFrame:
    return people(spark, folder).select(
        "id",
        F.col("raw_name").alias("full_name"),
        F.col("raw_email").alias("mail_id"),
        F.col("raw_phone").alias("contact_no"),
        F.col("dep").alias("dept"),
        F.col("raw_code").alias("roll_no"),
    )


def people_records(spark, folder) -> DataFrame:
    """Wide cleaned people."""
    return clean_columns(people_columns(spark, folder), "id")


def people_maps(spark, folder) -> DataFrame:
    """People as raw maps whose headers differ by source."""
    values = [F.col(c) for c in ("raw_name", "raw_email", "raw_phone", "dep", "raw_code")]
    headers = {
        "customer": ("Customer Name", "E-mail", "Mobile No", "Branch", "Roll No"),
        "supplier": ("full_name", "mail_id", "Contact-No", "dept", "emp_id"),
    }
    as_map = lambda names: F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*values))
    raw = F.when(F.col("src") == "customer", as_map(headers["customer"])).otherwise(as_map(headers["supplier"]))
    return people(spark, folder).select(F.col("id").alias("record_id"), F.col("src").alias("source_file"), raw.alias("raw"))


def people_full(spark, folder) -> DataFrame:
    """Cleaned people with all maps, written once as several steps read them."""
    return write_out(records_from_maps(people_maps(spark, folder)), "people")


def part_rows(spark, folder) -> DataFrame:
    """Parts as people of a department: 64 names over 25 brands, so profiles and names are skewed."""
    parts = dealt(table(spark, folder, "part"), "p_partkey").select(
        "p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("dept")
    )
    return clean_columns(parts, "p_partkey")


def map_text(m: Column) -> Column:
    """A map as sorted text, comparable between engines."""
    return F.array_join(
        F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";"
    )


def list_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: x.cast("string")), ",")


# -- sources ---------------------------------------------------------------------------------------


def _written(spark, df: DataFrame, kind: str, **options) -> str:
    path = fresh_path(spark, f"scan-{kind}")
    df.write.options(**options).format(kind).save(path)
    return path


def _read_back(df: DataFrame, types: dict[str, str], *also: str) -> DataFrame:
    return df.select(*also, *[F.try_element_at("raw", F.lit(c)).cast(t).alias(c) for c, t in types.items()])


CUSTOMER = {
    "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string",
}
SUPPLIER = {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"}


#: Rows of a file that a scan query writes: files stay small and their number grows with the table.
ROWS_PER_FILE = 250


def _in_files(df: DataFrame, *order: str) -> DataFrame:
    """The rows in order, dealt over ``part`` after ``part``, so that file and line of each are known."""
    numbered = number_rows(df, list(order), "n").withColumn("part", F.floor((F.col("n") - 1) / ROWS_PER_FILE))
    return numbered.repartition("part").sortWithinPartitions("part", "n").drop("n")


def _written_parts(spark, df: DataFrame, kind: str, **options) -> str:
    """Files of ``_in_files`` rows, as a pattern of their names."""
    path = fresh_path(spark, f"scan-{kind}")
    df.write.partitionBy("part").options(**options).format(kind).save(path)
    return f"{path}/part=*/part-*"


def _part(path: str = "source_path") -> Column:
    return F.regexp_extract(path, "/part=([0-9]+)/", 1).cast("bigint").alias("part")


@query
def scan_csv(spark, folder):
    path = _written_parts(spark, _in_files(table(spark, folder, "customer"), "c_custkey"), "csv", header=True)
    return _read_back(delimited.scan_csv(spark, path), CUSTOMER, _part(), "file_type", "line_number")


@query
def scan_csv_sniff(spark, folder):
    first = _written(spark, table(spark, folder, "customer"), "csv", header=True, sep=";")
    second = _written(spark, table(spark, folder, "supplier"), "csv", header=True, sep="|")
    rows = delimited.scan_csv(spark, [first, second], multi_line=False)
    return rows.select(
        F.coalesce(F.try_element_at("raw", F.lit("c_name")), F.try_element_at("raw", F.lit("s_name"))).alias("name"),
        F.coalesce(F.try_element_at("raw", F.lit("c_acctbal")), F.try_element_at("raw", F.lit("s_acctbal")))
        .cast("double")
        .alias("acctbal"),
        F.size("raw").alias("cells"),
    )


@query
def scan_tsv(spark, folder):
    path = _written_parts(spark, _in_files(table(spark, folder, "supplier"), "s_suppkey"), "csv", header=True, sep="\t")
    return _read_back(delimited.scan_tsv(spark, path), SUPPLIER, _part(), "file_type", "line_number")


@query
def scan_json(spark, folder):
    # A document holds the list of the turns of one part, which has a fixed number of them.
    fields = ("conv_id", "turn", "role", "text")
    turns = number_rows(table(spark, folder, "conversations").select(*fields), list(fields), "n")
    part = F.floor((F.col("n") - 1) / ROWS_PER_FILE).alias("part")
    items = F.transform(F.array_sort(F.collect_list(F.struct("n", *fields))), lambda t: F.struct(*[t[f].alias(f) for f in fields]))
    path = _written_parts(spark, turns.groupBy(part).agg(items.alias("items")), "json")
    raw = lambda key: F.try_element_at("raw", F.lit(key))
    return json_records.scan_json(spark, path).select(
        _part(),
        "file_type",
        "line_number",
        raw("conv_id").cast("bigint").alias("conv_id"),
        raw("turn").cast("bigint").alias("turn"),
        raw("role").alias("role"),
        F.md5(raw("text")).alias("text_md5"),
    )


def _mixed_files(spark, folder) -> list[str]:
    """CSV files, a JSON document for every region, and files of no known format."""
    nations = table(spark, folder, "nation").groupBy(F.col("n_regionkey").cast("bigint").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name", "n_regionkey"))).alias("records")
    )
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    regions = table(spark, folder, "region").withColumn("part", F.col("r_regionkey").cast("bigint"))
    return [
        _written_parts(spark, _in_files(suppliers, "s_suppkey"), "csv", header=True, sep="|"),
        _written_parts(spark, nations, "json"),
        _written_parts(spark, regions, "parquet"),
    ]


@query
def scan_files(spark, folder):
    records, _ = scan.scan_files(spark, _mixed_files(spark, folder))
    return records.select(_part(), "file_type", "line_number", map_text(F.col("raw")).alias("fields"))


@query
def scan_files_reports(spark, folder):
    _, reports = scan.scan_files(spark, _mixed_files(spark, folder))
    return reports.select(
        _part("path"), F.regexp_extract("filename", "[.]([a-z]+)$", 1).alias("extension"), "record_count", "status",
        F.regexp_replace("error", "part-.*[.]", "part.").alias("error"),
    )


@query
def scan_jsonl(spark, folder):
    lines = _in_files(table(spark, folder, "events").select("event_id", "props"), "event_id", "props").drop("event_id")
    path = _written_parts(spark, lines, "text")
    return json_records.scan_jsonl(spark, path).select(
        _part(), "file_type", "line_number", map_text(F.col("raw")).alias("fields")
    )


def _customer_cards(spark, folder) -> DataFrame:
    text = F.concat(
        F.lit("--- RECORD "), F.col("c_custkey").cast("string"), F.lit(" ---\r\nName: "), F.col("c_name"),
        F.lit("\r\n\r\n  Segment = "), F.col("c_mktsegment"), F.lit("\r\nfree text without a field\r\nNAME: second of "),
        F.col("c_name"), F.lit("\r\n==="),
    )
    return table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("source_file"), text.alias("text"))


def _record_rows(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("source_file").cast("bigint").alias("doc"), "file_type", "line_number", map_text(F.col("raw")).alias("fields")
    )


@query
def text_cards(spark, folder):
    return _record_rows(cards.text_records(_customer_cards(spark, folder)))


@query
def text_delimited(spark, folder):
    text = F.concat(
        F.lit("key|name|segment\n"), F.col("c_custkey").cast("string"), F.lit(" | "), F.col("c_name"), F.lit("|"),
        F.col("c_mktsegment"), F.lit("| extra \n| |\n"), F.col("c_nationkey").cast("string"),
    )
    documents = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("source_file"), text.alias("text")
    )
    return _record_rows(cards.text_records(documents))


@query
def report_rows(spark, folder):
    text = F.concat(
        F.lit("Customer list\n"), F.col("c_custkey").cast("string"), F.lit(" , , "), F.col("c_name"), F.lit("|"),
        F.col("c_mktsegment"), F.lit("\n,,\n"),
    )
    documents = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("source_file"), text.alias("text")
    )
    return _record_rows(cards.report_records(documents))


@query
def paragraph_cards(spark, folder):
    paragraphs = F.array(
        F.concat(F.lit("Name: "), F.col("c_name")), F.lit("---"), F.lit(" "),
        F.concat(F.lit("Segment - "), F.col("c_mktsegment")), F.lit("segment: other"),
    )
    documents = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("source_file"), paragraphs.alias("paragraphs")
    )
    return _record_rows(cards.paragraph_records(documents))


@query
def grid_records(spark, folder):
    lines = table(spark, folder, "lineitem")
    as_text = lambda c: F.col(c).cast("string")
    sheet = F.lit("1").alias("grid_id")
    body = lines.select(
        as_text("l_orderkey").alias("source_file"),
        sheet,
        (F.col("l_linenumber") + 1).alias("row_no"),
        F.array(as_text("l_partkey"), as_text("l_suppkey"), F.lit(None).cast("string"), as_text("l_returnflag")).alias("cells"),
    )
    header = lines.select(as_text("l_orderkey").alias("source_file")).distinct().select(
        "source_file", sheet, F.lit(1).alias("row_no"),
        F.array(F.lit(" part "), F.lit("supplier"), F.lit(None).cast("string")).alias("cells"),
    )
    return _record_rows(grids.grid_records(header.unionByName(body)))


@query
def decode_fallback(spark, folder):
    # German and French pages written in Latin-1, the rest in UTF-8.
    content = F.when(F.col("lang").isin("de", "fr"), F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    return table(spark, folder, "documents").select("doc_id", F.md5(files.decode_text(content)).alias("text_md5"))


_EXTENSION = (".CSV", ".json", ".ndjson", ".xyz", ".docx")


@query
def detect_format(spark, folder):
    # The page number of the address stands for the kind of file.
    kind = F.element_at(F.array(*[F.lit(e) for e in _EXTENSION]), (F.col("page_id") % 5 + 1).cast("int"))
    name = F.concat(F.regexp_extract("url", r"^https?://([^#?]*)", 1), kind)
    return table(spark, folder, "pages").select(
        "page_id", files.detect_format(name).alias("format"), files.detect_format(F.col("url")).alias("url_format")
    )


def _raw_records(spark, folder) -> DataFrame:
    customers = table(spark, folder, "customer")
    suppliers = table(spark, folder, "supplier")
    first = customers.select(
        F.lit("customer.csv").alias("source_file"), F.lit("CSV").alias("file_type"),
        (F.col("c_custkey") + 2).alias("line_number"), raw_map(["c_name", "c_mktsegment"]).alias("raw"),
    )
    second = suppliers.select(
        F.lit("supplier.json").alias("source_file"), F.lit("JSON").alias("file_type"),
        (F.col("s_suppkey") + 1).alias("line_number"), raw_map(["s_name"]).alias("raw"),
    )
    return files.union_sources(first, second)


@query
def union_sources(spark, folder):
    numbered = files.with_record_ids(_raw_records(spark, folder))
    return numbered.select("record_id", "source_file", "file_type", "line_number", map_text(F.col("raw")).alias("fields"))


@query
def file_reports(spark, folder):
    suffix = F.element_at(F.array(*[F.lit(e) for e in _EXTENSION]), F.col("n_regionkey") + 1)
    named = table(spark, folder, "nation").select("n_nationkey", F.concat("n_name", suffix).alias("filename"))
    records = table(spark, folder, "supplier").join(named, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("filename").alias("source_file")
    )
    return files.file_reports(named, records)


@query
def records_json(spark, folder):
    found = with_outcomes(people_full(spark, folder), detect(people_records(spark, folder)))
    return scan.record_documents(found)


@query
def outcomes_json(spark, folder):
    return scan.record_documents(detect(people_records(spark, folder)))


# -- schema mapping --------------------------------------------------------------------------------


def _headers(spark, folder) -> DataFrame:
    """Header spellings made of the words of the part table."""
    return table(spark, folder, "part").select(
        "p_partkey",
        F.element_at(
            F.array(
                F.concat(F.lit(" "), F.col("p_name"), F.lit("-No. ")), F.lit("E-Mail"), F.lit(" Contact  No "),
                F.col("p_brand"), F.lit("Org"), F.lit("Full Name"), F.concat(F.col("p_type"), F.lit("_ID")),
            ),
            (F.col("p_partkey") % 7 + 1).cast("int"),
        ).alias("header"),
    )


@query
def sanitize_field(spark, folder):
    return _headers(spark, folder).select("p_partkey", sanitize_column(F.col("header")).alias("field"))


@query
def canonical_field(spark, folder):
    return _headers(spark, folder).select("p_partkey", FieldMap().field_column(F.col("header")).alias("field"))


@query
def custom_aliases(spark, folder):
    fields = FieldMap({"company": ["ECONOMY id"], "Brand": ["Brand#1", "Brand#2", "org"]})
    return _headers(spark, folder).select("p_partkey", fields.field_column(F.col("header")).alias("field"))


@query
def fuse_aliases(spark, folder):
    raw = F.create_map(
        F.lit("mobile"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise(F.lit("  ")),
        F.lit("__line__"), F.lit("9"),
        F.lit("Phone No"), F.when(F.col("o_orderstatus") == "O", F.lit("N/A")),
        F.lit("tel"), F.col("o_custkey").cast("string"),
        F.lit("Total"), F.col("o_orderstatus"),
    )
    return table(spark, folder, "orders").select(
        "o_orderkey",
        map_text(FieldMap().fuse_map(raw)).alias("fused"),
        map_text(FieldMap().clean_map(raw)).alias("canonical"),
    )


@query
def record_summary(spark, folder):
    rows = table(spark, folder, "customer")
    return rows.select("c_custkey", views.record_summary(raw_map(rows.columns[1:3] + ["c_mktsegment", "c_custkey", "c_acctbal"])).alias("summary"))


# -- cleaning --------------------------------------------------------------------------------------


@query
def normalize_string(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.md5(cleaning.normalize_string(F.col("text"))).alias("clean_md5"))


@query
def normalize_name(spark, folder):
    return people(spark, folder).select("id", cleaning.normalize_name(F.col("raw_name")).alias("name"))


@query
def normalize_email(spark, folder):
    return people(spark, folder).select("id", cleaning.normalize_email(F.col("raw_email")).alias("email"))


@query
def normalize_phone(spark, folder):
    return people(spark, folder).select("id", cleaning.normalize_phone(F.col("raw_phone")).alias("phone"))


@query
def normalize_number(spark, folder):
    return people(spark, folder).select("id", cleaning.normalize_number(F.col("raw_code")).alias("id_code"))


def _day_text() -> Column:
    form = F.substring("o_orderpriority", 1, 1)
    text = F.lit("undated")
    for mark, pattern in (("1", "yyyy-M-d"), ("2", "dd/MM/yyyy"), ("3", "MM/dd/yyyy"), ("4", "MMM d, yyyy")):
        text = F.when(form == mark, F.date_format("o_orderdate", pattern)).otherwise(text)
    return text


@query
def normalize_date(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", cleaning.normalize_date(_day_text()).alias("day"))


@query
def null_tokens(spark, folder):
    # The customer number picks a spelling of a missing value.
    spelled = F.element_at(
        F.array(*[F.lit(t) for t in ("None", " NULL ", "nan", "N/A", "na", "-", "  ", "nano")]),
        (F.col("c_custkey") % 8 + 1).cast("int"),
    )
    value = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(spelled)
    return table(spark, folder, "customer").select("c_custkey", cleaning.drop_null_tokens(value).alias("value"))


@query
def dispatch_clean(spark, folder):
    cells = F.explode(people_map_entries())
    rows = people(spark, folder).select("id", cells.alias("field", "value"))
    return rows.select("id", "field", cleaning.clean_by_field(F.col("field"), F.col("value")).alias("clean"))


def people_map_entries() -> Column:
    return F.create_map(
        F.lit("name"), F.col("raw_name"), F.lit("email"), F.col("raw_email"), F.lit("Phone"), F.col("raw_phone"),
        F.lit("id_code"), F.col("raw_code"), F.lit("department"), F.col("dep"),
    )


@query
def normalize_records(spark, folder):
    return people_full(spark, folder).select(
        "record_id",
        map_text(F.col("canonical")).alias("canonical"),
        map_text(F.col("normalized")).alias("normalized"),
        "primary_key",
    )


def _name_pairs(spark, folder) -> DataFrame:
    """Each part name against the cleaned name of its type and brand."""
    return table(spark, folder, "part").select(
        "p_partkey", F.col("p_name").alias("a"), F.lower(F.concat_ws(" ", "p_type", "p_brand")).alias("b")
    )


@query
def levenshtein(spark, folder):
    return _name_pairs(spark, folder).select("p_partkey", edit_distance(F.col("a"), F.col("b")).cast("bigint").alias("distance"))


@query
def similarity_ratio_(spark, folder):
    return _name_pairs(spark, folder).select("p_partkey", similarity_ratio(F.col("a"), F.col("b")).alias("ratio"))


# -- keys ------------------------------------------------------------------------------------------


@query
def primary_key(spark, folder):
    return people_records(spark, folder).select("record_id", "primary_key")


@query
def secondary_keys(spark, folder):
    return people_full(spark, folder).select("record_id", F.inline(keys.secondary_keys(F.col("canonical"))))


def _document_hash(spark, folder, algorithm) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", keys.fingerprint(F.col("text"), algorithm).alias("hash"))


@query
def hash_polynomial(spark, folder):
    return _document_hash(spark, folder, "polynomial")


@query
def hash_djb2(spark, folder):
    return _document_hash(spark, folder, "djb2")


@query
def hash_fnv1a(spark, folder):
    return _document_hash(spark, folder, "fnv1a")


@query
def bucket_id(spark, folder):
    return people_records(spark, folder).select(
        "record_id",
        keys.bucket_id(F.col("primary_key"), 101, "polynomial").alias("polynomial"),
        keys.bucket_id(F.col("primary_key"), 101, "djb2").alias("djb2"),
        keys.bucket_id(F.col("primary_key"), 101, "fnv1a").alias("fnv1a"),
        keys.bucket_id(F.col("primary_key"), 101, "no such name").alias("fallback"),
    )


# -- matching --------------------------------------------------------------------------------------


@query
def match_exact_(spark, folder):
    rows = table(spark, folder, "documents").withColumn("clean", cleaning.normalize_string(F.col("text")))
    return match_exact(rows, "clean", "doc_id")


@query
def distinct_first_(spark, folder):
    rows = table(spark, folder, "documents").withColumn("clean", cleaning.normalize_string(F.col("text")))
    return distinct_first(rows, "clean", "doc_id").select("doc_id", "lang", "source", "n_chars")


def _tier(spark, folder, field) -> DataFrame:
    return match_tier(people_records(spark, folder), field).select("record_id", "duplicate_of_id", "confidence")


@query
def match_email(spark, folder):
    return _tier(spark, folder, "email")


@query
def match_phone(spark, folder):
    return _tier(spark, folder, "phone")


@query
def match_id_code(spark, folder):
    return _tier(spark, folder, "id_code")


@query
def matched_fields(spark, folder):
    full = people_full(spark, folder)
    found = details(full, detect(full))
    return found.select("record_id", list_text(F.array_sort("matched_fields")).alias("matched_fields"))


@query
def explanations(spark, folder):
    full = people_full(spark, folder)
    return details(full, detect(full)).select("record_id", "explanation")


@query
def possible_pairs_(spark, folder):
    return possible_pairs(match_rows(people_records(spark, folder)))


@query
def possible_pairs_parts(spark, folder):
    return possible_pairs(match_rows(part_rows(spark, folder)))


@query
def match_possible(spark, folder):
    # Written first: a filter on cleaned names is moved below the dealing of the rows, to where there are few tasks.
    rows = store(match_rows(part_rows(spark, folder)).drop("digest"), "match-rows")
    return match_names(rows.table, total=rows.rows).select(
        "id", F.col("anchor").cast("bigint").alias("anchor"), F.bround(F.col("similarity") * 100, 1).alias("confidence")
    )


@query
def detect_(spark, folder):
    return detect(people_records(spark, folder))


@query
def detect_without_code(spark, folder):
    return detect(clean_columns(people_columns(spark, folder).drop("roll_no"), "id"))


@query
def detect_parts(spark, folder):
    return detect(part_rows(spark, folder))


@query
def key_lookup_(spark, folder):
    rows = people_records(spark, folder)
    is_master = F.col("record_id") < 1_000_000_000
    key = F.when(F.col("email") != "", F.concat(F.lit("email:"), F.col("email")))
    probe = rows.where(~is_master).select("record_id", key.alias("key"))
    master = rows.where(is_master).select("record_id", key.alias("key"))
    return key_lookup(probe, master, "key").select("record_id", "found_id")


def _increment(spark, folder):
    # The suppliers come twice, the second time under new ids: every new key is repeated in the batch.
    rows = people_records(spark, folder).select("record_id", "email")
    is_master = F.col("record_id") < 1_000_000_000
    key = F.when(F.col("email") != "", F.concat(F.lit("email:"), F.col("email"))).alias("key")
    batch = rows.where(~is_master)
    again = batch.withColumn("record_id", F.col("record_id") + 1_000_000_000)
    return incremental_match(
        batch.unionByName(again).select("record_id", key), rows.where(is_master).select("record_id", key), "key"
    )


@query
def incremental_match_(spark, folder):
    hits, fresh = _increment(spark, folder)
    return hits.select("record_id", F.lit("hit").alias("result"), "found_id").unionByName(
        fresh.select("record_id", F.lit("fresh").alias("result"), F.lit(None).cast("bigint").alias("found_id"))
    )


# -- groups ----------------------------------------------------------------------------------------


def sparse_parts(spark, folder) -> DataFrame:
    """Parts as people with ids far apart: few names per department, so groups have many members."""
    parts = table(spark, folder, "part").select(
        (F.col("p_partkey") * 1_000_003).alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("dept")
    )
    return clean_columns(parts, "id")


@query
def groups(spark, folder):
    return grouping.group_members(detect(sparse_parts(spark, folder)))


#: Every key with more than two rows is split, so that the salted plans are what runs.
SALTED = MatchSettings(hot_rows=2)


@query
def groups_salted(spark, folder):
    return grouping.group_members(detect(sparse_parts(spark, folder), SALTED), SALTED)


@query
def detect_salted(spark, folder):
    return detect(people_records(spark, folder), SALTED)


@query
def group_attrs(spark, folder):
    return grouping.group_attributes(detect(people_records(spark, folder)))


@query
def group_ids(spark, folder):
    return grouping.groups(detect(people_records(spark, folder))).select("group_id", "primary_id", "first_duplicate_id")


@query
def run_report(spark, folder):
    files = spark.createDataFrame([("a.csv", "success"), ("b.json", "error"), ("b.json", "error")], "filename string, status string")
    return grouping.run_report(detect(people_records(spark, folder)), files)


@query
def masters(spark, folder):
    return grouping.masters(detect(people_records(spark, folder))).select("record_id")


@query
def summary(spark, folder):
    return grouping.summary(detect(people_records(spark, folder)))


@query
def bucket_profile(spark, folder):
    rows = people_records(spark, folder)
    whole = None
    for algorithm in keys.FINGERPRINTS:
        one = profile.bucket_profile(rows, "primary_key", 300, algorithm).withColumn("algorithm", F.lit(algorithm))
        whole = one if whole is None else whole.unionByName(one)
    return whole


@query
def bucket_collisions(spark, folder):
    return profile.bucket_collisions(people_records(spark, folder), "primary_key", 101, "fnv1a")


@query
def bucket_members(spark, folder):
    found = profile.bucket_members(people_full(spark, folder), 401, 50, "djb2")
    return found.select(
        "bucket_index", "chain_length", "is_empty", "record_id", "source_file", "key_excerpt",
        F.size(F.map_keys("fields")).cast("bigint").alias("shown_fields"),
    )


@query
def identifier_profile(spark, folder):
    runs, _ = run_key_tiers(people_records(spark, folder))
    return profile.identifier_profile(runs)


@query
def match_rates(spark, folder):
    rows = people_records(spark, folder)
    return profile.match_rates(grouping.summary(detect(rows)), profile.bucket_profile(rows, "primary_key", 101))


# -- views -----------------------------------------------------------------------------------------


@query
def filter_status(spark, folder):
    found = detect(people_records(spark, folder))
    parts = [views.filter_status(found, s).select("record_id", F.lit(s).alias("status")) for s in ("all", "duplicate", "unique")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _turns(spark, folder) -> DataFrame:
    turns = table(spark, folder, "conversations")
    return turns.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("record_id"),
        F.create_map(F.lit("role"), F.col("role"), F.lit("text"), F.col("text")).alias("raw"),
        F.concat(F.lit("role:"), F.col("role")).alias("primary_key"),
    )


@query
def search_records(spark, folder):
    return views.search_records(_turns(spark, folder), "NICHT").select("record_id")


@query
def page_records(spark, folder):
    return views.page_records(_turns(spark, folder), page=3, per_page=20).select("record_id", "primary_key")


@query
def page_info(spark, folder):
    return views.page_info(_turns(spark, folder), 3, 20)


@query
def get_record(spark, folder):
    return views.get_record(_turns(spark, folder), 3001).select("record_id", "primary_key")


@query
def search_groups(spark, folder):
    full = people_full(spark, folder)
    outcomes = detect(full)
    found = grouping.groups(outcomes, full)
    return views.search_groups(found, outcomes, full, "HOUSEHOLD").select("group_id", "primary_id", "total_records")
