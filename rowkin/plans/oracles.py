"""The same results in plain SQL for an independent engine: ``name -> SQL``.

None of these shares the blocking or the rounds of the library: pairs come from a nested loop over
name profiles, and the possible tier walks the profiles one by one.  The only thing taken from the library
is its table of aliases; word lists and sizes are written out again.
"""

from __future__ import annotations

import re

from rowkin.functions.fields import FieldMap
from rowkin.plans.people import PEOPLE_SQL

BLANK = (
    r"[\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


# Fixed values.
HONORIFICS = ('mr', 'ms', 'mrs', 'dr', 'prof', 'er')
NULL_TOKENS = ('none', 'null', 'nan', 'n/a', 'na', '-', '')
PLAIN_NULL_TOKENS = ('none', 'null', 'nan')


def quoted(*words: str) -> str:
    return ", ".join(f"'{w}'" for w in words)


def strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^{BLANK}+|{BLANK}+$', '', 'g')"


def plain(x: str) -> str:
    return f"lower(trim(regexp_replace(coalesce({x}, ''), '{BLANK}+', ' ', 'g')))"


def dropped(x: str) -> str:
    return f"(case when lower({strip(x)}) in ({quoted(*NULL_TOKENS)}) then '' else {strip(x)} end)"


def name(x: str) -> str:
    untitled = f"regexp_replace({plain(x)}, '^({'|'.join(HONORIFICS)})\\.?\\s+', '')"
    return f"trim(regexp_replace({untitled}, '[.,_\\-''\"\\s]+', ' ', 'g'))"


def email(x: str) -> str:
    return f"lower(regexp_replace(coalesce({x}, ''), '{BLANK}+', '', 'g'))"


def phone(x: str) -> str:
    d = f"regexp_replace(coalesce({x}, ''), '\\D', '', 'g')"
    return (
        f"(case when length({d}) = 12 and starts_with({d}, '91') then right({d}, 10) "
        f"when length({d}) = 11 and left({d}, 1) in ('0', '1') then right({d}, 10) else {d} end)"
    )


def number(x: str) -> str:
    s = strip(x)
    return (
        f"(case when regexp_matches({s}, '^[+-]?\\d+(\\.0*)?$') "
        f"then cast(cast(cast({s} as double) as bigint) as varchar) else {plain(x)} end)"
    )


PEOPLE = f"people as ({PEOPLE_SQL})"

CLEAN_PEOPLE = f"""{PEOPLE},
c as (
  select id, src, {name(dropped('raw_name'))} as name, {email(dropped('raw_email'))} as email,
    {phone(dropped('raw_phone'))} as phone, {plain(dropped('dep'))} as department,
    {number(dropped('raw_code'))} as id_code, '' as company, '' as address
  from people),
k as (
  select *, concat_ws('|', 'department:' || nullif(department, ''), 'email:' || nullif(email, ''),
    'id_code:' || nullif(id_code, ''), 'name:' || nullif(name, ''), 'phone:' || nullif(phone, '')) as key
  from c)"""

CLEAN_WITHOUT_CODE = CLEAN_PEOPLE.replace(
    f"{number(dropped('raw_code'))} as id_code", "'' as id_code"
)

CLEAN_PARTS = f"""c as (
  select p_partkey as id, {name(dropped('p_name'))} as name, {plain(dropped('p_brand'))} as department,
    '' as email, '' as phone, '' as id_code, '' as company, '' as address from part),
k as (
  select *, concat_ws('|', 'department:' || nullif(department, ''), 'name:' || nullif(name, '')) as key from c)"""

CLEAN_SPARSE = CLEAN_PARTS.replace("p_partkey as id", "p_partkey * 1000003 as id")

KEY_TIERS = """
e0 as (select *, case when key <> '' then min(id) over (partition by key) end as a0 from k),
s0 as (select * from e0 where key <> '' and id = a0),
e1 as (select *, case when email <> '' then min(id) over (partition by email) end as a1 from s0),
s1 as (select * from e1 where a1 is null or a1 = id),
e2 as (select *, case when phone <> '' then min(id) over (partition by phone) end as a2 from s1),
s2 as (select * from e2 where a2 is null or a2 = id),
e3 as (select *, case when id_code <> '' then min(id) over (partition by id_code) end as a3 from s2),
s3 as (select * from e3 where a3 is null or a3 = id)"""

PAIRS = """
prof as (
  select min(id) as id, name, department, company, address from s3
  where length(name) >= 3 group by name, department, company, address),
scored as (
  select a.id as i, b.id as j,
    1.0::double - levenshtein(a.name, b.name)::double / greatest(length(a.name), length(b.name))::double as similarity,
    (a.department <> '' and a.department = b.department) or (a.company <> '' and a.company = b.company)
      or (a.address <> '' and a.address = b.address) as shared
  from prof a join prof b on b.id < a.id),
pairs as (select i, j, similarity from scored where similarity >= 0.85 or (shared and similarity >= 0.7))"""

SETTLED = """
adj as (select i, list(j order by j) as js from pairs group by i),
ends as (select i as id from pairs union select j from pairs),
ranked as (select id, row_number() over (order by id) as rk from ends),
steps as (
  select 0::bigint as step, []::bigint[] as uniq
  union all
  select s.step + 1, case when a.js is null or not list_has_any(a.js, s.uniq) then list_append(s.uniq, r.id) else s.uniq end
  from steps s join ranked r on r.rk = s.step + 1 left join adj a on a.i = r.id),
uniq as (select uniq from steps order by step desc limit 1),
decided as (
  select a.i as id, list_min(list_intersect(a.js, u.uniq)) as anchor from adj a, uniq u
  where list_has_any(a.js, u.uniq)),
firsts as (select d.id, d.anchor, p.similarity from decided d join pairs p on p.i = d.id and p.j = d.anchor),
possible as (
  select id, anchor, similarity from firsts
  union all
  select m.id, coalesce(f.anchor, p.id), coalesce(f.similarity, 1.0::double)
  from s3 m join prof p on m.name = p.name and m.department = p.department and m.company = p.company
    and m.address = p.address and m.id > p.id
  left join firsts f on f.id = p.id)"""

OUTCOMES = """
outcomes as (
  select id as record_id, true as is_duplicate, a0 as duplicate_of_id, 'Exact Duplicate' as duplicate_type,
    'primary_key' as matched_on, 100.0::double as confidence from e0 where id > a0
  union all select id, true, a1, 'Partial Duplicate', 'email', 95.0 from e1 where id > a1
  union all select id, true, a2, 'Partial Duplicate', 'phone', 90.0 from e2 where id > a2
  union all select id, true, a3, 'Partial Duplicate', 'id_code', 95.0 from e3 where id > a3
  union all select id, true, anchor, 'Possible Duplicate', 'name', round_even(similarity * 100, 1)::double from possible
  union all select id, false, null, null, null, 0.0 from k
    where id not in (select id from e0 where id > a0) and id not in (select id from e1 where id > a1)
      and id not in (select id from e2 where id > a2) and id not in (select id from e3 where id > a3)
      and id not in (select id from possible))"""


def cascade(clean: str, select: str) -> str:
    return f"with recursive {clean},{KEY_TIERS},{PAIRS},{SETTLED},{OUTCOMES}\n{select}"


def tiers(clean: str, select: str) -> str:
    return f"with {clean},{KEY_TIERS}\n{select}"


def pairs_of(clean: str) -> str:
    return f"with {clean},{KEY_TIERS.replace('s3 as (select * from e3 where a3 is null or a3 = id)', 's3 as (select * from k)')},{PAIRS}\nselect i, j, similarity from pairs"


def fold(text: str, seed: int, step: str, reverse: bool = False) -> str:
    points = f"list_transform(string_split({text}, ''), lambda c: unicode(c)::bigint)"
    if reverse:
        points = f"list_reverse({points})"
    return (
        f"case when {text} = '' then {{empty}} else "
        f"list_reduce(list_prepend({seed}::bigint, {points}), lambda a, c: ({step}) % 4294967296) end"
    )


def polynomial(text: str) -> str:
    return fold(text, 0, "a * 31 + c", reverse=True).format(empty="0::bigint")


def djb2(text: str) -> str:
    return fold(text, 5381, "a * 33 + c").format(empty="0::bigint")


def fnv1a(text: str) -> str:
    return fold(text, 2166136261, "xor(a, c) * 16777619").format(empty="0::bigint")


HASHES = {"polynomial": polynomial, "djb2": djb2, "fnv1a": fnv1a}


def profile_columns(capacity: str) -> str:
    return f"""{capacity}::bigint as capacity, sum(chain)::bigint as num_elements,
  round_even(sum(chain)::double / {capacity}, 3)::double as load_factor,
  count(*)::bigint as occupied_buckets, ({capacity} - count(*))::bigint as empty_buckets,
  max(chain)::bigint as max_chain_length, round_even(sum(chain)::double / count(*), 2)::double as avg_chain_length_occupied,
  sum(inserts)::bigint as inserts, (sum(inserts) - count(*))::bigint as total_collisions"""


def profile_of(algorithm: str, capacity: int) -> str:
    return f"""select {profile_columns(str(capacity))}, '{algorithm}' as algorithm from (
  select bucket, count(*) as chain, sum(inserts) as inserts from (
    select key, ({HASHES[algorithm]('key')}) % {capacity} as bucket, count(*) as inserts from k where key <> '' group by key)
  group by bucket)"""


HEADERS = """h as (
  select p_partkey, [' ' || p_name || '-No. ', 'E-Mail', ' Contact  No ', p_brand, 'Org', 'Full Name', p_type || '_ID'][p_partkey % 7 + 1] as header
  from part),
f as (
  select p_partkey, regexp_replace(regexp_replace(lower(trim(header)), '[\\s-]+', '_', 'g'), '[^a-z0-9_]', '', 'g') as field from h)"""


def canonical_sql(fields: FieldMap) -> str:
    pairs = [(a, f) for f, names in fields.aliases.items() for a in [f, *names]]
    # Sanitised again here: lower case, words joined by underscores, other signs dropped.
    bare = [re.sub("[^a-z0-9_]", "", "_".join(re.split(r"[\s-]+", a.strip().lower()))) for a, _ in pairs]
    values = ", ".join(f"({n}, '{a}', '{f}')" for n, (a, (_, f)) in enumerate(zip(bare, pairs, strict=True)))
    return f"""with {HEADERS},
aliases as (select alias, max_by(field, n) as canonical from (values {values}) v(n, alias, field) group by alias)
select p_partkey, coalesce(canonical, field) as field from f left join aliases on alias = field"""


DOCUMENT_RECORDS = "select c_custkey as doc, '{kind}' as file_type, {line}::bigint as line_number, {fields} as fields from customer"

DAY = """case left(o_orderpriority, 1) when '1' then o_orderdate::date when '2' then o_orderdate::date
  when '3' then case when day(o_orderdate) <= 12 then make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) else o_orderdate::date end
  when '4' then o_orderdate::date end"""

RAW_RECORDS = """raw as (
  select 'customer.csv' as source_file, 'CSV' as file_type, c_custkey + 2 as line_number,
    'c_mktsegment=' || c_mktsegment || ';c_name=' || c_name as fields from customer
  union all
  select 'supplier.json', 'JSON', s_suppkey + 1, 's_name=' || s_name from supplier)"""

CLEAN_DOCUMENTS = f"d as (select *, {plain('text')} as clean from documents)"

CANONICAL_FIELDS = (("department", "department"), ("email", "email"), ("id_code", "id_code"), ("name", "name"), ("phone", "phone"))


def map_sql(pairs) -> str:
    return "concat_ws(';', " + ", ".join(f"'{k}=' || nullif({v}, '')" for k, v in pairs) + ")"


def original(x: str) -> str:
    return f"(case when {plain(x)} in ({quoted(*PLAIN_NULL_TOKENS)}) then '' else {plain(x)} end)"


_CUSTOMER_ORIGINALS = (
    ("Branch", "dep"), ("Customer Name", "raw_name"), ("E-mail", "raw_email"), ("Mobile No", "raw_phone"), ("Roll No", "raw_code"),
)
_SUPPLIER_ORIGINALS = (
    ("Contact-No", "raw_phone"), ("dept", "dep"), ("emp_id", "raw_code"), ("full_name", "raw_name"), ("mail_id", "raw_email"),
)


def normalized_sql(originals) -> str:
    pairs = [(k, f"c.{v}") for k, v in CANONICAL_FIELDS] + [(k, original(f"p.{v}")) for k, v in originals]
    return map_sql(sorted(pairs))


GROUPS = """g as (
  select duplicate_of_id as primary_id, min(record_id) as first_duplicate_id, count(*)::bigint + 1 as total_records,
    arg_min(duplicate_type, record_id) as duplicate_type, arg_min(matched_on, record_id) as matched_on,
    arg_min(confidence, record_id) as confidence
  from outcomes where is_duplicate group by duplicate_of_id)"""

MEMBERS = f""", {GROUPS},
ids as (select primary_id, row_number() over (order by first_duplicate_id) as group_id from g),
members as (
  select duplicate_of_id as primary_id, record_id from outcomes where is_duplicate
  union all select primary_id, primary_id from g)
select group_id, primary_id, row_number() over (partition by primary_id order by record_id <> primary_id, record_id) - 1 as position,
  record_id from members join ids using (primary_id)"""

SUMMARY_COLUMNS = """count(*)::bigint as total_records, count_if(not is_duplicate)::bigint as unique_records,
  count_if(is_duplicate)::bigint as duplicate_records,
  count_if(duplicate_type = 'Exact Duplicate')::bigint as exact_duplicates,
  count_if(duplicate_type = 'Partial Duplicate')::bigint as partial_duplicates,
  count_if(duplicate_type = 'Possible Duplicate')::bigint as possible_duplicates,
  count(distinct duplicate_of_id)::bigint as duplicate_groups_count,
  round_even(count_if(is_duplicate)::double / count(*) * 100, 1)::double as duplicate_percentage"""

TURNS = "t as (select conv_id * 1000 + turn as record_id, role, text from conversations)"

NAME_PAIRS = "n as (select p_partkey, p_name as a, lower(p_type || ' ' || p_brand) as b from part)"

MATCHED = """m as (
  select o.record_id, o.duplicate_type, a.name as an, b.name as bn, a.email as ae, b.email as be, a.phone as ap, b.phone as bp,
    a.department as ad, b.department as bd, a.id_code as ai, b.id_code as bi, a.key as key, o.matched_on, o.confidence
  from outcomes o join k a on a.id = o.record_id join k b on b.id = o.duplicate_of_id)"""


def matched_sql() -> str:
    parts = []
    for field, x in (("department", "d"), ("email", "e"), ("id_code", "i"), ("name", "n"), ("phone", "p")):
        a, b = f"a{x}", f"b{x}"
        parts.append(
            f"case when {a} <> '' and (duplicate_type = 'Exact Duplicate' or (duplicate_type = 'Partial Duplicate' and {a} = {b}) "
            f"or (duplicate_type = 'Possible Duplicate' and {b} <> '')) then '{field}' end"
        )
    return "concat_ws(',', " + ", ".join(parts) + ")"


EXPLANATION = """case duplicate_type
  when 'Exact Duplicate' then 'Exact match on normalized composite key: ''' || key || '''.'
  when 'Partial Duplicate' then 'Partial match: Identical ' || matched_on || ' (''' ||
    case matched_on when 'email' then ae when 'phone' then ap else ai end || ''') with varying schema attributes.'
  else 'Possible match: Name ''' || an || ''' is ' || confidence::varchar || '% similar to ''' || bn || '''' ||
    case when ad <> '' and ad = bd then ' in same department/organization' else '' end || '.' end"""

IDENTIFIER_ROWS = """ids as (
  select 'email' as key_type, 'email:' || email as key from s0 where email <> ''
  union all select 'phone', 'phone:' || phone from s1 where phone <> ''
  union all select 'id_code', 'id_code:' || id_code from s2 where id_code <> '')"""


def place(order: str, first_line: int) -> str:
    """File and line of a row that was written in order, 250 rows to a file."""
    row = f"row_number() over (order by {order}) - 1"
    return f"({row}) // 250 as part,\n  ({row}) % 250 + {first_line} as line_number"


ORACLES = {
    # sources
    "scan_csv": f"""select 'CSV' as file_type, {place('c_custkey', 2)},
  c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer""",
    "scan_csv_sniff": """select c_name as name, c_acctbal as acctbal, 5 as cells from customer
union all select s_name, s_acctbal, 4 from supplier""",
    "scan_tsv": f"""select 'TSV' as file_type, {place('s_suppkey', 2)},
  s_suppkey, s_name, s_nationkey, s_acctbal from supplier""",
    "scan_json": f"""select 'JSON' as file_type, {place('conv_id nulls first, turn nulls first, role nulls first, text nulls first', 1)},
  conv_id, turn, role, md5(text) as text_md5 from conversations""",
    "scan_files": f"""select 'CSV' as file_type, {place('s_suppkey', 2)},
  's_name=' || s_name || ';s_suppkey=' || s_suppkey as fields from supplier
union all select 'JSON', n_regionkey, row_number() over (partition by n_regionkey order by n_nationkey),
  'n_name=' || n_name || ';n_nationkey=' || n_nationkey || ';n_regionkey=' || n_regionkey from nation""",
    "scan_files_reports": f"""select part, 'csv' as extension, count(*) as record_count, 'success' as status, null as error
from (select {place('s_suppkey', 2)} from supplier) group by part
union all select n_regionkey, 'json', count(*), 'success', null from nation group by n_regionkey
union all select r_regionkey, 'parquet', 0, 'error',
  'Unsupported file extension ''.parquet''. Supported: CSV, TSV, XLSX, XLS, JSON, JSONL, PDF, DOCX, TXT.' from region""",
    "scan_jsonl": f"""select 'JSONL' as file_type, {place('event_id, props', 1)},
  (select string_agg(k || '=' || json_extract_string(props, '$."' || k || '"'), ';' order by k) from (select unnest(json_keys(props)) as k)) as fields
from events""",
    "text_cards": f"""{DOCUMENT_RECORDS.format(kind='TXT', line='5', fields="'Name=' || c_name || ';Segment=' || c_mktsegment")}
union all {DOCUMENT_RECORDS.format(kind='TXT', line='6', fields="'NAME=second of ' || c_name")}""",
    "text_delimited": f"""{DOCUMENT_RECORDS.format(kind='TXT', line='2',
        fields="'col_3=extra;key=' || c_custkey || ';name=' || c_name || ';segment=' || c_mktsegment")}
union all {DOCUMENT_RECORDS.format(kind='TXT', line='4', fields="'key=' || c_nationkey")}""",
    "report_rows": DOCUMENT_RECORDS.format(
        kind="PDF", line="2", fields="'field_1=' || c_custkey || ';field_3=' || c_name || ';field_4=' || c_mktsegment"
    ),
    "paragraph_cards": f"""{DOCUMENT_RECORDS.format(kind='Word (.docx)', line='3', fields="'Name=' || c_name")}
union all {DOCUMENT_RECORDS.format(kind='Word (.docx)', line='5', fields="'Segment=' || c_mktsegment")}
union all {DOCUMENT_RECORDS.format(kind='Word (.docx)', line='5', fields="'segment=other'")}""",
    "grid_records": """select l_orderkey as doc, 'Excel (.xlsx)' as file_type,
  l_linenumber::bigint + 1 as line_number,
  'col_2=;col_3=' || l_returnflag || ';part=' || l_partkey || ';supplier=' || l_suppkey as fields from lineitem""",
    "decode_fallback": "select doc_id, md5(text) as text_md5 from documents",
    "detect_format": """select page_id, case when not regexp_matches(url, '^https?://[^#?]*/$') and not regexp_matches(url, '^https?://[^#?]*/[#?]')
    then ['CSV', 'JSON', 'JSONL', null, 'Word (.docx)'][page_id % 5 + 1] end as format,
  case lower(regexp_extract(regexp_extract(url, '([^/]*)$', 1), '[^.].*(\\.[^.]*)$', 1)) when '.csv' then 'CSV'
    when '.tsv' then 'TSV' when '.json' then 'JSON' when '.jsonl' then 'JSONL' when '.ndjson' then 'JSONL'
    when '.xlsx' then 'Excel' when '.xls' then 'Excel' when '.pdf' then 'PDF' when '.docx' then 'Word (.docx)'
    when '.txt' then 'Plain Text' end as url_format from pages""",
    "union_sources": f"""with {RAW_RECORDS}
select row_number() over (order by source_file, line_number)::bigint as record_id, source_file, file_type, line_number, fields from raw""",
    "file_reports": """with f as (
  select n_nationkey, n_name || ['.CSV', '.json', '.ndjson', '.xyz', '.docx'][n_regionkey + 1] as filename,
    n_regionkey = 3 as unsupported from nation),
n as (select filename, unsupported, count(s_suppkey) as n from f left join supplier on s_nationkey = n_nationkey group by all)
select filename, case when unsupported then 0 else n end::bigint as record_count,
  case when unsupported or n = 0 then 'error' else 'success' end as status,
  case when unsupported then 'Unsupported file extension ''.xyz''. Supported: CSV, TSV, XLSX, XLS, JSON, JSONL, PDF, DOCX, TXT.'
    when n = 0 then 'No records could be extracted from ''' || filename || '''. The file may be empty or unformatted.' end as error
from n""",
    "outcomes_json": cascade(
        CLEAN_PEOPLE,
        """select to_json({'record_id': record_id, 'is_duplicate': is_duplicate, 'duplicate_of_id': duplicate_of_id,
  'duplicate_type': duplicate_type, 'matched_on': matched_on, 'confidence': confidence})::varchar as document from outcomes""",
    ),
    # schema mapping
    "sanitize_field": f"with {HEADERS} select p_partkey, field from f",
    "canonical_field": canonical_sql(FieldMap()),
    "custom_aliases": canonical_sql(FieldMap({"company": ["ECONOMY id"], "Brand": ["Brand#1", "Brand#2", "org"]})),
    "fuse_aliases": """select o_orderkey,
  'phone=' || v || ';total=' || o_orderstatus as fused,
  concat_ws(';', 'phone=' || nullif(case when v = 'N/A' then '' else regexp_replace(v, '\\D', '', 'g') end, ''),
    'total=' || lower(o_orderstatus)) as canonical
from (select *, case o_orderstatus when 'F' then o_orderpriority when 'O' then 'N/A' else cast(o_custkey as varchar) end as v from orders)""",
    "record_summary": """select c_custkey, 'c_name: ' || c_name || ' | c_nationkey: ' || c_nationkey || ' | c_mktsegment: ' || c_mktsegment
  || ' | c_custkey: ' || c_custkey as summary from customer""",
    # cleaning
    "normalize_string": f"select doc_id, md5({plain('text')}) as clean_md5 from documents",
    "normalize_name": f"with {PEOPLE} select id, {name('raw_name')} as name from people",
    "normalize_email": f"with {PEOPLE} select id, {email('raw_email')} as email from people",
    "normalize_phone": f"with {PEOPLE} select id, {phone('raw_phone')} as phone from people",
    "normalize_number": f"with {PEOPLE} select id, {number('raw_code')} as id_code from people",
    "normalize_date": f"""select o_orderkey, coalesce(strftime({DAY}, '%Y-%m-%d'), 'undated') as day from orders""",
    "null_tokens": """select c_custkey, case when c_mktsegment = 'BUILDING' then c_name when c_custkey % 8 = 7 then 'nano' else '' end as value
from customer""",
    "dispatch_clean": f"""with {CLEAN_PEOPLE}
select id, 'name' as field, name as clean from c union all select id, 'email', email from c
union all select id, 'Phone', phone from c union all select id, 'id_code', id_code from c
union all select id, 'department', department from c""",
    "normalize_records": f"""with {CLEAN_PEOPLE}
select c.id as record_id, {map_sql([(k, 'c.' + v) for k, v in CANONICAL_FIELDS])} as canonical,
  case when p.src = 'customer' then {normalized_sql(_CUSTOMER_ORIGINALS)} else {normalized_sql(_SUPPLIER_ORIGINALS)} end as normalized,
  k.key as primary_key
from c join k on k.id = c.id join people p on p.id = c.id""",
    "levenshtein": f"with {NAME_PAIRS} select p_partkey, levenshtein(a, b)::bigint as distance from n",
    "similarity_ratio": f"""with {NAME_PAIRS}
select p_partkey, greatest(0.0::double, 1.0::double - levenshtein(a, b)::double / greatest(length(a), length(b))::double) as ratio from n""",
    # keys
    "primary_key": f"with {CLEAN_PEOPLE} select id as record_id, key as primary_key from k",
    "secondary_keys": f"""with {CLEAN_PEOPLE}
select id as record_id, 'email' as key_type, 'email:' || email as key from c where email <> ''
union all select id, 'phone', 'phone:' || phone from c where phone <> ''
union all select id, 'id_code', 'id_code:' || id_code from c where id_code <> ''
union all select id, 'name_dept', 'name:' || name || '|dept:' || department from c where name <> '' and department <> ''""",
    "hash_polynomial": f"select doc_id, {polynomial('text')} as hash from documents",
    "hash_djb2": f"select doc_id, {djb2('text')} as hash from documents",
    "hash_fnv1a": f"select doc_id, {fnv1a('text')} as hash from documents",
    "bucket_id": f"""with {CLEAN_PEOPLE}
select id as record_id, ({polynomial('key')}) % 101 as polynomial, ({djb2('key')}) % 101 as djb2, ({fnv1a('key')}) % 101 as fnv1a,
  ({polynomial('key')}) % 101 as fallback from k""",
    # matching
    "match_exact": f"""with {CLEAN_DOCUMENTS}
select id, first_id from (select doc_id as id, clean, min(doc_id) over (partition by clean) as first_id from d where clean <> '')
where id > first_id""",
    "distinct_first": f"""with {CLEAN_DOCUMENTS}
select doc_id, lang, source, n_chars from (select *, min(doc_id) over (partition by clean) as first_id from d)
where clean = '' or doc_id = first_id""",
    "match_email": tiers(CLEAN_PEOPLE, "select id as record_id, a1 as duplicate_of_id, 95.0::double as confidence from e1 where id > a1"),
    "match_phone": tiers(CLEAN_PEOPLE, "select id as record_id, a2 as duplicate_of_id, 90.0::double as confidence from e2 where id > a2"),
    "match_id_code": tiers(CLEAN_PEOPLE, "select id as record_id, a3 as duplicate_of_id, 95.0::double as confidence from e3 where id > a3"),
    "matched_fields": cascade(CLEAN_PEOPLE, f", {MATCHED} select record_id, {matched_sql()} as matched_fields from m"),
    "explanations": cascade(CLEAN_PEOPLE, f", {MATCHED} select record_id, {EXPLANATION} as explanation from m"),
    "possible_pairs": pairs_of(CLEAN_PEOPLE),
    "possible_pairs_parts": pairs_of(CLEAN_PARTS),
    "match_possible": f"""with recursive {CLEAN_PARTS}, s3 as (select * from k),{PAIRS},{SETTLED}
select id, anchor, round_even(similarity * 100, 1)::double as confidence from possible""",
    "detect": cascade(CLEAN_PEOPLE, "select * from outcomes"),
    "detect_without_code": cascade(CLEAN_WITHOUT_CODE, "select * from outcomes"),
    "detect_parts": cascade(CLEAN_PARTS, "select * from outcomes"),
    "key_lookup": f"""with {CLEAN_PEOPLE}
select p.id as record_id, min(m.id) as found_id from c p left join c m on m.email = p.email and m.email <> '' and m.id < 1000000000
where p.id >= 1000000000 group by p.id""",
    "incremental_match": f"""with {CLEAN_PEOPLE},
p as (select id, case when email <> '' then 'email:' || email end as key from c),
m as (select key, min(id) as found from p where id < 1000000000 and key is not null group by key),
n as (select id, key from p where id >= 1000000000 union all select id + 1000000000, key from p where id >= 1000000000),
b as (select n.id, n.key, m.found, min(n.id) over (partition by n.key) as f from n left join m on m.key = n.key)
select id as record_id, case when found is not null or (key is not null and id <> f) then 'hit' else 'fresh' end as result,
  case when found is not null then found when key is not null and id <> f then f end as found_id from b""",
    # groups
    "groups": cascade(CLEAN_SPARSE, MEMBERS),
    "groups_salted": cascade(CLEAN_SPARSE, MEMBERS),
    "detect_salted": cascade(CLEAN_PEOPLE, "select * from outcomes"),
    "group_attrs": cascade(CLEAN_PEOPLE, f", {GROUPS} select * from g"),
    "group_ids": cascade(
        CLEAN_PEOPLE,
        f", {GROUPS} select row_number() over (order by first_duplicate_id)::bigint as group_id, primary_id, first_duplicate_id from g",
    ),
    "masters": cascade(CLEAN_PEOPLE, "select record_id from outcomes where not is_duplicate"),
    "run_report": cascade(
        CLEAN_PEOPLE, f"select {SUMMARY_COLUMNS}, 2::bigint as total_files_analyzed, 2::bigint as failed_files from outcomes"
    ),
    "summary": cascade(CLEAN_PEOPLE, f"select {SUMMARY_COLUMNS} from outcomes"),
    "bucket_profile": f"with {CLEAN_PEOPLE} " + " union all ".join(profile_of(a, 401) for a in HASHES),
    "bucket_collisions": f"""with {CLEAN_PEOPLE},
b as (select ({fnv1a('key')}) % 101 as bucket, count(*) as n from k where key <> '' group by 1)
select sum(n)::bigint as inserts, count(*)::bigint as occupied_buckets, (sum(n) - count(*))::bigint as total_collisions from b""",
    "bucket_members": f"""with {CLEAN_PEOPLE},
first_of as (select key, min(id) as record_id from k where key <> '' group by key),
b as (select ({djb2('f.key')}) % 401 as bucket_index, f.record_id, k.src as source_file,
    left(f.key, 45) || case when length(f.key) > 45 then '...' else '' end as key_excerpt, 3::bigint as shown_fields
  from first_of f join k on k.id = f.record_id),
listed as (select range as bucket_index from range(50))
select l.bucket_index, count(b.record_id) over (partition by l.bucket_index)::bigint as chain_length,
  b.record_id is null as is_empty, b.record_id, b.source_file, b.key_excerpt, b.shown_fields
from listed l left join b on b.bucket_index = l.bucket_index""",
    "identifier_profile": tiers(
        CLEAN_PEOPLE,
        f""", {IDENTIFIER_ROWS}
select key_type, {profile_columns('53')} from (
  select key_type, bucket, count(*) as chain, sum(inserts) as inserts from (
    select key_type, key, ({polynomial('key')}) % 53 as bucket, count(*) as inserts from ids group by 1, 2)
  group by 1, 2) group by key_type""",
    ),
    "match_rates": cascade(
        CLEAN_PEOPLE,
        f"""select count(*)::bigint as total_records, count_if(is_duplicate)::bigint as duplicate_records,
  round_even(count(*)::double / 101, 3)::double as load_factor,
  round_even((select total_collisions from ({profile_of('polynomial', 101)}))::double / count(*) * 100, 2)::double as collision_rate_percent
from outcomes""",
    ),
    # views
    "filter_status": cascade(
        CLEAN_PEOPLE,
        """select record_id, 'all' as status from outcomes union all select record_id, 'duplicate' from outcomes where is_duplicate
union all select record_id, 'unique' from outcomes where not is_duplicate""",
    ),
    "search_records": f"with {TURNS} select record_id from t where contains(lower(role), 'nicht') or contains(lower(text), 'nicht') or contains('role:' || role, 'nicht')",
    "page_records": f"""with {TURNS}
select record_id, 'role:' || role as primary_key from t order by record_id limit 20 offset 40""",
    "page_info": f"""with {TURNS}
select count(*)::bigint as total_count, 3::bigint as page, 20::bigint as per_page, ceil(count(*) / 20.0)::bigint as total_pages from t""",
    "get_record": f"with {TURNS} select record_id, 'role:' || role as primary_key from t where record_id = 3001",
    "search_groups": cascade(
        CLEAN_PEOPLE,
        f""", {GROUPS},
n as (select *, row_number() over (order by first_duplicate_id)::bigint as group_id from g),
h as (select id from people where contains(lower(concat_ws(' ', raw_name, raw_email, raw_phone, dep, raw_code)), 'household')),
w as (select id from h union select duplicate_of_id from outcomes join h on id = record_id where is_duplicate)
select group_id, primary_id, total_records from n where primary_id in (select id from w)""",
    ),
}
