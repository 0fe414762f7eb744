"""One query per operator over its whole table, with production parameters, and the SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowkin.llm import (
    curriculum,
    group_jaccard,
    impact_topk,
    kk_packing,
    multi_index,
    nnpu_toxicity,
    periodic_runs,
    pii_anchors,
    prefix_trie,
    quality_rules,
    rank_language,
    suffix_dedup,
    url_logistic,
)

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "fail_bits", "base_failed", "kept"
    )


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii_anchors.detected(table(spark, folder, "documents"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return kk_packing.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, folder, "documents"))


def op5_curriculum(spark: SparkSession, folder: str) -> DataFrame:
    placed = curriculum.with_positions(curriculum.plan(table(spark, folder, "documents")))
    # Documents that are not taken have no position: the further columns spread them.
    order = ("position_1", "source", "start")
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("doc_id", "size", "source_size", "target", "taken", "position_1", "position_2")


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    profiles = rank_language.learn(docs.where(fold("doc_id", 4) != 2))
    found = rank_language.identify(docs, profiles)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op7_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return group_jaccard.joined(table(spark, folder, "documents"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    model = url_logistic.train(url_logistic.labelled_table(spark))
    return url_logistic.judged(table(spark, folder, "pages"), model)


def op9_topk(spark: SparkSession, folder: str) -> DataFrame:
    return impact_topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = nnpu_toxicity.train(docs, table(spark, folder, "labels"), allowed=fold("id", 5) != 0)
    found = nnpu_toxicity.scored(docs, model)
    return found.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= nnpu_toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.found_runs(table(spark, folder, "documents"))


def op12_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_pii": op2_pii,
    "op3_packing": op3_packing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_curriculum": op5_curriculum,
    "op6_language": op6_language,
    "op7_jaccard": op7_jaccard,
    "op8_url_filter": op8_url_filter,
    "op9_topk": op9_topk,
    "op10_toxicity": op10_toxicity,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_multi_index": op12_multi_index,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op1_quality_rules": r"""
with d as (
    select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents
),
w as (select rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from d),
words as (select rid, unnest(ws) as w, generate_subscripts(ws, 1) as i from w),
win as (
    select rid, i, w || ' ' || lead(w, 1) over o || ' ' || lead(w, 2) over o as g
    from words window o as (partition by rid order by i)
),
twice as (
    select rid, i from (select rid, i, count(*) over (partition by rid, g) as c from win where g is not null) where c > 1
),
covered as (
    select rid, count(distinct i + k) as n from twice, (select unnest([0, 1, 2]) as k) group by rid
),
lines as (
    select rid, count(*) as n, count(*) - count(distinct l) as dup
    from (select rid, unnest(string_split(t, chr(10))) as l from d)
    where regexp_matches(l, '[^\x20\x09-\x0D]') group by rid
),
m as (
    select d.doc_id, len(w.ws) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
           length(t) - length(replace(t, '!', '')) as n_exclaims,
           coalesce(lines.n, 0) as n_lines, coalesce(lines.dup, 0) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words
    from d join w using (rid) left join lines using (rid) left join covered using (rid)
),
f as (
    select *,
           (case when n_words < 50 then 1 else 0 end)
           + (case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end)
           + (case when 10 * n_symbols > n_words then 4 else 0 end)
           + (case when 100 * n_dup_lines > 60 * n_lines then 8 else 0 end)
           + (case when word_chars < 2 * n_words then 16 else 0 end)
           + (case when word_chars > 20 * n_words then 32 else 0 end)
           + (case when 10 * n_exclaims > 5 * n_words then 64 else 0 end) as bits
    from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bits::bigint as fail_bits,
       (bits & 3) <> 0 as base_failed, bits = 0 as kept
from f
""",
    "op5_curriculum": r"""
with d as (
    select row_number() over () as rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size
    from documents
),
s as (
    select source, sum(size)::bigint as n,
           [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as w,
           [0.5::double, 0.0::double, -0.5::double][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as tilt
    from d group by source
),
steps as (select 0.0::double as r union select distinct 2.0::double * n / w from s),
levels as (
    select r, ((select sum(n) from s) * 150 - 100 * coalesce(sum(2 * n) filter (2 * n <= w * r), 0))::double
              / (100 * sum(w) filter (2 * n > w * r))::double as lev
    from steps, s group by r
),
level as (
    select lev from levels l
    where not exists (select 1 from s where 2 * n > w * l.r and 2 * n <= w * l.lev) and lev is not null
    order by r limit 1
),
t as (select source, tilt, n as source_size, least(2.0::double * n, w * coalesce((select lev from level), 0.0)::double) as target from s),
p as (
    select d.doc_id, d.size, t.source_size, t.target, t.tilt, round(t.target)::bigint as goal,
           coalesce(sum(d.size) over (partition by d.source order by md5('mix-1:' || d.doc_id::varchar), d.doc_id, d.size, d.rid
                                      rows between unbounded preceding and 1 preceding), 0)::bigint as start
    from d join t on d.source is not distinct from t.source
),
e as (
    select *, greatest(0, least(size, goal - start)) as first, greatest(0, least(size, goal - start - source_size)) as second,
           least(1.0::double, start::double / greatest(target, 1.0::double)) as x1,
           least(1.0::double, (start + source_size)::double / greatest(target, 1.0::double)) as x2
    from p
)
select doc_id, size::bigint as size, source_size, target, (first + second)::bigint as taken,
       case when first > 0 then case when tilt = 0 then x1
            else (sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * x1) - (1 - tilt)) / (2 * tilt) end end as position_1,
       case when second > 0 then case when tilt = 0 then x2
            else (sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * x2) - (1 - tilt)) / (2 * tilt) end end as position_2
from e
""",
    "op9_topk": r"""
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q from embeddings
    where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
    select a.vec_id as query_id, b.vec_id, list_inner_product(a.q::double[], b.q::double[])::bigint as score
    from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 5
""",
}
