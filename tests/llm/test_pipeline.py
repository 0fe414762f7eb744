import re
from pathlib import Path

import corpus_pipeline as P
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from rowkin.llm import group_jaccard, kk_packing, pii_anchors, rank_language, rows
from rowkin.llm.queries import ORACLES, QUERIES, table
from tests.llm.brute import jaccard_components

SMALL = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = table(spark, SMALL, "documents")
    extra = spark.createDataFrame([(100_001, None, "en", None, None), (100_002, "12 34", None, "src0", 5)], docs.schema)
    docs = docs.unionByName(extra).cache()
    columns = docs.columns

    kept = P.keep_known_languages(spark, docs, SMALL).cache()
    assert kept.columns == columns
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in kept.collect()}
    assert gone == {100_001, 100_002}

    one = P.keep_one_of_near_copies(spark, kept, SMALL).cache()
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    expected = {c if n else i for i, n, c in jaccard_components(rows)}
    assert one.columns == columns and sorted(r["doc_id"] for r in one.collect()) == sorted(expected)

    masked = P.mask_personal_data(spark, one, SMALL).cache()
    before = {r["doc_id"]: r["text"] for r in one.collect()}
    after = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert masked.columns == columns
    assert after == {i: pii_anchors.masked(t, pii_anchors.find(t)) for i, t in before.items()}
    assert not any(s[0] == "email" for t in after.values() for s in pii_anchors.find(t))

    mixed = P.mix_sources(spark, masked, SMALL).cache()
    words = sum(len(t.split()) for t in after.values())
    assert mixed.columns == columns
    assert abs(sum(len(r["text"].split()) for r in mixed.collect()) - 1.5 * words) < 20

    packed = P.pack_windows(spark, mixed, SMALL).collect()
    encoder = kk_packing._encoder(public_tokenizers.path(P.TOKENIZER))
    tokens = sum(len(encoder.ids(r["text"])) // 4 + 1 for r in mixed.collect())
    assert sum(r["length"] for r in packed) == tokens


def test_run_and_registration(spark):
    rows = P.run(spark, SMALL)
    assert rows.count() > 0 and "ids" in rows.columns
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) == 13
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}


def test_stages_survive_an_empty_table(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in P.STAGES:
        out = stage(spark, docs, SMALL)
        assert out.collect() == []
        docs = out if out.columns == docs.columns else docs


def test_repeated_rows(spark):
    docs = table(spark, SMALL, "documents")
    twice = docs.unionByName(docs.limit(5))
    assert P.keep_one_of_near_copies(spark, twice, SMALL).count() == P.keep_one_of_near_copies(spark, docs, SMALL).count()


def test_near_copies_by_five_words_and_four_fifths(spark):
    def text(name, n):
        return [f"{name}{i}" for i in range(n)]

    edited = [f"new{i}" if i % 46 == 20 else w for i, w in enumerate(text("b", 460))]
    made = [
        (1, text("a", 1000)), (2, text("a", 1200)),  # 0.83: 200 words appended
        (3, text("b", 460)), (4, edited),  # 0.80 on five words, 0.84 on four: 10 words edited
        (5, text("c", 1000)), (6, text("c", 1300)),  # 0.77
    ]
    docs = spark.createDataFrame([(i, " ".join(t), "en", "src0", 0) for i, t in made], table(spark, SMALL, "documents").schema)
    both = docs.unionByName(table(spark, SMALL, "documents").withColumn("doc_id", F.col("doc_id") + 1000)).cache()
    kept = {r["doc_id"] for r in P.keep_one_of_near_copies(spark, both, SMALL).collect()}
    rows = [(r["doc_id"], r["text"]) for r in both.collect()]
    assert kept & {1, 2, 3, 4, 5, 6} == {1, 3, 5, 6}
    assert kept == {c if n else i for i, n, c in jaccard_components(rows, 5, 80)}


def test_tables_of_other_files_and_clashing_columns(spark, tmp_path):
    docs = table(spark, SMALL, "documents")
    expected = sorted(r["doc_id"] for r in P.keep_one_of_near_copies(spark, docs, SMALL).collect())
    extra = docs.withColumn("_metadata", F.lit("mine")).withColumn("key", F.lit(1)).withColumn("doc", F.lit("d"))
    extra = extra.withColumn("node", F.lit(2)).withColumn("position", F.lit("p"))
    for kind in ("parquet", "json", "orc", "csv"):
        path = str(tmp_path / kind)
        writer, reader = extra.write, spark.read.schema(extra.schema)
        if kind == "csv":
            writer, reader = (x.options(multiLine=True, quoteAll=True, escape='"', lineSep="\n") for x in (writer, reader))
        writer.format(kind).save(path)
        read = reader.format(kind).load(path)
        one = P.keep_one_of_near_copies(spark, read, SMALL)
        assert one.columns == extra.columns
        kept = one.collect()
        assert {r["_metadata"] for r in kept} == {"mine"}
        if kind != "csv":  # CSV has its own rules for line ends and empty texts
            assert sorted(r["doc_id"] for r in kept) == expected
        mixed = P.mix_sources(spark, read, SMALL)
        assert mixed.columns == extra.columns and {r["position"] for r in mixed.collect()} == {"p"}


def test_all_stages_keep_clashing_columns(spark):
    docs = table(spark, SMALL, "documents").limit(60)
    for name in ("_metadata", "_row", "_text", "lang_pred", "score", "masked", "spans", "n_email", "key", "doc", "label", "size"):
        docs = docs.withColumn(name, F.lit("x"))
    columns = docs.columns
    for name, stage in P.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() > 0
        if name != "packing":
            assert docs.columns == columns and {r[0] for r in docs.select("score").distinct().collect()} == {"x"}


def test_a_text_crosses_to_python_once_and_comes_back_in_parts(spark):
    """Before, a text went to Python twice and all texts of a batch came back together."""
    def crossing(df):
        node = df._jdf.queryExecution().optimizedPlan()
        while node.nodeName() != "MapInArrow":
            node = node.children().apply(0)
        return [sum(out.apply(k).dataType().simpleString() == "string" for k in range(out.size())) for out in (node.children().apply(0).output(), node.output())]

    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    profiles = {"en": [97, 98]}
    assert crossing(rank_language.identified(docs, profiles)) == [1, 2]  # back: text, lang_pred
    assert crossing(rank_language.identify(docs, profiles)) == [1, 1]
    assert crossing(pii_anchors.redacted(docs)) == [1, 3]  # back: masked text, base_sha256, spans
    assert crossing(pii_anchors.detected(docs)) == [1, 2]
    assert [p.num_rows for p in rows.parts(iter([pa.record_batch({"a": [0] * 2500}), pa.record_batch({"a": [0] * 3})]))] == [1000, 1000, 500, 3]


def test_texts_that_are_no_strings_are_judged_as_strings(spark):
    docs = spark.createDataFrame([(1, 4111111111111111), (2, None), (3, 7)], "doc_id long, text long")
    assert sorted(tuple(r) for r in pii_anchors.redacted(docs).collect()) == [(1, "[CARD]"), (2, None), (3, "7")]
    assert sorted((r["doc_id"], r["n_card"]) for r in pii_anchors.detected(docs).collect()) == [(1, 1), (2, 0), (3, 0)]
    found = rank_language.identified(docs, {"en": [97]}).collect()
    assert sorted((r["_row"]["doc_id"], r["_row"]["text"] or 0, r["lang_pred"]) for r in found) == [(1, 4111111111111111, "und"), (2, 0, "und"), (3, 7, "und")]


def test_written_tables_are_read_without_vectored_reads(spark, monkeypatch):
    """Their buffers stay with every thread that read a file: before, they grew an executor beyond its memory."""
    key = "parquet.hadoop.vectored.io.enabled"
    seen = []
    collapsed = group_jaccard._collapsed
    monkeypatch.setattr(group_jaccard, "_collapsed", lambda words: seen.append(spark.conf.get(key, None)) or collapsed(words))
    docs = table(spark, SMALL, "documents")
    before = spark.conf.get(key, None)
    found = group_jaccard.joined(docs)
    assert found._jdf.queryExecution().analyzed().relation().options().apply(key) == "false"
    assert seen == ["false"] and spark.conf.get(key, None) == before
    with rows.plain_reads(spark):
        assert spark._jsparkSession.sessionState().newHadoopConf().get(key) == "false"


def test_results_of_stages_run_in_small_batches(spark):
    """Before, the default of 10,000 rows held for stages whose results run later, and executors kept what that took."""
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch", "parquet.hadoop.vectored.io.enabled"]
    docs = table(spark, SMALL, "documents")
    before = {name: spark.conf.get(name, None) for name in names}
    for _, stage in P.STAGES:
        for name in names:
            spark.conf.unset(name)
        stage(spark, docs, SMALL)
        assert [spark.conf.get(name) for name in names] == ["1000", str(4 << 20), "false"]
        sizes = spark.range(2500).coalesce(1).mapInArrow(lambda batches: (pa.record_batch({"n": [b.num_rows]}) for b in batches), "n long")
        assert max(r["n"] for r in sizes.collect()) <= 1000
    spark.conf.set(names[0], "100")
    rows.lean(spark)
    assert spark.conf.get(names[0]) == "100"  # smaller ones of the session stay
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_memory_that_a_task_freed_is_released():
    """Before, a worker kept it: some 40 MB after the tasks of the join."""
    def held():
        return int(re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) // 1024

    def run(batches):
        kept = []
        for k in range(200_000):
            kept.append(bytearray(600))
            if k % 1000 == 0:
                kept.append(bytes(10))
        pinned.append(bytearray(600))  # on top of all, so that nothing below goes back by itself
        yield from batches

    for whole in (run, rows.releasing(run)):
        pinned = []
        start = held()
        assert len(list(whole(iter([pa.record_batch({"a": [1]})])))) == 1
        grown = held() - start
    assert grown < 40
