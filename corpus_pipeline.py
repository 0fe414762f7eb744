"""A pipeline over ``documents``: stages that each call one operator of ``rowkin.llm``.

Every stage gets what the one before kept, as ``docs``, and all but the last return the columns of
``documents``.  ``run`` writes each stage's result to the shared folder and reads it back for the next.

Results run after the stage that made them, so every stage sets the session for whole texts (``lean``): small Arrow
batches and plain reads.  These stay set; no result depends on them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowkin.llm import curriculum, group_jaccard, kk_packing, pii_anchors, rank_language
from rowkin.llm.rows import lean
from rowkin.scratch import write_out

TOKENIZER = "byte_bpe_50k.json"
#: Texts that are less near to every language than this are rejected: they are in none of them.
LEAST_LANGUAGE_SCORE = 0.3
#: The near-duplicate stage: word n-grams of this length, and this similarity or more.  op7_jaccard has its own contract.
NEAR_WORDS = 5
NEAR_PERCENT = 80


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID, learned from the documents' own labels: texts without a letter, and texts that are
    near to no language, go."""
    lean(spark)
    profiles = rank_language.learn(docs)
    found = rank_language.identified(docs, profiles)
    kept = (F.col("lang_pred") != rank_language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return found.where(kept).select("_row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each component stays, the one with the smallest doc_id."""
    lean(spark)
    return group_jaccard.one_of_each(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: every span is replaced by the mask of its kind."""
    lean(spark)
    return pii_anchors.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: the documents as often, and as far, as their source's target takes them, in training order."""
    lean(spark)
    return curriculum.mixed(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: a row per piece, with its token ids."""
    lean(spark)
    return kk_packing.pack(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [
    ("language ID", keep_known_languages),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("PII", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Language distances, matching of spans and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = write_out(docs, f"stage-{k}")
    return docs
