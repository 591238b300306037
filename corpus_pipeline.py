"""A corpus pipeline: documents in, clean and tokenised documents out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in the shared
folder and read again as the next stage's documents.  All stages but the last keep the columns of
``documents``; a stage that changes a text also updates ``n_chars``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import bpe_codec, decontaminate, minhash_forest, rule_classifier, suffix_dedup
from panelcast.llm.common import saved, table


#: Near duplicates share this percentage of their 5-word shingles; a repeated passage has this many bytes
#: (a passage of 50 words has 155 or more in the given tables).
SIMILAR, PASSAGE = 80, 160


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble takes for bad go."""
    return rule_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return minhash_forest.keep_one(docs, SIMILAR)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``PASSAGE`` bytes or more that occur more than once are cut out of the texts."""
    out = suffix_dedup.deduplicated(docs, PASSAGE)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the text decoded from them."""
    return bpe_codec.round_trip(docs, bpe_codec.vocabulary_path(), keep=["doc_id", "lang", "source", "n_chars"], ids="ids")


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", tokens),
]

#: No SQL expresses the learnt classifier; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; the result of the last stage is returned as it is."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = saved(docs, f"stage{i + 1}")
    return docs
