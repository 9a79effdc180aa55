"""A corpus cleaning run: every stage takes the documents that the one before kept.

The stages, in order: toxic documents go; repeated runs of lines are cut out; of linked near
copies one document stays; documents with benchmark passages go; what is left is encoded.
Each stage's result is written as Parquet and read again before the next.

All stages keep rows with a null id, a null or an empty text, rows that repeat and texts of any length (the classifier learns from none
of over 100,000 characters, but scores it whole); an empty table stays empty; extra columns come through all stages but the last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fundpanel.llm import decontaminate, linedup, partenum, piecebpe, toxicity
from fundpanel.llm.registry import model_path
from fundpanel.llm.sparkops import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier, trained on the labelled ones among them, doesn't take for toxic; without labels of both classes all."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs of two lines or more and of single lines that are passages; those of which nothing is left go."""
    return linedup.without_later_lines(docs, length_col="n_chars", min_lines=2)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles at 0.75, the one with the smallest id; rows are judged by their texts."""
    return partenum.one_of_each(docs, words=5, percent=75)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; all of them if that is empty."""
    return decontaminate.keep_unleaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and digests of ids and of the decoded text; a null text has no ids."""
    # the workers hold what the stages before left, so they remember fewer parts
    return piecebpe.encode_texts(docs, model_path(), with_ids=False, digests=True, memory=60_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaked),
    ("SentencePiece encoding and decoding", encode),
]

#: Classifier and tokenizer are beyond SQL; the tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents: one row (doc_id, n_tokens, ids_sha256, decoded_sha256) for each that is kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        if i:
            path = f"{shared_dir(spark)}/stage{i}-{uuid.uuid4().hex}"
            docs.write.option("compression", "zstd").parquet(path)
            docs = spark.read.parquet(path)
        docs = stage(spark, docs, sf_dir)
    return docs
