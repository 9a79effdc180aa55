"""The queries of the text operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, chat, decontaminate, linedup, media, oracles, partenum, periodic, piecebpe, pii, secretscan, substrings, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def model_path(name: str = "piece_bpe_32k.model") -> str:
    """A public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_join(_table(spark, sf_dir, "documents"), words=5, percent=75).select("doc_id", "n_shingles", "component_id", "n_links")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan(_table(spark, sf_dir, "documents"))


def op3_pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(_table(spark, sf_dir, "documents"), window=50)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("leaks") > 0).alias("leaked"), F.size("leaks").cast("long").alias("n_items"), F.transform("leaks", lambda x: x["item_id"]).alias("item_ids"), F.coalesce(F.array_max(F.transform("leaks", lambda x: x["equal"])), F.lit(0)).alias("most_equal"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = linedup.dedup_lines(_table(spark, sf_dir, "documents"), min_lines=2)
    return done.select("doc_id", "n_lines", "n_deleted", "runs", F.sha2("text", 256).alias("kept_sha256"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecebpe.encode_texts(_table(spark, sf_dir, "documents"), model_path(), with_ids=False, digests=True)


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.texts_as_media(_table(spark, sf_dir, "documents"))


def op11_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.read_back(chat.format_chats(turns, model_path(), budget=1024, history=256), turns)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.score_links(_table(spark, sf_dir, "documents"), model_path("byte_bpe_50k.json"), model_path())


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    own = (op1_ngram_jaccard_join, op2_secret_scan, op3_pii_scan, op4_substring_dedup, op5_toxicity, op6_warc_captures, op7_decontamination, op8_line_dedup, op9_sentencepiece, op10_media_columns, op11_chat_windows, op12_token_alignment, op13_periodic_runs)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)
