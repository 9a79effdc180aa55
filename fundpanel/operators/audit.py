"""Data contract audits: each check is one row (check, failures, ok, informational)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsers import finite


def footprint(rows: DataFrame, distinct: Sequence[str]) -> DataFrame:
    """Number of rows and of different values of some columns."""
    return rows.agg(F.count("*").alias("n_rows"), *(F.count_distinct(c).alias(f"n_{c}") for c in distinct))


def _check(rows: DataFrame, name: str, failures: Column, informational: bool = False) -> DataFrame:
    return rows.agg(F.coalesce(failures, F.lit(0)).cast("long").alias("failures")).select(F.lit(name).alias("check"), "failures", ((F.col("failures") == 0) | F.lit(informational)).alias("ok"), F.lit(informational).alias("informational"))


def duplicate_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    return _check(rows.groupBy(*key).count().filter("count > 1"), "duplicate_keys", F.count("*"))


def causality(rows: DataFrame) -> DataFrame:
    return _check(rows, "causality", F.count_if(F.col("effective_date") > F.to_date("fetched_at")))


def finite_values(rows: DataFrame) -> DataFrame:
    return _check(rows, "finite_values", F.count_if(~finite(F.col("value"))))


def known_themes(rows: DataFrame, themes: DataFrame) -> DataFrame:
    codes = rows.filter(F.col("family").isin("theme", "rank_adj_theme") & F.col("code").isNotNull()).select("code").distinct()
    return _check(codes.join(themes.select(F.col("theme_id").alias("code")), "code", "left_anti"), "unknown_themes", F.count("*"), informational=True)


def features(panel: DataFrame, required: Sequence[str], forbidden: Sequence[str], patterns: Sequence[str]) -> DataFrame:
    """Required features that are absent, and rows with forbidden names or names LIKE a pattern (_ is a wildcard), in one pass."""
    f = F.col("feature_id")
    sums = [F.count_if(f == x).alias(f"r{i}") for i, x in enumerate(required)] + [F.count_if(f == x).alias(f"f{i}") for i, x in enumerate(forbidden)] + [F.count_if(f.like(x)).alias(f"p{i}") for i, x in enumerate(patterns)]
    rows = [(f"required {x}", F.when(F.col(f"r{i}") > 0, 0).otherwise(1)) for i, x in enumerate(required)] + [(f"forbidden {x}", F.col(f"f{i}")) for i, x in enumerate(forbidden)] + [(f"pattern {x}", F.col(f"p{i}")) for i, x in enumerate(patterns)]
    out = panel.agg(*sums).select(F.explode(F.array(*(F.struct(F.lit(n).alias("check"), v.cast("long").alias("failures")) for n, v in rows))).alias("x")).select("x.*")
    return out.select("check", "failures", (F.col("failures") == 0).alias("ok"), F.lit(False).alias("informational"))


def family_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("family").agg(F.count("*").alias("n_rows"), F.count_distinct("product_id").alias("n_products"), F.count_distinct("metric").alias("n_metrics"), F.min("effective_date").alias("first_date"), F.max("effective_date").alias("last_date"))


def feature_summary(panel: DataFrame) -> DataFrame:
    """By the first part of the feature's name."""
    return panel.groupBy(F.split_part("feature_id", F.lit("_"), F.lit(1)).alias("prefix")).agg(F.count("*").alias("n_rows"), F.count_distinct("feature_id").alias("n_features"), F.min("as_of_date").alias("first_date"), F.max("as_of_date").alias("last_date"))


def verdict(checks: Sequence[DataFrame]) -> DataFrame:
    """All checks and, as the last row, whether all passed."""
    both = reduce(DataFrame.unionByName, checks)
    total = both.agg(F.sum("failures").alias("failures"), F.bool_and("ok").alias("ok")).select(F.lit("all").alias("check"), "failures", "ok", F.lit(False).alias("informational"))
    return both.unionByName(total)
