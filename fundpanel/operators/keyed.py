"""Keyed tables without a transactional store: upserts and purges as frames to be written whole."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(rows: DataFrame, key: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def last_by(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest order columns, by an aggregate that shrinks before the shuffle."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*key, "__r.*").select(*rows.columns)


def upsert_newer(stored: DataFrame, incoming: DataFrame, key: Sequence[str], rank: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """Stored rows, replaced by incoming ones of the same key that rank strictly higher.

    Among incoming rows of equal rank the first by `ties` wins; a stored row beats an equal one.
    """
    both = stored.withColumns({"__new": F.lit(0), **{t: F.lit(None).cast(incoming.schema[t].dataType) for t in ties if t not in stored.columns}}).unionByName(incoming.withColumn("__new", F.lit(1)))
    order = [F.col(c).desc_nulls_last() for c in rank] + [F.col("__new").asc()] + [F.col(t).asc_nulls_first() for t in ties]
    return first_by(both, key, *order).select(*stored.columns)


def insert_absent(stored: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows whose key isn't stored, one per key."""
    return incoming.dropDuplicates(list(key)).join(stored.select(*key), list(key), "left_anti")


def upsert_last(stored: DataFrame, incoming: DataFrame, key: Sequence[str], keep: Sequence[str] = ("created_at",)) -> DataFrame:
    """The incoming row of each key, with the stored value of the columns `keep`; else the stored row."""
    a, b = stored.alias("a"), incoming.alias("b")
    on = reduce(Column.__and__, (F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key))
    new = F.col("b.__in").isNotNull()
    b = incoming.withColumn("__in", F.lit(True)).alias("b")
    cols = [F.coalesce(f"a.{c}", f"b.{c}").alias(c) if c in (*key, *keep) else F.when(new, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in stored.columns]
    return a.join(b, on, "full_outer").select(*cols)


def purge_orphans(rows: DataFrame, users: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows that some user refers to, and those that none does."""
    used = users.select(key).distinct()
    return rows.join(used, key, "left_semi"), rows.join(used, key, "left_anti")


def priority_merge(sources: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """All sources together; of a key the row of the first source counts, within it that which is least by all columns."""
    both = reduce(DataFrame.unionByName, (s.withColumn("__p", F.lit(i)) for i, s in enumerate(sources)))
    rest = [c for c in both.columns if c not in (*key, "__p")]
    return both.groupBy(*key).agg(F.min(F.struct("__p", *rest)).alias("__r")).select(*key, "__r.*").drop("__p").select(*sources[0].columns)
