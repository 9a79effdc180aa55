"""Change capture of reference data and payload snapshots."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.parsers import blank_to_null
from .keyed import priority_merge, upsert_last

#: Order of JSON values of different kinds.
KINDS = (type(None), bool, int, float, str, list, dict)


def normalise_listing(raw: DataFrame, renames: dict[str, str], key: str = "conid") -> DataFrame:
    """Listing rows that have a key, their fields renamed and as text."""
    return raw.filter(F.col(key).isNotNull()).select(*(F.col(a).cast("string").alias(b) for a, b in renames.items()))


def flatten_details(raw: DataFrame, attributes: Sequence[str], nested: str = "contract", ids: str = "secIdList") -> DataFrame:
    """Each attribute from the outer record, else the nested one, blanks as null; isin also from the list of tagged ids."""
    fields = raw.schema[nested].dataType.fieldNames()
    cols = [blank_to_null(F.coalesce(*([F.col(a).cast("string")] if a in raw.columns else []), *([F.col(f"{nested}.{a}").cast("string")] if a in fields else []), F.lit(None).cast("string"))).alias(a) for a in attributes]
    out = raw.select(*cols, *([ids] if ids in raw.columns else []))
    if ids in raw.columns and "isin" in attributes:
        tagged = F.filter(ids, lambda x: x["tag"] == "ISIN")
        out = out.withColumn("isin", F.coalesce("isin", F.get(tagged, F.lit(0))["value"])).drop(ids)
    return out


def listed_products(products: DataFrame, prices: DataFrame, observations: DataFrame, default: str = "SMART") -> DataFrame:
    """The products that have prices as well as observations, with an exchange: their own, else the default one."""
    kept = products.join(prices.select("product_id"), "product_id", "left_semi").join(observations.select("product_id"), "product_id", "left_semi")
    return kept.withColumn("exchange_id", F.coalesce("exchange_id", F.lit(default)))


def target_products(products: DataFrame, blocked: Sequence[str]) -> DataFrame:
    """Products whose primary, else own, exchange is unknown or not blocked; raises on an empty table."""
    if products.isEmpty():
        raise ValueError("there are no products")
    exchange = F.coalesce("primary_exchange_id", "exchange_id") if "primary_exchange_id" in products.columns else F.col("exchange_id")
    return products.filter(exchange.isNull() | ~exchange.isin(*blocked)).orderBy("product_id")


def target_currencies(contracts: DataFrame, base: str = "USD") -> DataFrame:
    """Currencies other than the base of contracts with a known kind that isn't cash; raises on an empty table."""
    if contracts.isEmpty():
        raise ValueError("there are no contracts")
    return contracts.filter(F.col("currency").isNotNull() & (F.col("currency") != base) & (F.col("sec_type") != "CASH")).select("currency").distinct().orderBy("currency")


def themes_from_tree(parents: DataFrame, nodes: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored themes with the tree's parents (key, name) and nodes (key, name, parent); a known parent keeps its own parent."""
    clean = lambda rows, parent: rows.filter(blank_to_null(F.col("key")).isNotNull() & blank_to_null(F.col("name")).isNotNull()).select(F.trim("key").alias("theme_id"), F.trim("name").alias("name"), parent.alias("parent_id"))
    up = clean(parents, F.lit(None).cast("string")).dropDuplicates(["theme_id"])
    kept = upsert_last(stored.select("theme_id", "name", "parent_id"), up, ["theme_id"], keep=["parent_id"])
    return upsert_last(kept, clean(nodes, F.col("parent")).dropDuplicates(["theme_id"]), ["theme_id"], keep=[])


def taxonomy_counts(themes: DataFrame) -> DataFrame:
    return themes.agg(F.count_if(F.col("parent_id").isNull()).alias("n_parents"), F.count_if(F.col("parent_id").isNotNull()).alias("n_children"))


def content_hash(payload: Column) -> Column:
    """A digest of a typed payload that doesn't depend on the order of list elements of the top level."""
    return F.sha2(F.to_json(payload), 256)


@F.pandas_udf(StringType())
def canonical_json(payload: pd.Series) -> pd.Series:
    """A JSON text with sorted keys and sorted list elements at every level, by kind and then by their text; null where it can't be read."""

    def canonical(x: object) -> object:
        if isinstance(x, dict):
            return {k: canonical(x[k]) for k in sorted(x)}
        if isinstance(x, list):
            return sorted(map(canonical, x), key=lambda y: (KINDS.index(type(y)), text(y)))
        return x

    def text(x: object) -> str:
        return json.dumps(x, ensure_ascii=False, separators=(",", ":"))

    def one(raw: str | None) -> str | None:
        try:
            return None if raw is None else text(canonical(json.loads(raw)))
        except ValueError:
            return None

    return payload.map(one)


def canonical_hash(payload: Column) -> Column:
    """A digest of a JSON text that depends neither on the order of keys nor on that of list elements, at any level."""
    return F.sha2(canonical_json(payload), 256)


def table_freshness(rows: DataFrame, now: Column, hours: int) -> DataFrame:
    """One row (last_checked_at, fresh): when the whole table was last checked, and whether within the hours before now."""
    return rows.agg(F.max("last_checked_at").alias("last_checked_at")).withColumn("fresh", fresh(F.col("last_checked_at"), now, hours))


def stamp(rows: DataFrame, now: Column) -> DataFrame:
    """All rows marked as checked now."""
    return rows.withColumn("last_checked_at", now)


def ordered(items: Column) -> Column:
    """A list of records in an order of its own, for content_hash()."""
    return F.array_sort(F.transform(items, lambda x: F.to_json(x)))


def changelog(fetches: DataFrame, key: Sequence[str] = ("product_id", "url_prefix"), at: str = "created_at", order: str = "snapshot_id") -> DataFrame:
    """Versions of each payload: a row per run of equal hashes, with its first and last fetch.

    Returns key.., hash, snapshot_id (of the run's first fetch), created_at, last_checked_at.
    """
    w = Window.partitionBy(*key).orderBy(at, order)
    new = ~F.col("hash").eqNullSafe(F.lag("hash").over(w)) | F.lag(order).over(w).isNull()
    runs = fetches.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(w))
    return runs.groupBy(*key, "run").agg(F.min("hash").alias("hash"), F.min(order).alias(order), F.min(at).alias("created_at"), F.max(at).alias("last_checked_at")).drop("run")


def preview_gate(stored: DataFrame, fetched: DataFrame, key: str = "product_id") -> DataFrame:
    """fetched with changed: there is no stored hash, or another one."""
    old = stored.select(key, F.col("hash").alias("old_hash"), F.lit(True).alias("known"))
    return fetched.join(old, key, "left").withColumn("changed", F.col("known").isNull() | ~F.col("hash").eqNullSafe(F.col("old_hash"))).drop("known", "old_hash")


def commit_previews(stored: DataFrame, fetched: DataFrame, now: Column, key: str = "product_id") -> DataFrame:
    """Stored previews after a commit: updated_at moves only with the hash, last_checked_at always."""
    old = stored.select(key, F.col("hash").alias("old_hash"), F.col("updated_at").alias("old_updated"), F.col("last_checked_at").alias("old_checked"))
    rows = old.join(fetched.select(key, "hash", F.lit(True).alias("given")), key, "full_outer")
    given = F.col("given").isNotNull()
    moved = given & ~F.col("hash").eqNullSafe(F.col("old_hash"))
    return rows.select(key, F.when(given, F.col("hash")).otherwise(F.col("old_hash")).alias("hash"), F.when(moved, now).otherwise(F.col("old_updated")).alias("updated_at"), F.when(given, now).otherwise(F.col("old_checked")).alias("last_checked_at"))


def fresh(last_seen: Column, now: Column, hours: int) -> Column:
    """Seen within the hours before now; never seen isn't fresh, a time to come is."""
    age = F.greatest(F.unix_seconds(now) - F.unix_seconds(last_seen), F.lit(0))
    return F.coalesce(age <= hours * 3600, F.lit(False))


def last_checked(snapshots: DataFrame) -> DataFrame:
    """(product_id, url_prefix, last_checked_at)."""
    return snapshots.groupBy("product_id", "url_prefix").agg(F.max("last_checked_at").alias("last_checked_at"))


def refresh_plan(products: DataFrame, endpoints: DataFrame, checked: DataFrame, gate: DataFrame, now: Column, hours: int) -> DataFrame:
    """(product_id, url_prefix, gated, stale, fetch, commit_gate) of every product and endpoint (url_prefix, gated).

    A gated endpoint is fetched if stale and the product's gate (product_id, changed) has changed; others if stale.  The gate
    may be committed when no gated endpoint of the product is left to fetch.
    """
    rows = products.select("product_id").join(F.broadcast(endpoints), how="cross").join(checked, ["product_id", "url_prefix"], "left").join(gate.select("product_id", "changed"), "product_id", "left")
    rows = rows.withColumn("stale", ~fresh(F.col("last_checked_at"), now, hours))
    rows = rows.withColumn("fetch", F.col("stale") & (~F.col("gated") | F.coalesce("changed", F.lit(True))))
    open_gate = F.bool_or(F.col("gated") & F.col("fetch")).over(Window.partitionBy("product_id"))
    return rows.withColumn("commit_gate", ~open_gate).select("product_id", "url_prefix", "gated", "stale", "fetch", "commit_gate")


def keep_last_good(new: DataFrame, stored: DataFrame) -> DataFrame:
    """The new snapshot of a source, or the stored one if the new has no rows."""
    return stored if new.isEmpty() else new


def append_pending(stored: DataFrame, fetched: DataFrame, key: Sequence[str] = ("indicator_code", "country_code", "year")) -> DataFrame:
    """Stored rows and fetched ones, one per key: a stored row counts before a fetched one, among equals the least by all columns."""
    return priority_merge([stored, fetched.select(*stored.columns)], list(key))


def pending_codes(catalog: DataFrame, seen: DataFrame, code: str = "code") -> DataFrame:
    """The catalog's rows whose code isn't among those seen."""
    return catalog.join(seen.select(code).distinct(), code, "left_anti")


