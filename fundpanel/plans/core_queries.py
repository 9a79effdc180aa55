"""Queries of parsers, series, capture, extraction, audits, logs and returns, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsers
from ..operators import audit, capture, extract, keyed, logs, macro, series
from ..sources.staging import stage
from .adapters import view

SPEC = series.SeriesSpec(entity=("product_id",))


def _pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return stage(view(spark, sf_dir, "prices").select("product_id", "date", "close", "volume")), stage(view(spark, sf_dir, "series_new"))


def parse_text_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parsers.parse_columns(view(spark, sf_dir, "numbers_text"), {"assets": ("net_assets", "amount"), "share": ("bounded_percentage", "pct"), "date": ("date", "day"), "slug": ("snake_case", "label"), "peers": ("largest_integer", "funds")})
    known = F.array(F.lit("EUR"), F.lit("USD"))
    rows = rows.withColumn("currency", parsers.amount_currency(F.col("amount"), F.lit("USD"), known)).withColumn("tenure", parsers.manager_tenure(F.concat(F.lit("19"), F.lpad(F.col("l_linenumber") + 80, 2, "0")), F.col("ref")))
    return rows.select("l_orderkey", "l_linenumber", F.round("assets", 2).alias("assets"), F.round("share", 6).alias("share"), "share_error", "date", "date_error", "slug", "peers", "currency", "tenure").distinct()


def series_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.extent(view(spark, sf_dir, "prices"), SPEC)


def series_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _pair(spark, sf_dir)
    return series.validate(old, new, SPEC)


def series_historical_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _pair(spark, sf_dir)
    return series.historical_change(old, new, SPEC)


def series_truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _pair(spark, sf_dir)
    return series.truncation(old, new.filter("product_id % 4 <> 0 OR volume > 30"), SPEC)


def series_upsert_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _pair(spark, sf_dir)
    return series.upsert_tail(old, new, SPEC)


def series_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _pair(spark, sf_dir)
    return series.reconcile(old, new, SPEC, F.lit("run"))[0]


def series_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _pair(spark, sf_dir)
    return series.reconcile(old, new, SPEC, F.lit("run"))[1].select("product_id", "date", "close", "reason")


def series_redundant_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _pair(spark, sf_dir)
    return series.redundant_runs(old.withColumn("run_id", F.lit("run")), new, SPEC)


def keyed_upsert_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = stage(view(spark, sf_dir, "obs_scalar"))
    newer = obs.filter("product_id % 2 = 0").withColumns({"value": F.col("value") + 1, "date_source_depth": F.col("date_source_depth") + (F.col("product_id") % 4 - 1).cast("int")})
    return keyed.upsert_newer(obs, newer, extract.KEY, ("date_source_depth", "fetched_at")).select(*extract.KEY, "value", "date_source_depth")


def keyed_insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = view(spark, sf_dir, "customer")
    return keyed.insert_absent(c.filter("c_nationkey < 10"), c.filter("c_acctbal > 0"), ["c_custkey"]).select("c_custkey", "c_acctbal")


def keyed_upsert_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = view(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.col("c_mktsegment").alias("created_at"))
    return keyed.upsert_last(c.filter("c_custkey % 3 <> 0"), c.filter("c_custkey % 2 = 0").withColumns({"c_acctbal": F.col("c_acctbal") * 2, "created_at": F.lit("new")}), ["c_custkey"])


def capture_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.changelog(view(spark, sf_dir, "snapshots")).select("product_id", "url_prefix", "hash", "snapshot_id", "created_at", "last_checked_at")


def capture_preview_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = view(spark, sf_dir, "snapshots")
    old = keyed.last_by(s.filter("snapshot_id % 2 = 0").select("product_id", "hash", "snapshot_id"), ["product_id"], ["snapshot_id"])
    new = keyed.last_by(s.select("product_id", "hash", "snapshot_id"), ["product_id"], ["snapshot_id"])
    return capture.preview_gate(old.drop("snapshot_id"), new)


def capture_refresh_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = view(spark, sf_dir, "snapshots")
    products = s.select("product_id").distinct()
    ends = spark.createDataFrame([("click", True), ("view", True), ("error", False)], "url_prefix string, gated boolean")
    gate = products.withColumn("changed", F.col("product_id") % 3 == 0)
    return capture.refresh_plan(products, ends, s.groupBy("product_id", "url_prefix").agg(F.max("created_at").cast("timestamp").alias("last_checked_at")), gate, F.to_timestamp(F.lit("2024-01-31 00:00:00")), 72)


def capture_taxonomy_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.taxonomy_counts(view(spark, sf_dir, "themes"))


def _payloads(rows: DataFrame, body) -> DataFrame:
    made = rows.groupBy("product_id", "effective_date").agg(F.to_json(body).alias("payload"))
    return made.select(F.xxhash64("product_id", "effective_date").alias("snapshot_id"), "product_id", "payload", F.date_add("effective_date", 5).cast("timestamp").alias("created_at"), F.lit("USD").alias("currency"))


def extract_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(F.initcap(F.replace("metric", F.lit("_"), F.lit(" "))).alias("name"), (F.col("value") * 100).alias("weight"))
    made = _payloads(view(spark, sf_dir, "obs_asset"), F.struct(F.max("effective_date").cast("string").alias("as_of_date"), F.collect_list(item).alias("allocation_self")))
    return extract.holdings(made).select("product_id", "family", "metric", "effective_date", "date_source_depth", F.round("value", 6).alias("value"), "error")


def extract_theme_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(F.concat(F.lit(" t"), "metric").alias("key"), F.upper("metric").alias("name"), F.col("value").alias("weight"))
    made = _payloads(view(spark, sf_dir, "obs_theme"), F.struct(F.count("*").alias("coverage"), F.collect_list(item).alias("themes")))
    return extract.theme_weights(made).select("product_id", "family", "metric", "code", "effective_date", F.round("value", 6).alias("value"))


def extract_ratio_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratios with their values; one is a percentage."""
    tag = F.when(F.col("metric").startswith("a"), "Price/Earnings").when(F.col("metric").startswith("n"), "Return on Equity 1Yr").otherwise("Price/Book")
    rows = view(spark, sf_dir, "obs_scalar").filter("family = 'ratios' AND metric NOT LIKE '%o'")
    made = _payloads(rows, F.struct(F.max("effective_date").cast("string").alias("as_of_date"), F.collect_list(F.struct(tag.alias("name_tag"), F.col("value").alias("value"))).alias("ratios")))
    return extract.ratios(made).select("product_id", "family", "metric", "effective_date", "date_source_depth", F.round("value", 6).alias("value"), "error")


def extract_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country weights under their codes."""
    item = F.struct(F.upper("metric").alias("name"), (F.col("value") * 100).alias("weight"), F.substring("metric", 8, 2).alias("country_code"))
    made = _payloads(view(spark, sf_dir, "obs_country"), F.struct(F.max("effective_date").cast("string").alias("as_of_date"), F.collect_list(item).alias("investor_country")))
    return extract.holdings(made).select("product_id", "family", "metric", "code", "effective_date", F.round("value", 6).alias("value"), "error")


def extract_score_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three levels of scores: a snapshot's greatest, least and mean value."""
    leaf = F.array(F.struct(F.lit("TRESGENRRS").alias("name"), F.round(F.avg("value"), 6).alias("value")))
    inner = F.array(F.struct(F.lit("TRESGENS").alias("name"), F.min("value").alias("value"), leaf.alias("children")))
    root = F.array(F.struct(F.lit("TRESGS").alias("name"), F.max("value").alias("value"), inner.alias("children")))
    made = _payloads(view(spark, sf_dir, "obs_scalar").filter("family = 'esg'"), F.struct(F.date_format(F.max("effective_date"), "yyyyMMdd").alias("asOfDate"), F.count("*").alias("coverage"), root.alias("content")))
    # read twice: the depth of the deepest payload decides the steps
    return extract.esg(stage(made)).select("product_id", "family", "metric", "effective_date", F.round("value", 4).alias("value"), "error")


def extract_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = F.when(F.col("metric").startswith("a"), "Price/Earnings").when(F.col("metric").startswith("n"), "Return on Equity 1Yr").when(F.col("product_id") % 10 == 0, "No such ratio").otherwise("Price/Book")
    item = F.struct(tag.alias("name_tag"), F.col("value").alias("value"))
    rows = view(spark, sf_dir, "obs_scalar").filter("family = 'ratios' AND metric NOT LIKE '%o'")
    made = stage(_payloads(rows, F.struct(F.max("effective_date").cast("string").alias("as_of_date"), F.collect_list(item).alias("ratios")))).withColumn("hash", F.sha2("payload", 256))
    snaps = made.select("snapshot_id", "product_id", "created_at", "hash", F.when(F.col("product_id") % 7 == 0, "/landing").otherwise("/ratios").alias("url_prefix"))
    contracts = made.select("product_id").distinct().withColumn("currency", F.lit("USD"))
    blobs = made.select("hash", "payload").dropDuplicates(["hash"])
    good, failed, done = extract.run(snaps, blobs, contracts, snaps.filter("product_id = 3").select("snapshot_id"), {"/ratios": "ratios", "/landing": "landing"}, ["USD"])
    return extract.telemetry(snaps.filter("product_id <> 3"), good, failed, done)


def audit_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, themes = view(spark, sf_dir, "observations"), view(spark, sf_dir, "themes")
    checks = [audit.duplicate_keys(obs, extract.KEY), audit.causality(obs), audit.finite_values(obs), audit.known_themes(obs, themes)]
    return audit.verdict(checks)


def audit_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "observations").select(F.concat_ws("_", "family", "metric").alias("feature_id"))
    return audit.features(obs, ["asset_class_cash", "esg_none"], ["profile_total_net_assets_local"], ["ratios_a%", "nothing_%"])


def audit_family_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.family_summary(view(spark, sf_dir, "observations"))


def audit_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.footprint(view(spark, sf_dir, "observations"), ["product_id", "metric", "effective_date"])


def log_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = view(spark, sf_dir, "events")
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" app.ingest."), "event_type", F.lit(" INFO "), F.when(F.col("event_type") == "error", "request failed after ").when(F.col("event_type") == "click", "pause for ").otherwise("stored "), F.col("event_id").cast("string"), F.lit(" s"))
    lines = e.select(line.alias("value"), F.concat(F.lit("run"), F.col("user_id") % 5).alias("file"))
    return logs.run_statistics(logs.classify(logs.parse_lines(lines)))


def payload_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.payload_profile(view(spark, sf_dir, "snapshots")).withColumn("kind", F.lower("kind")).withColumn("share", F.round("share", 6)).select("url_prefix", "key", "n", "share")


def returns_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return macro.returns(view(spark, sf_dir, "prices")).withColumn("ret", F.round("ret", 8))


def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = view(spark, sf_dir, "supplier")
    prices, obs = view(spark, sf_dir, "prices").select("product_id"), view(spark, sf_dir, "obs_aum").select("product_id")
    rows = s.select(F.col("s_suppkey").alias("product_id"), F.when(F.col("s_nationkey") > 5, F.col("s_name")).alias("exchange_id"))
    return capture.listed_products(rows, prices, obs).withColumnRenamed("exchange_id", "exchange")


_LAST = "l AS (SELECT product_id, max(date) AS last_date FROM {prices} GROUP BY 1)"
_NEW = "{series_new}"
_DIFF = "abs(o.close - n.close) > greatest(1e-6 * greatest(abs(o.close), abs(n.close)), 1e-6)"
_BOTH = f"""{_LAST}, a AS (SELECT p.product_id, p.date, p.close FROM {{prices}} p JOIN l USING (product_id) WHERE p.date BETWEEN last_date - 14 AND last_date),
z AS (SELECT p.product_id, p.date, p.close FROM {_NEW} p JOIN l USING (product_id) WHERE p.date BETWEEN last_date - 14 AND last_date),
j AS (SELECT product_id, date, o.close AS oc, n.close AS nc, o.product_id IS NOT NULL AS ho, n.product_id IS NOT NULL AS hn, o.product_id IS NOT NULL AND n.product_id IS NOT NULL AND {_DIFF} AS bad,
  row_number() OVER (PARTITION BY product_id ORDER BY o.product_id IS NOT NULL DESC, date DESC) <= 5 AS recent FROM a o FULL JOIN z n USING (product_id, date)),
s AS (SELECT product_id, bool_or(ho <> hn) AS dates, bool_or(bad) AS any_bad, bool_or(bad AND NOT recent) AS core, count(CASE WHEN bad AND recent AND oc > 0 THEN nc / oc END) AS k, stddev_pop(CASE WHEN bad AND recent AND oc > 0 THEN nc / oc END) AS spread,
  avg(CASE WHEN bad AND recent AND oc > 0 THEN nc / oc END) AS ratio, bool_or(bad AND abs(nc - oc) > 0.01 AND abs(nc - oc) > 0.01 * abs(oc)) AS beyond FROM j GROUP BY 1),
v AS (SELECT product_id, CASE WHEN dates THEN 'date_mismatch' WHEN NOT any_bad THEN 'ok' WHEN core THEN 'corporate_action' WHEN k >= 2 AND spread <= 1e-3 AND abs(ratio - 1) > 1e-3 THEN 'corporate_action' WHEN beyond THEN 'value_mismatch' ELSE 'ok' END AS verdict FROM s)"""
_CHANGE = f"h AS (SELECT o.product_id, bool_or(n.product_id IS NULL OR {_DIFF}) AS changed FROM (SELECT p.* FROM {{prices}} p JOIN l USING (product_id) WHERE p.date < last_date - 14) o LEFT JOIN {_NEW} n ON n.product_id = o.product_id AND n.date = o.date GROUP BY 1)"
_COUNTS = "c AS (SELECT product_id, n_old, coalesce(n_new, 0) AS n_new FROM (SELECT product_id, count(*) AS n_old FROM {prices} GROUP BY 1) LEFT JOIN (SELECT product_id, count(*) AS n_new FROM {new} GROUP BY 1) USING (product_id))"
_KEPT = "n_new >= CASE WHEN n_old > 5 THEN floor(n_old * 0.9) ELSE 1 END"
_PLAN = f"WITH {_BOTH}, {_CHANGE}, {_COUNTS.replace('{new}', _NEW)}, p AS (SELECT product_id, verdict, CASE WHEN verdict = 'ok' THEN 'extend' WHEN {_KEPT} THEN 'replace' ELSE 'error' END AS action, coalesce(changed, false) AS changed FROM v JOIN c USING (product_id) LEFT JOIN h USING (product_id))"
_AMOUNT = r"regexp_replace(regexp_replace(amount, '(\d{4}[-/]?\d{2}[-/]?\d{2}|\d{8})', ''), '[^0-9.,kKmMbBtT]', '', 'g')"

QUERIES = {
    "parse_text_columns": (
        parse_text_columns,
        r"""SELECT DISTINCT l_orderkey, l_linenumber, round(CAST(regexp_extract(amount, '([0-9]+[.][0-9]+)', 1) AS DOUBLE) * CASE regexp_extract(amount, '[0-9]([KMB])', 1) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 ELSE 1 END, 2) AS assets,
  round(CAST(nullif(regexp_extract(pct, '([0-9]+)%', 1), '') AS DOUBLE) / 100, 6) AS share, pct LIKE '%bad' OR pct = '<n/a' AS share_error,
  CASE WHEN regexp_full_match(day, '[0-9]+') THEN CAST(try_strptime(day, '%Y%m%d') AS DATE) ELSE TRY_CAST(replace(day, '/', '-') AS DATE) END AS date, day = 'n.a.' AS date_error,
  trim(regexp_replace(lower(replace(label, '&', 'and')), '[^a-z0-9]+', '_', 'g'), '_') AS slug, greatest(CAST(split_part(funds, ' ', 1) AS BIGINT), CAST(split_part(funds, ' ', 3) AS BIGINT)) AS peers,
  CASE WHEN amount LIKE 'EUR%' THEN 'EUR' WHEN amount LIKE '€%' THEN NULL ELSE 'USD' END AS currency, round((ref - make_date(1980 + CAST(l_linenumber AS INTEGER), 1, 1)) / 365.25, 4) AS tenure FROM {numbers_text}""",
    ),
    "series_extent": (series_extent, "SELECT product_id, max(date) AS last_date, count(*) AS n_bars FROM {prices} GROUP BY 1"),
    "series_verdict": (series_verdict, f"WITH {_BOTH} SELECT * FROM v"),
    "series_historical_change": (series_historical_change, f"WITH {_LAST}, {_CHANGE} SELECT * FROM h"),
    "series_truncation": (series_truncation, f"WITH {_COUNTS.replace('{new}', '(SELECT * FROM ' + _NEW + ' WHERE product_id % 4 <> 0 OR volume > 30)')} SELECT *, {_KEPT} AS kept FROM c"),
    "series_upsert_tail": (
        series_upsert_tail,
        f"WITH {_LAST}, t AS (SELECT n.product_id, n.date, n.close, n.volume FROM {_NEW} n JOIN l USING (product_id) WHERE n.date >= last_date - 14) SELECT product_id, date, close, volume FROM {{prices}} p ANTI JOIN t USING (product_id, date) UNION ALL SELECT * FROM t",
    ),
    "series_reconciled": (
        series_reconciled,
        f"""{_PLAN}, t AS (SELECT n.product_id, n.date, n.close, n.volume FROM {_NEW} n JOIN l USING (product_id) JOIN p USING (product_id) WHERE action = 'extend' AND n.date >= last_date - 14)
SELECT o.product_id, o.date, o.close, o.volume FROM {{prices}} o JOIN p USING (product_id) ANTI JOIN t USING (product_id, date) WHERE action IN ('extend', 'error') UNION ALL SELECT * FROM t UNION ALL SELECT n.product_id, n.date, n.close, n.volume FROM {_NEW} n JOIN p USING (product_id) WHERE action = 'replace'""",
    ),
    "series_archived": (series_archived, f"{_PLAN} SELECT o.product_id, o.date, o.close, verdict AS reason FROM {{prices}} o JOIN p USING (product_id) WHERE action = 'replace' AND changed"),
    "series_redundant_runs": (
        series_redundant_runs,
        f"""WITH {_LAST}, o AS (SELECT p.* FROM {{prices}} p JOIN l USING (product_id) WHERE p.date <= last_date - 7), b AS (SELECT DISTINCT o.product_id FROM o LEFT JOIN {_NEW} n USING (product_id, date)
WHERE n.product_id IS NULL OR abs(o.close - n.close) > 1e-6 OR abs(o.close - n.close) / nullif(abs(o.close), 0) > 1e-6) SELECT product_id, 'run' AS run_id FROM l ANTI JOIN b USING (product_id)""",
    ),
    "keyed_upsert_newer": (
        keyed_upsert_newer,
        """SELECT product_id, family, metric, effective_date, CASE WHEN product_id % 4 = 2 THEN value + 1 ELSE value END AS value, CAST(CASE WHEN product_id % 4 = 2 THEN date_source_depth + 1 ELSE date_source_depth END AS INTEGER) AS date_source_depth FROM {obs_scalar}""",
    ),
    "keyed_insert_absent": (keyed_insert_absent, "SELECT c_custkey, c_acctbal FROM {customer} WHERE c_acctbal > 0 AND c_nationkey >= 10"),
    "keyed_upsert_last": (
        keyed_upsert_last,
        "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment ELSE 'new' END AS created_at FROM {customer} WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0",
    ),
    "capture_changelog": (
        capture_changelog,
        """WITH w AS (SELECT *, lag(hash) OVER (PARTITION BY product_id, url_prefix ORDER BY created_at, snapshot_id) AS old FROM {snapshots}), r AS (SELECT *, sum(CASE WHEN hash IS DISTINCT FROM old THEN 1 ELSE 0 END) OVER (PARTITION BY product_id, url_prefix ORDER BY created_at, snapshot_id) AS run FROM w)
SELECT product_id, url_prefix, min(hash) AS hash, min(snapshot_id) AS snapshot_id, min(created_at) AS created_at, max(created_at) AS last_checked_at FROM r GROUP BY product_id, url_prefix, run""",
    ),
    "capture_preview_gate": (
        capture_preview_gate,
        """WITH o AS (SELECT product_id, arg_max(hash, snapshot_id) AS h FROM {snapshots} WHERE snapshot_id % 2 = 0 GROUP BY 1), n AS (SELECT product_id, arg_max(hash, snapshot_id) AS hash, max(snapshot_id) AS snapshot_id FROM {snapshots} GROUP BY 1)
SELECT n.product_id, hash, n.snapshot_id, o.product_id IS NULL OR hash IS DISTINCT FROM h AS changed FROM n LEFT JOIN o USING (product_id)""",
    ),
    "capture_refresh_plan": (
        capture_refresh_plan,
        """WITH p AS (SELECT DISTINCT product_id FROM {snapshots}), c AS (SELECT product_id, url_prefix, max(created_at) AS t FROM {snapshots} GROUP BY 1, 2), e AS (SELECT * FROM (VALUES ('click', true), ('view', true), ('error', false)) x(url_prefix, gated)),
r AS (SELECT p.product_id, e.url_prefix, gated, NOT coalesce(greatest(CAST(epoch(TIMESTAMP '2024-01-31') AS BIGINT) - CAST(floor(epoch(t)) AS BIGINT), 0) <= 72 * 3600, false) AS stale FROM p CROSS JOIN e LEFT JOIN c ON c.product_id = p.product_id AND c.url_prefix = e.url_prefix),
f AS (SELECT *, stale AND (NOT gated OR product_id % 3 = 0) AS "fetch" FROM r) SELECT product_id, url_prefix, gated, stale, "fetch", NOT bool_or(gated AND "fetch") OVER (PARTITION BY product_id) AS commit_gate FROM f""",
    ),
    "capture_taxonomy_counts": (capture_taxonomy_counts, "SELECT count(*) FILTER (parent_id IS NULL) AS n_parents, count(*) FILTER (parent_id IS NOT NULL) AS n_children FROM {themes}"),
    "extract_holdings": (extract_holdings, "SELECT product_id, family, metric, effective_date, 1 AS date_source_depth, round(value, 6) AS value, CAST(NULL AS VARCHAR) AS error FROM {obs_asset}"),
    "extract_theme_weights": (
        extract_theme_weights,
        "SELECT product_id, family, metric, 't' || metric AS code, effective_date + 5 AS effective_date, round(value, 6) AS value FROM {obs_theme} UNION ALL SELECT product_id, 'profile', 'theme_coverage', NULL, effective_date + 5, CAST(count(*) AS DOUBLE) FROM {obs_theme} GROUP BY product_id, effective_date",
    ),
    "extract_ratio_values": (
        extract_ratio_values,
        """SELECT product_id, 'ratios' AS family, CASE WHEN metric LIKE 'a%' THEN 'price_earnings' WHEN metric LIKE 'n%' THEN 'return_on_equity_1yr' ELSE 'price_book' END AS metric, effective_date, 1 AS date_source_depth, round(CASE WHEN metric LIKE 'n%' THEN value / 100 ELSE value END, 6) AS value, CAST(NULL AS VARCHAR) AS error FROM {obs_scalar} WHERE family = 'ratios' AND metric NOT LIKE '%o'""",
    ),
    "extract_countries": (extract_countries, "SELECT product_id, family, metric, substr(metric, 8, 2) AS code, effective_date, round(value, 6) AS value, CAST(NULL AS VARCHAR) AS error FROM {obs_country}"),
    "extract_score_tree": (
        extract_score_tree,
        """WITH s AS (SELECT product_id, effective_date, max(value) AS hi, min(value) AS lo, avg(value) AS mean, count(*) AS n FROM {obs_scalar} WHERE family = 'esg' GROUP BY 1, 2), t AS (SELECT product_id, 'esg' AS family, 'tresgs' AS metric, effective_date, hi AS value FROM s UNION ALL SELECT product_id, 'esg', 'tresgens', effective_date, lo FROM s
UNION ALL SELECT product_id, 'esg', 'tresgenrrs', effective_date, mean FROM s UNION ALL SELECT product_id, 'profile', 'esg_coverage', effective_date, CAST(n AS DOUBLE) FROM s) SELECT product_id, family, metric, effective_date, round(value, 4) AS value, CAST(NULL AS VARCHAR) AS error FROM t""",
    ),
    "extract_run": (
        extract_run,
        """WITH s AS (SELECT product_id, effective_date, product_id % 7 = 0 AS landing, bool_or(product_id % 10 = 0 AND metric LIKE 'r%') AS bad, count(*) AS n FROM {obs_scalar} WHERE family = 'ratios' AND metric NOT LIKE '%o' AND product_id <> 3 GROUP BY 1, 2)
SELECT count(*) AS pending, count(*) FILTER (landing OR NOT bad) AS watermarked, count(*) FILTER (landing) AS "empty", count(*) FILTER (NOT landing AND bad) AS failed, CAST(sum(n) FILTER (NOT landing AND NOT bad) AS BIGINT) AS n_observations FROM s""",
    ),
    "audit_contract": (
        audit_contract,
        """WITH c AS (SELECT 'duplicate_keys' AS "check", count(*) AS failures, count(*) = 0 AS ok, false AS informational FROM (SELECT 1 FROM {observations} GROUP BY product_id, family, metric, effective_date HAVING count(*) > 1)
UNION ALL SELECT 'causality', count(*) FILTER (effective_date > CAST(fetched_at AS DATE)), count(*) FILTER (effective_date > CAST(fetched_at AS DATE)) = 0, false FROM {observations}
UNION ALL SELECT 'finite_values', count(*) FILTER (value IS NULL OR isnan(value) OR isinf(value)), count(*) FILTER (value IS NULL OR isnan(value) OR isinf(value)) = 0, false FROM {observations}
UNION ALL SELECT 'unknown_themes', count(*), true, true FROM (SELECT DISTINCT code FROM {observations} WHERE family IN ('theme', 'rank_adj_theme') AND code IS NOT NULL AND code NOT IN (SELECT theme_id FROM {themes})))
SELECT * FROM c UNION ALL SELECT 'all', CAST(sum(failures) AS BIGINT), bool_and(ok), false FROM c""",
    ),
    "audit_features": (
        audit_features,
        """WITH f AS (SELECT family || '_' || metric AS f FROM {observations}), c AS (SELECT 'required asset_class_cash' AS "check", CASE WHEN count(*) FILTER (f = 'asset_class_cash') > 0 THEN 0 ELSE 1 END AS failures FROM f UNION ALL SELECT 'required esg_none', CASE WHEN count(*) FILTER (f = 'esg_none') > 0 THEN 0 ELSE 1 END FROM f
UNION ALL SELECT 'forbidden profile_total_net_assets_local', count(*) FILTER (f = 'profile_total_net_assets_local') FROM f UNION ALL SELECT 'pattern ratios_a%', count(*) FILTER (f LIKE 'ratios_a%') FROM f UNION ALL SELECT 'pattern nothing_%', count(*) FILTER (f LIKE 'nothing_%') FROM f)
SELECT "check", CAST(failures AS BIGINT) AS failures, failures = 0 AS ok, false AS informational FROM c""",
    ),
    "audit_family_summary": (audit_family_summary, "SELECT family, count(*) AS n_rows, count(DISTINCT product_id) AS n_products, count(DISTINCT metric) AS n_metrics, min(effective_date) AS first_date, max(effective_date) AS last_date FROM {observations} GROUP BY 1"),
    "audit_footprint": (audit_footprint, "SELECT count(*) AS n_rows, count(DISTINCT product_id) AS n_product_id, count(DISTINCT metric) AS n_metric, count(DISTINCT effective_date) AS n_effective_date FROM {observations}"),
    "log_statistics": (
        log_statistics,
        """SELECT 'run' || (user_id % 5) AS file, date_trunc('second', min(ts)) AS first_ts, date_trunc('second', max(ts)) AS last_ts, count(*) AS n_lines, count(*) FILTER (event_type = 'error' AND CAST(event_id AS VARCHAR) NOT LIKE '%429%') AS n_failures, CAST(0 AS BIGINT) AS n_open, CAST(0 AS BIGINT) AS n_closed,
count(*) FILTER (CAST(event_id AS VARCHAR) LIKE '%429%') AS n_limited, coalesce(sum(CAST(event_id AS DOUBLE)) FILTER (event_type = 'click' AND CAST(event_id AS VARCHAR) NOT LIKE '%429%'), 0) AS pause_sum, max(CAST(event_id AS DOUBLE)) FILTER (event_type = 'click' AND CAST(event_id AS VARCHAR) NOT LIKE '%429%') AS pause_max FROM {events} GROUP BY 1""",
    ),
    "payload_presence": (payload_presence, "WITH k AS (SELECT url_prefix, unnest(json_keys(payload)) AS key FROM {snapshots}), t AS (SELECT url_prefix, count(*) AS t FROM {snapshots} GROUP BY 1) SELECT url_prefix, key, count(*) AS n, round(count(*) / any_value(t), 6) AS share FROM k JOIN t USING (url_prefix) GROUP BY 1, 2"),
    "returns_daily": (returns_daily, "SELECT product_id, date, round(ret, 8) AS ret FROM (SELECT product_id, date, close / lag(close) OVER (PARTITION BY product_id ORDER BY date) - 1 AS ret FROM {prices}) WHERE ret IS NOT NULL"),
    "silver_products": (silver_products, "SELECT s_suppkey AS product_id, CASE WHEN s_nationkey > 5 THEN s_name ELSE 'SMART' END AS exchange FROM {supplier} WHERE s_suppkey IN (SELECT product_id FROM {prices}) AND s_suppkey IN (SELECT product_id FROM {obs_aum})"),
}
