"""Queries of series state, listings, provider clean-ups, tree reports and regressions, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsers
from ..operators import capture, extract, gauges, keyed, macro, series
from ..operators import indicators as ind
from ..sources.staging import shared_dir, stage
from ..sources.store import Change, Store
from .adapters import lines, view
from .core_queries import _BOTH, _COUNTS, _KEPT, _NEW, SPEC, _pair
from .indicator_queries import _r, _rows, view_alternatives, view_components, view_nodes
from .report_queries import _CW, _EFF, _TA, _components

TARGET, NOW = "DATE '2000-11-01'", "TIMESTAMP '2024-01-03 00:00:00'"


def series_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of each series when some refetches are short."""
    old, new = _pair(spark, sf_dir)
    return series.reconcile(old, new, SPEC, F.lit("run"), new.filter("product_id % 4 <> 0 OR volume > 30"))[2]


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = view(spark, sf_dir, "supplier")
    status = F.when(F.col("s_nationkey") % 3 == 0, "error").when(F.col("s_nationkey") % 3 == 1, "ok").otherwise("no_data")
    return s.select((F.col("s_suppkey") + 5).alias("product_id"), status.alias("status"), F.timestamp_seconds(1_704_067_200 + F.col("s_suppkey") * 3600).alias("last_checked_at"))


def series_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.load_status(view(spark, sf_dir, "prices"), _states(spark, sf_dir), SPEC).select("product_id", "last_date", "status", "last_checked_at")


def series_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = series_loaded(spark, sf_dir)
    return rows.select("product_id", series.is_fresh(F.col("last_date"), F.expr(TARGET), F.col("status"), F.col("last_checked_at"), F.expr(NOW), 24).alias("fresh"))


def keyed_store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations kept in buckets; a batch of newer ones, a stale one and a repeated one are committed after them."""
    buckets = 16
    obs = view(spark, sf_dir, "obs_scalar", {"lines": lines(spark, sf_dir, buckets)}).select(*extract.KEY, "value", "date_source_depth", "fetched_at")
    store = Store(spark, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}")
    merge = lambda stored, given: keyed.upsert_newer(stored, given, extract.KEY, ("date_source_depth", "fetched_at"))
    put = lambda rows, n: store.commit(Change("observations", rows, ("product_id",), merge, buckets, dealt=True), stream="load", batch=n)
    deeper = obs.filter("product_id % 10 = 3").withColumns({"value": F.col("value") + 1, "date_source_depth": F.col("date_source_depth") + 1})
    stale = obs.filter("product_id % 10 = 4").withColumns({"value": F.col("value") + 2, "date_source_depth": F.col("date_source_depth") - 1})
    put(obs, 0)
    put(deeper, 1)
    put(stale, 2)
    put(deeper.withColumns({"value": F.col("value") + 5, "date_source_depth": F.col("date_source_depth") + 5}), 2)
    return store.read("observations").select(*extract.KEY, "value", "date_source_depth")


def keyed_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, gone = keyed.purge_orphans(view(spark, sf_dir, "customer"), view(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")
    return kept.select("c_custkey", F.lit(True).alias("kept")).unionByName(gone.select("c_custkey", F.lit(False).alias("kept")))


def capture_preview_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = view(spark, sf_dir, "snapshots").select("product_id", "hash", "snapshot_id", F.col("created_at").alias("updated_at"))
    old = keyed.last_by(s.filter("snapshot_id % 2 = 0"), ["product_id"], ["snapshot_id"]).withColumn("last_checked_at", F.col("updated_at"))
    new = keyed.last_by(s.filter("product_id % 3 <> 0"), ["product_id"], ["snapshot_id"])
    return capture.commit_previews(old, new, F.expr(NOW))


def capture_last_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.last_checked(view(spark, sf_dir, "snapshots").withColumn("last_checked_at", F.col("created_at")))


def capture_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = view(spark, sf_dir, "customer").withColumn("conid", F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey")))
    return capture.normalise_listing(raw, {"conid": "product_id", "c_name": "symbol", "c_nationkey": "exchange_id"})


def capture_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes from the outer record, the nested one, or the list of ids."""
    c = view(spark, sf_dir, "customer")
    outer = F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).when(F.col("c_custkey") % 3 == 1, " ")
    inner = F.struct(F.col("c_custkey").alias("conId"), F.concat(F.lit(" "), "c_mktsegment").alias("industry"), F.lit("-").alias("symbol"), F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("IN"), "c_custkey")).alias("isin"))
    ids = F.array(F.struct(F.lit("CUSIP").alias("tag"), F.lit("0").alias("value")), F.struct(F.lit("ISIN").alias("tag"), F.concat(F.lit("XS"), "c_custkey").alias("value")))
    raw = c.select(outer.alias("industry"), inner.alias("contract"), ids.alias("secIdList"), "c_name")
    return capture.flatten_details(raw, ["conId", "industry", "symbol", "isin", "longName"])


def capture_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = view(spark, sf_dir, "customer").select(F.col("c_custkey").alias("product_id"), F.when(F.col("c_nationkey") > 20, F.lit(None)).otherwise(F.concat(F.lit("X"), "c_nationkey")).alias("exchange_id"), F.when(F.col("c_custkey") % 4 == 0, "X7").alias("primary_exchange_id"))
    return capture.target_products(s, ["X3", "X7"]).select("product_id")


def capture_currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = view(spark, sf_dir, "customer")
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "CASH").when(F.col("c_custkey") % 9 != 0, "STK")
    return capture.target_currencies(c.select(F.when(F.col("c_nationkey") == 0, "USD").otherwise(F.concat("c_mktsegment", "c_nationkey")).alias("currency"), kind.alias("sec_type")))


def capture_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored taxonomy, of which one region is below another one, with the tree's regions and nations; some have no name."""
    r, n = view(spark, sf_dir, "region"), view(spark, sf_dir, "nation")
    id_ = lambda c: F.concat(F.substring(F.lit(c), 1, 1), f"{c}_{'region' if c == 'r' else 'nation'}key")
    stored = r.filter("r_regionkey < 2").select(id_("r").alias("theme_id"), F.lit("old").alias("name"), F.lit("top").alias("parent_id")).unionByName(n.filter("n_nationkey < 3").select(id_("n"), F.lit("old"), F.lit("r9")).toDF("theme_id", "name", "parent_id"))
    parents = r.select(F.concat(F.lit(" "), id_("r")).alias("key"), "r_name").withColumnRenamed("r_name", "name")
    nodes = n.select(id_("n").alias("key"), F.when(F.col("n_nationkey") != 4, F.col("n_name")).otherwise(" ").alias("name"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))
    return capture.themes_from_tree(parents, nodes, stored)


def indicator_tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("o_orderkey") % 5 == 0, "..").when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_custkey").cast("string"))
    rows = view(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("country_code"), F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("indicator_code"), F.date_format("o_orderdate", "yyyy").alias("year"), value.alias("value"))
    return ind.tidy(rows, rows.filter("indicator_code LIKE '%LOW' OR year = '1996'"))


def indicator_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).drop("is_projection").withColumn("source", F.when(F.col("indicator_code") == "LOW", "weo").when(F.col("indicator_code") != "HIGH", "wdi"))
    return ind.flag_projections(rows, 1999, ["weo"]).select(*ind.KEY, "is_projection")


def indicator_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns FY1995 to FY1998 of each customer's orders, as rows."""
    o = view(spark, sf_dir, "orders")
    wide = o.groupBy("o_custkey").agg(*(F.sum(F.when(F.year("o_orderdate") == y, F.col("o_custkey") + F.col("o_orderkey"))).alias(f"FY{y}") for y in range(1995, 1999)), F.count("*").alias("FYears"))
    return ind.wide_to_long(wide, ["o_custkey"], "FY")


def indicator_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit(" Nation_"), "c_nationkey").alias("name"))
    aliases = view(spark, sf_dir, "nation").filter("n_nationkey <> 7").select(F.concat("n_name", F.lit("  ")).alias("alias"), F.concat(F.lit("N"), F.lpad("n_nationkey", 2, "0")).alias("country_code"))
    return ind.map_names(rows, aliases).select("c_custkey", "country_code")


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "orders").select((F.col("o_custkey") % 20).cast("string").alias("country_code"), F.col("o_orderpriority").alias("indicator_code"), F.year("o_orderdate").alias("year"), F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("o"), (F.col("o_orderkey") % 1000).cast("double").alias("value"))


def indicator_year_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ind.year_end(_daily(spark, sf_dir).withColumn("period", F.struct("day", "o")), "period"), "mean")


def indicator_period_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ind.period_mean(_daily(spark, sf_dir).withColumn("day", F.col("day").cast("string")), "day", "1996-02-10", "1997-11-05", 2000), "value")


def indicator_preferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ind.preferred_variant(_daily(spark, sf_dir).withColumn("seasonal", F.when(F.col("o") % 3 == 0, "Y").when(F.col("o") % 3 == 1, "S").otherwise("?")).select(*ind.KEY, "seasonal", "value"), {"seasonal": ["S", "Y"]})


def indicator_cut_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = view(spark, sf_dir, "orders").select(F.concat("o_orderstatus", F.lit(": status")).alias("STATUS:Order status"), F.col("o_orderkey").alias("KEY:Order"), "o_orderpriority")
    return ind.before_colon(o)


def indicator_allocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = view(spark, sf_dir, "fx").groupBy(F.col("source_currency").alias("currency"), F.year("date").alias("year")).agg(F.count("*").alias("value"))
    issuers = view(spark, sf_dir, "nation").select(F.element_at(F.array(*map(F.lit, ("URGENT", "HIGH", "LOW"))), (F.col("n_nationkey") % 3 + 1).cast("int")).alias("currency"), F.col("n_name").alias("country_code"))
    return ind.allocate(shares, issuers, ["LOW"]).select("currency", "country_code", "year", "value")


def indicator_rank_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = view(spark, sf_dir, "orders")
    rank = F.when(F.col("o_orderkey") % 3 == 0, F.concat((F.col("o_orderkey") % 900).cast("string"), F.lit("-1000"))).otherwise(F.concat(F.lit("="), (F.col("o_orderkey") % 900).cast("string")))
    return ind.rank_bands(o.select(F.col("o_orderpriority").alias("country_code"), F.year("o_orderdate").alias("year"), rank.alias("rank")))


def indicator_field_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = view(spark, sf_dir, "orders")
    return ind.field_sum(o.select(F.col("o_orderpriority").alias("country_code"), F.year("o_orderdate").alias("year"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("double")).alias("a"), (F.col("o_orderkey") % 10).cast("double").alias("b")), ["a", "b"])


def indicator_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = view(spark, sf_dir, "orders")
    pick = lambda n, *v: F.element_at(F.array(*map(F.lit, v)), (F.col("o_orderkey") % n + 1).cast("int"))
    return ind.dimension_totals(o.select("o_orderkey", pick(3, "SEX_T", "SEX_F", "SEX_M").alias("sex"), pick(4, "AGE_TOTAL", "AGE_GE15_X", "AGE_5", None).alias("classif"))).select("o_orderkey", "sex", "classif")


def gauge_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf scores beside those without size components."""
    rows = _rows(spark, sf_dir)
    nodes, countries = view_nodes(spark), view(spark, sf_dir, "nation").select(F.col("n_name").alias("country_code"))
    components = gauges.component_weights(view_components(spark), nodes)
    full, scores, _ = gauges.run(rows, nodes, components, view_alternatives(spark), countries, 1996, least=10)
    quality = gauges.quality_only(full.filter("score IS NOT NULL").drop("weight"), components)
    return _r(gauges.quality_view(scores.filter("path = 'trade.fast'"), quality), "score", "quality", "difference")


def gauge_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).select(F.col("indicator_code").alias("path"), "year", "country_code", F.col("value").alias("score"))
    return gauges.comparison(rows, ["HIGH", "LOW", "NONE"], 1996)


def gauge_agreement_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = view(spark, sf_dir, "nation").filter("n_regionkey < 2").select(F.col("n_name").alias("country_code"))
    rows = _rows(spark, sf_dir).filter("NOT (indicator_code = 'LOW' AND year % 3 = 0)")
    return _r(gauges.alternative_agreement(rows, view(spark, sf_dir, "tree_alternatives"), targets), "rho", "rho_target")


def gauge_cited_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    alternatives = view(spark, sf_dir, "tree_alternatives").withColumn("reason", F.when(F.col("tier") == "gap", "NO_SERIES"))
    return gauges.cited_ledger(view(spark, sf_dir, "tree_sources"), view(spark, sf_dir, "tree_cites"), alternatives, _rows(spark, sf_dir))


def gauge_weighted_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = view(spark, sf_dir, "nation").filter("n_nationkey <> 3").select(F.col("n_name").alias("country_code"), ((F.col("n_nationkey") + 1) / 400.0).alias("weight"))
    rows = _rows(spark, sf_dir).filter("indicator_code <> 'LOW' OR year < 1997 OR country_code < 'NATION_2'")
    return _r(gauges.weighted_health(rows, n, 25, 1999, least=20), "coverage", "weighted", "weighted_recent")


def gauge_basis_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    components = _components(spark, sf_dir).withColumn("basis", F.when(F.col("name") == "h", "stated").otherwise("equal"))
    return _r(gauges.basis_shares(view(spark, sf_dir, "tree_nodes"), components), "share")


def gauge_switch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).filter("NOT (indicator_code = 'LOW' AND country_code LIKE 'NATION_1%' AND year < 1997)")
    alternatives = view_alternatives(spark)
    chosen = gauges.coalesce_alternatives(gauges.percent_ranks(rows, alternatives, least=10), alternatives, rows, proxies=True)
    return gauges.switches_by_alternative(chosen, view(spark, sf_dir, "nation").filter("n_regionkey = 1").select(F.col("n_name").alias("country_code")))


def gauge_tree_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree without the node n3, with two references, a doubled alternative, an unknown reason and cites of dropped sources."""
    nodes = view(spark, sf_dir, "tree_nodes").filter("path <> 'n3'").withColumn("reference", F.when(F.col("path") == "n4", F.lit("n3")).when(F.col("path") == "n5", F.lit("n6")))
    a = view(spark, sf_dir, "tree_alternatives").withColumn("reason", F.when(F.col("tier") == "gap", F.concat(F.lit("R"), "leaf")))
    stated = view(spark, sf_dir, "tree_components").filter("leaf < 'n15'").select("leaf", "name", F.when(F.col("name") == "u", 40.0).otherwise(30.0).alias("weight"))
    found = gauges.tree_checks(nodes, _components(spark, sf_dir), a.unionByName(a.filter("leaf = 'n7' AND name = 'm'")), view(spark, sf_dir, "tree_cites"), view(spark, sf_dir, "tree_sources").filter("id > 2"), spark.createDataFrame([("Rn1",)], "reason string"), stated)
    return _r(found, "value")


def macro_filled_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = view(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey").cast("double")).alias("per_head"), F.col("o_totalprice").alias("total"), (F.col("o_custkey") % 4).cast("double").alias("heads"))
    return _r(macro.fill_ratio(o, "per_head", "total", "heads"), "per_head").select("o_orderkey", "per_head")


def _design(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Monthly returns of all products against the median product's, now and a month before."""
    months = view(spark, sf_dir, "prices").groupBy("product_id", F.trunc("date", "month").alias("date")).agg(F.avg("close").alias("close"))
    rets = stage(macro.returns(months))
    market = rets.groupBy("date").agg(F.median("ret").alias("market"))
    return macro.lagged_design(rets, market, ["market"]), ["market"]


def macro_summed_beta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensitivity to the market, now and lagged by a month, and their sum."""
    design, names = _design(spark, sf_dir)
    found = macro.summed_beta(macro.regress(design, k=3), names, lags=1)
    return _r(found.select("product_id", "n", F.col("beta")[1].alias("beta"), F.col("beta")[2].alias("lagged"), F.col("summed")["market"].alias("summed")), "beta", "lagged", "summed", digits=5)


def macro_robust_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients on the market, with errors that allow for one lag."""
    months = view(spark, sf_dir, "prices").groupBy("product_id", F.trunc("date", "month").alias("date")).agg(F.avg("close").alias("close"))
    rets = stage(macro.returns(months))
    design = macro.lagged_design(rets, rets.groupBy("date").agg(F.median("ret").alias("market")), ["market"], lags=0)
    found = macro.regress(design, k=2, hac_lags=1)
    return _r(found.select("product_id", "n", *(F.col(c)[i].alias(f"{c}{i}") for c in ("beta", "se") for i in (0, 1))), "beta0", "beta1", "se0", "se1", digits=5)


def capture_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider's rows after a run that was cut short, with the codes that are left to fetch."""
    rows = _rows(spark, sf_dir).select("indicator_code", "country_code", "year", "value")
    stored = rows.filter("indicator_code IN ('HIGH', 'LOW') AND year < 1998")
    kept = capture.append_pending(stored, rows.filter("indicator_code <> 'URGENT'").withColumn("value", F.col("value") + 1))
    left = capture.pending_codes(rows.select(F.col("indicator_code").alias("code")).distinct(), kept.select(F.col("indicator_code").alias("code")))
    return kept.unionByName(left.select(F.col("code").alias("indicator_code"), F.lit("left").alias("country_code"), F.lit(0).alias("year"), F.lit(0.0).alias("value")))


def capture_last_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source whose new snapshot is empty keeps its stored one; one with new rows takes those."""
    rows = _rows(spark, sf_dir).select("indicator_code", "country_code", "year", "value")
    a = capture.keep_last_good(rows.filter("year > 3000"), rows.filter("indicator_code = 'LOW'"))
    return a.unionByName(capture.keep_last_good(rows.filter("indicator_code = 'HIGH' AND year = 1996"), rows.filter("indicator_code = 'HIGH'")))


def indicator_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual values of HIGH, else projected ones of LOW."""
    of = lambda code: _rows(spark, sf_dir).filter(F.col("indicator_code") == code).select("country_code", "year", "value")
    return ind.combine_first(of("HIGH").filter("year % 2 = 0"), of("LOW")).select("country_code", "year", "value")


def indicator_weighted_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).filter("indicator_code <> 'LOW' OR country_code < 'NATION_2'")
    weights = ind.observation_weights(view(spark, sf_dir, "obs_country").withColumn("code", F.upper("metric")))
    return _r(ind.weighted_coverage(rows, weights), "weighted_coverage")


def gauge_rank_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).filter("indicator_code <> 'LOW' OR year < 1997")
    return gauges.rank_support(rows, gauges.years(_rows(spark, sf_dir), 1995))


def parse_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenient booleans, credit labels and finite numbers."""
    o = view(spark, sf_dir, "orders")
    pick = lambda *v: F.element_at(F.array(*map(F.lit, v)), (F.col("o_orderkey") % len(v) + 1).cast("int"))
    number = F.when(F.col("o_orderkey") % 4 == 0, F.lit(float("nan"))).when(F.col("o_orderkey") % 4 == 1, F.lit(float("inf"))).when(F.col("o_orderkey") % 4 == 2, F.col("o_totalprice"))
    return o.select("o_orderkey", parsers.lenient_boolean(pick("T", "no", " yes ", "0", "", "maybe", "FALSE")).alias("flag"), parsers.credit_label(pick("% Quality/AAA", " BB ", "% Quality-Not Rated")).alias("label"), parsers.finite(number).alias("finite"))


_A = _TA
_S = "s AS (SELECT s_suppkey + 5 AS product_id, CASE s_nationkey % 3 WHEN 0 THEN 'error' WHEN 1 THEN 'ok' ELSE 'no_data' END AS status, TIMESTAMP '2024-01-01' + to_hours(s_suppkey) AS last_checked_at FROM {supplier}), l AS (SELECT product_id, max(date) AS last_date FROM {prices} GROUP BY 1), x AS (SELECT product_id, last_date, status, last_checked_at FROM l FULL JOIN s USING (product_id))"
_RANKS = "k AS (SELECT *, rank() OVER (PARTITION BY {by} ORDER BY va) + (count(*) OVER (PARTITION BY {by}, va) - 1) / 2 AS ra, rank() OVER (PARTITION BY {by} ORDER BY vb) + (count(*) OVER (PARTITION BY {by}, vb) - 1) / 2 AS rb FROM {rows})"
_D = "d AS (SELECT CAST(o_custkey % 20 AS VARCHAR) AS country_code, o_orderpriority AS indicator_code, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_orderdate AS DATE) AS day, o_orderkey AS o, CAST(o_orderkey % 1000 AS DOUBLE) AS value FROM {orders})"

QUERIES = {
    "series_status": (
        series_status,
        f"""WITH {_BOTH}, {_COUNTS.replace('{new}', '(SELECT * FROM ' + _NEW + ' WHERE product_id % 4 <> 0 OR volume > 30)')}, p AS (SELECT *, CASE WHEN verdict = 'ok' THEN 'extend' WHEN {_KEPT} THEN 'replace' ELSE 'error' END AS action FROM v JOIN c USING (product_id))
SELECT product_id, action, CASE WHEN action = 'error' THEN 'error' ELSE 'ok' END AS status, CASE WHEN action = 'error' THEN 'kept ' || n_old || ' bars, refetch has ' || n_new END AS error_message FROM p""",
    ),
    "series_loaded": (series_loaded, f"WITH {_S} SELECT * FROM x"),
    "series_fresh": (series_fresh, f"WITH {_S} SELECT product_id, coalesce(status, '') <> 'error' AND (coalesce(last_date >= {TARGET}, false) OR (status IN ('ok', 'no_data') AND {NOW} - last_checked_at <= INTERVAL 24 HOUR) IS TRUE) AS fresh FROM x"),
    "keyed_store_upsert": (keyed_store_upsert, "SELECT product_id, family, metric, effective_date, value + CASE WHEN product_id % 10 = 3 THEN 1 ELSE 0 END AS value, CAST(date_source_depth + CASE WHEN product_id % 10 = 3 THEN 1 ELSE 0 END AS INTEGER) AS date_source_depth FROM {obs_scalar}"),
    "keyed_purge": (keyed_purge, "SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM {orders}) AS kept FROM {customer}"),
    "capture_preview_commit": (
        capture_preview_commit,
        f"""WITH o AS (SELECT product_id, arg_max(hash, snapshot_id) AS h, arg_max(created_at, snapshot_id) AS u FROM {{snapshots}} WHERE snapshot_id % 2 = 0 GROUP BY 1), n AS (SELECT product_id, arg_max(hash, snapshot_id) AS hash FROM {{snapshots}} WHERE product_id % 3 <> 0 GROUP BY 1)
SELECT product_id, coalesce(hash, h) AS hash, CASE WHEN hash IS NOT NULL AND hash IS DISTINCT FROM h THEN {NOW} ELSE u END AS updated_at, CASE WHEN hash IS NOT NULL THEN {NOW} ELSE u END AS last_checked_at FROM o FULL JOIN n USING (product_id)""",
    ),
    "capture_last_checked": (capture_last_checked, "SELECT product_id, url_prefix, max(created_at) AS last_checked_at FROM {snapshots} GROUP BY 1, 2"),
    "capture_listing": (capture_listing, "SELECT CAST(c_custkey AS VARCHAR) AS product_id, c_name AS symbol, CAST(c_nationkey AS VARCHAR) AS exchange_id FROM {customer} WHERE c_custkey % 7 <> 0"),
    "capture_details": (
        capture_details,
        "SELECT CAST(c_custkey AS VARCHAR) AS \"conId\", CASE WHEN c_custkey % 3 <> 1 THEN c_mktsegment END AS industry, '-' AS symbol, CASE WHEN c_custkey % 5 = 0 THEN 'IN' ELSE 'XS' END || c_custkey AS isin, CAST(NULL AS VARCHAR) AS \"longName\" FROM {customer}",
    ),
    "capture_targets": (capture_targets, "SELECT c_custkey AS product_id FROM {customer} WHERE c_custkey % 4 <> 0 AND c_nationkey NOT IN (3, 7)"),
    "capture_currencies": (capture_currencies, "SELECT DISTINCT c_mktsegment || c_nationkey AS currency FROM {customer} WHERE c_nationkey <> 0 AND c_mktsegment <> 'BUILDING' AND c_custkey % 9 <> 0"),
    "capture_themes": (
        capture_themes,
        """SELECT 'r' || r_regionkey AS theme_id, r_name AS name, CASE WHEN r_regionkey < 2 THEN 'top' END AS parent_id FROM {region} UNION ALL SELECT 'n' || n_nationkey, n_name, 'r' || n_regionkey FROM {nation} WHERE n_nationkey <> 4""",
    ),
    "indicator_tidy": (
        indicator_tidy,
        """SELECT CAST(o_orderkey AS VARCHAR) AS country_code, o_orderpriority AS indicator_code, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_custkey AS DOUBLE) AS value, false AS is_projection FROM {orders} WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND (o_orderpriority LIKE '%LOW' OR year(o_orderdate) = 1996)""",
    ),
    "indicator_projections": (indicator_projections, "SELECT country_code, indicator_code, year, year >= 1999 OR indicator_code = 'LOW' AS is_projection FROM {indicators}"),
    "indicator_long": (indicator_long, "SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(o_custkey + o_orderkey) AS DOUBLE) AS value FROM {orders} WHERE year(o_orderdate) BETWEEN 1995 AND 1998 GROUP BY 1, 2"),
    "indicator_names": (indicator_names, "SELECT c_custkey, 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS country_code FROM {customer} WHERE c_nationkey <> 7"),
    "indicator_year_end": (indicator_year_end, f'WITH {_D} SELECT country_code, indicator_code, year, last(value ORDER BY day, o) AS "last", round(avg(value), 6) AS mean FROM d GROUP BY 1, 2, 3'),
    "indicator_period_mean": (indicator_period_mean, f"WITH {_D} SELECT country_code, indicator_code, round(avg(value), 6) AS value, 2000 AS year FROM d WHERE day BETWEEN DATE '1996-02-10' AND DATE '1997-11-05' GROUP BY 1, 2"),
    "indicator_preferred": (
        indicator_preferred,
        f"WITH {_D} SELECT country_code, indicator_code, year, seasonal, value FROM (SELECT *, CASE o % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'S' ELSE '?' END AS seasonal FROM d) x QUALIFY row_number() OVER (PARTITION BY country_code, indicator_code, year ORDER BY CASE seasonal WHEN 'S' THEN 0 WHEN 'Y' THEN 1 ELSE 2 END, value) = 1",
    ),
    "indicator_cut_labels": (indicator_cut_labels, 'SELECT o_orderstatus AS "STATUS", o_orderkey AS "KEY", o_orderpriority FROM {orders}'),
    "indicator_allocated": (
        indicator_allocated,
        "SELECT currency, n_name AS country_code, year, value FROM (SELECT source_currency AS currency, CAST(year(date) AS INTEGER) AS year, count(*) AS value FROM {fx} GROUP BY 1, 2) s JOIN {nation} ON currency = CASE n_nationkey % 3 WHEN 0 THEN 'URGENT' WHEN 1 THEN 'HIGH' END",
    ),
    "indicator_rank_bands": (indicator_rank_bands, "SELECT o_orderpriority AS country_code, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) FILTER (o_orderkey % 900 <= 100) AS top_100, count(*) FILTER (o_orderkey % 900 <= 500) AS top_500 FROM {orders} GROUP BY 1, 2"),
    "indicator_field_sum": (indicator_field_sum, "SELECT o_orderpriority AS country_code, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE 0 END + o_orderkey % 10) AS DOUBLE) AS value FROM {orders} GROUP BY 1, 2"),
    "indicator_totals": (indicator_totals, "SELECT o_orderkey, 'SEX_T' AS sex, CASE o_orderkey % 4 WHEN 0 THEN 'AGE_TOTAL' WHEN 1 THEN 'AGE_GE15_X' END AS classif FROM {orders} WHERE o_orderkey % 3 = 0 AND o_orderkey % 4 <> 2"),
    "gauge_quality": (
        gauge_quality,
        """WITH span AS (SELECT DISTINCT year FROM {indicators} WHERE NOT is_projection AND year >= 1996), v AS (SELECT indicator_code, year, country_code, value * CASE WHEN indicator_code = 'MEDIUM' THEN -1 ELSE 1 END AS v FROM {indicators} JOIN span USING (year)),
k AS (SELECT *, count(*) OVER (PARTITION BY indicator_code, year) AS n, rank() OVER (PARTITION BY indicator_code, year ORDER BY v) + (count(*) OVER (PARTITION BY indicator_code, year, v) - 1) / 2 AS k FROM v), s AS (SELECT indicator_code, year, country_code, (k - 1) / (n - 1) * 100 AS s FROM k WHERE n >= 10),
w AS (SELECT * FROM (VALUES ('URGENT', 0.4, 0.0), ('HIGH', 0.3, 0.3), ('MEDIUM', 0.3, 0.3)) t(indicator_code, w, q)), g AS (SELECT year, n_name AS country_code FROM span CROSS JOIN {nation}),
x AS (SELECT year, country_code, sum(w * s) / sum(w) FILTER (s IS NOT NULL) AS score, sum(q * s) FILTER (q > 0) / sum(q) FILTER (s IS NOT NULL AND q > 0) AS quality FROM g CROSS JOIN w LEFT JOIN s USING (indicator_code, year, country_code) GROUP BY 1, 2)
SELECT 'trade.fast' AS path, year, country_code, round(score, 6) AS score, round(quality, 6) AS quality, round(quality - score, 6) AS difference FROM x""",
    ),
    "gauge_comparison": (gauge_comparison, """SELECT country_code, max(value) FILTER (indicator_code = 'HIGH') AS "HIGH", max(value) FILTER (indicator_code = 'LOW') AS "LOW", CAST(NULL AS DOUBLE) AS "NONE" FROM {indicators} WHERE year = 1996 GROUP BY 1"""),
    "gauge_agreement_targets": (
        gauge_agreement_targets,
        f"""WITH v AS (SELECT a.leaf, a.name, a.idx, i.country_code, i.year, value * direction AS v, n_regionkey < 2 AS t FROM {_A} a JOIN {{indicators}} i ON i.indicator_code = a.code JOIN {{nation}} ON n_name = country_code WHERE NOT (indicator_code = 'LOW' AND year % 3 = 0)),
j AS (SELECT x.leaf, x.name, x.idx AS a, y.idx AS b, x.v AS va, y.v AS vb, x.t FROM v x JOIN v y ON x.leaf = y.leaf AND x.name = y.name AND x.country_code = y.country_code AND x.year = y.year AND x.idx < y.idx), m AS (SELECT * FROM j WHERE t),
{_RANKS.format(by='leaf, name, a, b', rows='j')}, {_RANKS.format(by='leaf, name, a, b', rows='m').replace('k AS', 'q AS', 1)}
SELECT k.*, n_target, CASE WHEN n_target >= 5 THEN rho_target END AS rho_target FROM (SELECT leaf, name, a, b, count(*) AS n, round(corr(ra, rb), 6) AS rho FROM k GROUP BY 1, 2, 3, 4) k LEFT JOIN (SELECT leaf, name, a, b, count(*) AS n_target, round(corr(ra, rb), 6) AS rho_target FROM q GROUP BY 1, 2, 3, 4) q USING (leaf, name, a, b) WHERE n >= 5""",
    ),
    "gauge_cited_ledger": (
        gauge_cited_ledger,
        f"""WITH d AS (SELECT indicator_code AS code, count(DISTINCT country_code) AS n, max(year) AS last FROM {{indicators}} GROUP BY 1), a AS (SELECT id, c.leaf, c.name, t.code, t.tier, d.n, d.last FROM {{tree_cites}} c JOIN {_A} t USING (leaf, name) LEFT JOIN d USING (code)),
f AS (SELECT id, count(DISTINCT leaf || '/' || name) AS n_components, coalesce(string_agg(DISTINCT code, ', ' ORDER BY code) FILTER (n IS NOT NULL), '') AS codes_with_data, coalesce(max(n), 0) AS n_countries, max(last) AS latest_year, min(CASE tier WHEN 'exact' THEN 0 WHEN 'substitute' THEN 1 WHEN 'proxy' THEN 2 END) FILTER (n IS NOT NULL) AS best, bool_or(tier = 'gap') AS gap FROM a GROUP BY 1)
SELECT id, coalesce(n_components, 0) AS n_components, coalesce(codes_with_data, '') AS codes_with_data, coalesce(n_countries, 0) AS n_countries, latest_year, CASE WHEN n_components IS NULL THEN 'skipped' WHEN best = 0 THEN 'live' WHEN best = 1 THEN 'substitute' WHEN best = 2 THEN 'proxy' WHEN gap THEN 'gap' ELSE 'dead' END AS status,
CASE WHEN n_components IS NULL THEN coalesce(reason, 'NO_CONSUMER') WHEN best IS NOT NULL THEN '' WHEN gap THEN 'NO_SERIES' ELSE 'NO_ROWS' END AS reason FROM {{tree_sources}} LEFT JOIN f USING (id)""",
    ),
    "gauge_weighted_health": (
        gauge_weighted_health,
        """WITH r AS (SELECT * FROM {indicators} WHERE indicator_code <> 'LOW' OR year < 1997 OR country_code < 'NATION_2'), a AS (SELECT * FROM r WHERE NOT is_projection OR indicator_code NOT IN (SELECT indicator_code FROM r WHERE NOT is_projection)), w AS (SELECT n_name AS country_code, (n_nationkey + 1) / 400.0 AS weight FROM {nation} WHERE n_nationkey <> 3),
p AS (SELECT indicator_code, country_code, max(year) AS last FROM a GROUP BY 1, 2), y AS (SELECT indicator_code, year, count(DISTINCT country_code) AS n FROM a GROUP BY 1, 2)
SELECT indicator_code, count(*) AS countries, round(count(*) / 25, 6) AS coverage, round(coalesce(sum(weight), 0), 6) AS weighted, round(coalesce(sum(weight) FILTER (last >= 1999), 0), 6) AS weighted_recent, max(last) AS latest_year, (SELECT min(year) FROM y WHERE y.indicator_code = p.indicator_code AND n >= 20) AS first_valid_year,
(SELECT count(DISTINCT value) < 5 FROM a WHERE a.indicator_code = p.indicator_code) AS degenerate, (SELECT bool_or(is_projection) FROM r WHERE r.indicator_code = p.indicator_code) AS has_projection FROM p LEFT JOIN w USING (country_code) GROUP BY indicator_code""",
    ),
    "gauge_basis_shares": (gauge_basis_shares, f"WITH {_EFF}, {_CW} SELECT gauge, value, round(w / sum(w) OVER (PARTITION BY gauge), 6) AS share FROM (SELECT gauge, CASE WHEN name = 'h' THEN 'stated' ELSE 'equal' END AS value, sum(effective * cw.weight) AS w FROM cw JOIN eff ON eff.path = cw.leaf WHERE gauge IS NOT NULL GROUP BY 1, 2) x"),
    "gauge_switch_counts": (
        gauge_switch_counts,
        """WITH i AS (SELECT * FROM {indicators} WHERE NOT (indicator_code = 'LOW' AND country_code LIKE 'NATION_1%' AND year < 1997)), c AS (SELECT * FROM (VALUES ('trade.fast', 'u', 0, 'URGENT'), ('trade.fast', 'h', 1, 'HIGH'), ('trade.fast', 'm', 0, 'MEDIUM'), ('trade.slow', 'l', 0, 'LOW'), ('trade.slow', 'l', 1, 'HIGH'), ('mood.calm', 'x', 0, 'NOT SPECIFIED')) t(leaf, name, idx, code)),
b AS (SELECT leaf, name, country_code, year, min(idx) AS idx FROM c JOIN i ON code = indicator_code GROUP BY 1, 2, 3, 4), s AS (SELECT leaf, name, count(*) AS switching, count(*) FILTER (n_regionkey = 1) AS switching_targets FROM (SELECT leaf, name, country_code FROM b GROUP BY 1, 2, 3 HAVING count(DISTINCT idx) > 1) x JOIN {nation} ON n_name = country_code GROUP BY 1, 2)
SELECT leaf, name, idx, count(*) AS country_years, coalesce(any_value(switching), 0) AS switching, coalesce(any_value(switching_targets), 0) AS switching_targets FROM b LEFT JOIN s USING (leaf, name) GROUP BY 1, 2, 3""",
    ),
    "gauge_tree_checks": (
        gauge_tree_checks,
        f"""WITH {_CW}, n AS (SELECT path, CASE path WHEN 'n4' THEN 'n3' WHEN 'n5' THEN 'n6' END AS reference FROM {{tree_nodes}} WHERE path <> 'n3'), a AS (SELECT * FROM {_A} UNION ALL SELECT * FROM {_A} WHERE leaf = 'n7' AND name = 'm'),
st AS (SELECT leaf, name, w / sum(w) OVER (PARTITION BY leaf) AS share FROM (SELECT leaf, name, CASE WHEN name = 'u' THEN 40.0 ELSE 30.0 END AS w FROM {{tree_components}} WHERE leaf < 'n15') x), ap AS (SELECT st.leaf, max(abs(cw.weight - share)) AS apart, count(cw.weight) AS matched FROM st LEFT JOIN cw ON cw.leaf = st.leaf AND cw.name = st.name GROUP BY 1)
SELECT 'duplicate code' AS "check", leaf || '/' || name || '/' || code AS item, CAST(NULL AS DOUBLE) AS value FROM a GROUP BY leaf, name, code HAVING count(*) > 1 UNION ALL SELECT 'unresolved reference', reference, NULL FROM n WHERE reference IS NOT NULL AND reference NOT IN (SELECT path FROM n)
UNION ALL SELECT DISTINCT 'unknown leaf', leaf, NULL FROM {{tree_components}} WHERE leaf NOT IN (SELECT path FROM n) UNION ALL SELECT 'unknown reason', leaf || '/' || name || '/R' || leaf, NULL FROM a WHERE tier = 'gap' AND leaf <> 'n1'
UNION ALL SELECT 'unknown source', leaf || '/' || name || '/' || id, NULL FROM {{tree_cites}} WHERE id <= 2 UNION ALL SELECT 'weight difference', leaf, round(apart, 6) FROM ap UNION ALL SELECT 'weights matched', leaf, matched FROM ap""",
    ),
    "macro_filled_ratio": (macro_filled_ratio, "SELECT o_orderkey, round(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey WHEN o_custkey % 4 <> 0 THEN o_totalprice / (o_custkey % 4) END, 6) AS per_head FROM {orders}"),
    "macro_summed_beta": (
        macro_summed_beta,
        """WITH m AS (SELECT product_id, CAST(date_trunc('month', date) AS DATE) AS date, avg(close) AS close FROM {prices} GROUP BY 1, 2), r AS (SELECT product_id, date, close / lag(close) OVER (PARTITION BY product_id ORDER BY date) - 1 AS y FROM m), f AS (SELECT date, median(y) AS x FROM r WHERE y IS NOT NULL GROUP BY 1), g AS (SELECT *, lag(x) OVER (ORDER BY date) AS z FROM f),
s AS (SELECT product_id, count(*) AS n, covar_pop(x, x) AS xx, covar_pop(z, z) AS zz, covar_pop(x, z) AS xz, covar_pop(x, y) AS xy, covar_pop(z, y) AS zy FROM r JOIN g USING (date) WHERE y IS NOT NULL AND z IS NOT NULL GROUP BY 1)
SELECT product_id, n, round((zz * xy - xz * zy) / (xx * zz - xz * xz), 5) AS beta, round((xx * zy - xz * xy) / (xx * zz - xz * xz), 5) AS lagged, round((zz * xy - xz * zy + xx * zy - xz * xy) / (xx * zz - xz * xz), 5) AS summed FROM s""",
    ),
    "macro_robust_errors": (
        macro_robust_errors,
        """WITH m AS (SELECT product_id, CAST(date_trunc('month', date) AS DATE) AS date, avg(close) AS close FROM {prices} GROUP BY 1, 2), r AS (SELECT product_id, date, close / lag(close) OVER (PARTITION BY product_id ORDER BY date) - 1 AS y FROM m), f AS (SELECT date, median(y) AS x FROM r WHERE y IS NOT NULL GROUP BY 1),
d AS (SELECT product_id, date, y, x FROM r JOIN f USING (date) WHERE y IS NOT NULL), s AS (SELECT product_id, count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM d GROUP BY 1), e AS (SELECT product_id, date, x, y - a - b * x AS e FROM d JOIN s USING (product_id)),
l AS (SELECT *, lag(e) OVER w AS ep, lag(x) OVER w AS xp FROM e WINDOW w AS (PARTITION BY product_id ORDER BY date)), v AS (SELECT product_id, sum(e * e) + sum(e * ep) AS s00, sum(e * e * x) + 0.5 * (sum(e * ep * xp) + sum(ep * e * x)) AS s01, sum(e * e * x * x) + sum(e * x * ep * xp) AS s11 FROM l GROUP BY 1)
SELECT product_id, n, round(a, 5) AS beta0, round(b, 5) AS beta1, round(sqrt(greatest(sxx * sxx * s00 - 2 * sxx * sx * s01 + sx * sx * s11, 0)) / (n * sxx - sx * sx), 5) AS se0, round(sqrt(greatest(sx * sx * s00 - 2 * n * sx * s01 + n * n * s11, 0)) / (n * sxx - sx * sx), 5) AS se1 FROM s JOIN v USING (product_id)""",
    ),
    "capture_pending": (
        capture_pending,
        "SELECT indicator_code, country_code, year, CASE WHEN indicator_code IN ('HIGH', 'LOW') AND year < 1998 THEN value ELSE value + 1 END AS value FROM {indicators} WHERE indicator_code <> 'URGENT' UNION ALL SELECT DISTINCT indicator_code, 'left', 0, 0 FROM {indicators} WHERE indicator_code = 'URGENT'",
    ),
    "capture_last_good": (capture_last_good, "SELECT indicator_code, country_code, year, value FROM {indicators} WHERE indicator_code = 'LOW' OR (indicator_code = 'HIGH' AND year = 1996)"),
    "indicator_combined": (indicator_combined, "SELECT country_code, year, coalesce(a.value, b.value) AS value FROM (SELECT * FROM {indicators} WHERE indicator_code = 'HIGH' AND year % 2 = 0) a FULL JOIN (SELECT * FROM {indicators} WHERE indicator_code = 'LOW') b USING (country_code, year)"),
    "indicator_weighted_coverage": (
        indicator_weighted_coverage,
        "WITH w AS (SELECT upper(metric) AS country_code, count(*) / sum(count(*)) OVER () AS weight FROM {obs_country} GROUP BY 1) SELECT indicator_code, round(sum(weight), 6) AS weighted_coverage FROM (SELECT DISTINCT indicator_code, country_code FROM {indicators} WHERE indicator_code <> 'LOW' OR country_code < 'NATION_2') x JOIN w USING (country_code) GROUP BY 1",
    ),
    "gauge_rank_support": (
        gauge_rank_support,
        "WITH y AS (SELECT DISTINCT year FROM {indicators} WHERE NOT is_projection AND year >= 1995), r AS (SELECT * FROM {indicators} WHERE indicator_code <> 'LOW' OR year < 1997) SELECT c.indicator_code, y.year, count(DISTINCT r.country_code) AS n FROM (SELECT DISTINCT indicator_code FROM r) c CROSS JOIN y LEFT JOIN r ON r.indicator_code = c.indicator_code AND r.year = y.year GROUP BY 1, 2",
    ),
    "parse_labels": (
        parse_labels,
        "SELECT o_orderkey, list_extract([true, false, true, false, false, true, false], CAST(o_orderkey % 7 + 1 AS INTEGER)) AS flag, list_extract(['AAA', 'BB', 'Not Rated'], CAST(o_orderkey % 3 + 1 AS INTEGER)) AS label, o_orderkey % 4 = 2 AS finite FROM {orders}",
    ),
}
