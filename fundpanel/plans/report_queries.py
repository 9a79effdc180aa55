"""Queries of the gauge reports, vetting rules, currency series and tree weights, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, capture, gauges, series
from ..operators import indicators as ind
from .adapters import view
from .indicator_queries import _r, _rows


def indicator_five_row_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URGENT where its year is even, else LOW + HIGH, less the same two rows earlier."""
    rows = _rows(spark, sf_dir).filter("indicator_code <> 'URGENT' OR year % 2 = 0")
    return _r(ind.five_row_difference(rows, "URGENT", ["LOW", "HIGH"], "d", lag=2), "value", digits=2)


def indicator_net_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ind.net_exports(_rows(spark, sf_dir), {"net_low": ("LOW", "MEDIUM"), "net_medium": ("MEDIUM", "LOW")}, "URGENT", "HIGH", "NOT SPECIFIED"), "value", digits=2)


def indicator_vetting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tiers for all codes but with gaps; MEDIUM is made constant."""
    rows = _rows(spark, sf_dir).filter("indicator_code <> 'LOW' OR year < 1997").withColumn("value", F.when(F.col("indicator_code") == "MEDIUM", 1.0).otherwise(F.col("value")))
    recent = ind.coverage(rows.filter("year >= 1999"), 25, 1999).select("indicator_code", F.col("fill").alias("recent_fill"), F.col("per_country").alias("recent_per_country"))
    parts = ind.coverage(rows, 25, 1999).join(ind.degeneracy(rows), "indicator_code").join(ind.variance_parts(rows), "indicator_code").join(rows.groupBy("indicator_code").agg(F.stddev_samp("value").alias("spread")), "indicator_code").join(recent, "indicator_code", "left")
    limits = {"coverage": 0.5, "recent_coverage": 0.5, "n_distinct": 5, "modal_share": 0.9, "zero_share": 0.5, "recent_fill": 0.3, "recent_per_country": 2, "fill": 0.3, "per_country": 3}
    return ind.vetting_gates(parts, limits).select("indicator_code", "g_coverage", "g_recent", "g_varied", "g_recent_fill", "g_per_country", "g_moves", "level_ok", "change_ok")


def indicator_scale_dependent(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = view(spark, sf_dir, "orders").select("o_orderkey", F.concat("o_orderpriority", F.element_at(F.array(*map(F.lit, (" (Current US$)", " (constant 2015)", " per capita (current US$)", ", % of GDP (current)"))), (F.col("o_orderkey") % 4 + 1).cast("int"))).alias("label"))
    return labels.select("o_orderkey", ind.scale_dependent(F.col("label")).alias("scale_dependent"))


def indicator_fence_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ind.fence_sweep(view(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"], [0.25, 0.5, 1.0], "c_mktsegment")


def gauge_tree_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of weights down a tree of regions and nations weighted by customers."""
    return _r(gauges.effective_weights(view(spark, sf_dir, "tree_nodes")), "effective", digits=9)


def _components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gauges.component_weights(view(spark, sf_dir, "tree_components"), view(spark, sf_dir, "tree_nodes"))


def gauge_component_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(_components(spark, sf_dir), "weight", digits=9)


def gauge_weight_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(gauges.weight_sums(view(spark, sf_dir, "tree_nodes"), _components(spark, sf_dir)), "total", digits=6)


def gauge_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes that neither the tree nor the list of carried ones uses."""
    return gauges.retained(_rows(spark, sf_dir), view(spark, sf_dir, "tree_alternatives").filter("code <> 'LOW'"), _rows(spark, sf_dir).filter("year > 2020").select(F.col("indicator_code").alias("code")))[1]


def gauge_weight_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(gauges.weight_shares(view(spark, sf_dir, "tree_nodes"), _components(spark, sf_dir), view(spark, sf_dir, "tree_alternatives"), _rows(spark, sf_dir)), "share")


def gauge_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).withColumn("source", F.when(F.col("indicator_code") == "LOW", "b").otherwise("a"))
    alternatives = view(spark, sf_dir, "tree_alternatives").filter("leaf < 'n2'")
    carried = rows.filter("indicator_code LIKE 'N%' AND year > 1996").select(F.col("indicator_code").alias("code"))
    return gauges.registry(rows, alternatives, carried, rows.filter("indicator_code LIKE 'H%'").select(F.col("indicator_code").alias("code")))


def gauge_alternative_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = ind.observation_weights(view(spark, sf_dir, "obs_country").withColumn("code", F.upper("metric")))
    return _r(gauges.alternative_coverage(view(spark, sf_dir, "tree_alternatives"), _rows(spark, sf_dir).filter("value > 2000000"), weights), "weighted")


def gauge_source_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gauges.source_ledger(view(spark, sf_dir, "tree_alternatives"), _rows(spark, sf_dir))


def gauge_direction_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gauges.direction_map(view(spark, sf_dir, "tree_alternatives"), "MEDI|URG")


def gauge_structure_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = view(spark, sf_dir, "tree_nodes").filter("path <> 'n3'").withColumn("reference", F.when(F.col("path") == "n4", F.lit("n3")).when(F.col("path") == "n5", F.lit("n6")))
    alternatives = view(spark, sf_dir, "tree_alternatives")
    return gauges.structure_checks(nodes, view(spark, sf_dir, "tree_components"), alternatives.unionByName(alternatives.filter("leaf = 'n7' AND name = 'm'")))


def _scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All years and nations for each leaf's component m, its score the value of MEDIUM where that is large."""
    rows = _rows(spark, sf_dir)
    grid = rows.select("year").distinct().join(view(spark, sf_dir, "nation").select(F.col("n_name").alias("country_code")), how="cross")
    have = rows.filter("indicator_code = 'MEDIUM' AND value > 2500000").select("year", "country_code", F.col("value").alias("score"))
    leaves = view(spark, sf_dir, "tree_components").filter("name = 'm'").select("leaf", "name")
    return leaves.join(grid.join(have, ["year", "country_code"], "left"), how="cross"), rows


def gauge_proxy_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, rows = _scored(spark, sf_dir)
    return gauges.proxy_candidates(view(spark, sf_dir, "tree_alternatives"), scored, rows, view(spark, sf_dir, "nation").filter("n_regionkey = 1").select(F.col("n_name").alias("country_code")))


def gauge_published_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of HIGH in 1997 against the mean balance of the nation's customers."""
    scores = _rows(spark, sf_dir).select(F.col("indicator_code").alias("path"), "year", "country_code", F.col("value").alias("score"), (F.length("country_code") / 10.0 - 0.25).alias("weight_present"))
    published = view(spark, sf_dir, "customer").join(view(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("country_code")).agg(F.avg("c_acctbal").alias("score"))
    return _r(gauges.published_agreement(scores, published, "HIGH", 1997), "rho")


def gauge_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir)
    published = rows.withColumn("value", F.col("value") * (1 + (F.col("year") - 1995) * 0.1))
    return _r(gauges.deviation(rows, published), "median", "largest", "within")


def gauge_switches(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = _rows(spark, sf_dir).select(F.col("indicator_code").alias("leaf"), F.lit("x").alias("name"), "country_code", "year", (F.col("year") % 3).alias("idx"))
    return gauges.alternative_switches(chosen.filter("idx < 2 OR leaf <> 'LOW'"))


def capture_table_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "snapshots").select(F.col("created_at").cast("timestamp").alias("last_checked_at"))
    return capture.table_freshness(rows, F.to_timestamp(F.lit("2024-01-31 00:00:00")), 72).select(F.unix_seconds("last_checked_at").alias("seconds"), "fresh")


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of a pair as a source delivers them: odd column names, dates as digits or ISO text, missing closes."""
    bars = view(spark, sf_dir, "fx").select("source_currency", "target_currency", F.when(F.dayofmonth("date") % 2 == 0, F.date_format("date", "yyyyMMdd")).otherwise(F.concat(F.col("date").cast("string"), F.lit("T00:00:00Z"))).alias("Date"), F.when(F.dayofmonth("date") == 13, float("nan")).otherwise(F.col("close")).alias("Close"))
    return series.normalise_rates(bars.select("Date", "Close", F.col("source_currency").alias("S"), F.col("target_currency").alias("T")), F.when(F.col("s") == "HIGH", F.lit("CNH")).otherwise(F.col("s")), F.col("t"), F.to_date(F.lit("2000-06-30")))


def fx_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rates(spark, sf_dir).select(series.priced_currency(F.col("source_currency")).alias("priced_as"), "source_currency", "target_currency", "date", F.round("close", 9).alias("close"))


def fx_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last dates and counts of series whose entity is a pair."""
    return series.extent(_rates(spark, sf_dir), series.RATES)


def fx_historical_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _rates(spark, sf_dir).select("source_currency", "target_currency", "date", "close")
    new = old.withColumn("close", F.when((F.col("source_currency") == "LOW") & (F.year("date") == 1996), F.col("close") * 1.5).otherwise(F.col("close")))
    return series.historical_change(old, new, series.RATES)


def audit_feature_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "observations").select("product_id", F.concat_ws("_", "family", "metric").alias("feature_id"), F.col("effective_date").alias("as_of_date"), "value")
    return audit.feature_summary(rows)


_TN, _TC, _TA = "{tree_nodes}", "{tree_components}", "{tree_alternatives}"
_EFF = f"e1 AS (SELECT path, 0 AS depth, weight AS effective, NULL AS gauge FROM {_TN} WHERE parent IS NULL), e2 AS (SELECT n.path, 1 AS depth, effective * n.weight AS effective, n.path AS gauge FROM {_TN} n JOIN e1 ON n.parent = e1.path), e3 AS (SELECT n.path, 2 AS depth, effective * n.weight AS effective, e2.gauge FROM {_TN} n JOIN e2 ON n.parent = e2.path), eff AS (SELECT * FROM e1 UNION ALL SELECT * FROM e2 UNION ALL SELECT * FROM e3)"
_CW = f"cw AS (SELECT c.leaf, c.name, c.kind, CASE WHEN kind = 'size' THEN n.size_share ELSE 1 - n.size_share END / count(*) OVER (PARTITION BY c.leaf, c.kind) AS weight FROM {_TC} c JOIN {_TN} n ON n.path = c.leaf)"
_ALIVE = "alive AS (SELECT DISTINCT indicator_code AS code FROM {indicators})"
_RATES = """rt AS (SELECT CASE WHEN source_currency = 'HIGH' THEN 'CNH' ELSE source_currency END AS source_currency, target_currency, date, close FROM {fx} WHERE day(date) <> 13 AND date <= DATE '2000-06-30')"""
_VET = "r AS (SELECT country_code, indicator_code, year, CASE WHEN indicator_code = 'MEDIUM' THEN 1 ELSE value END AS value FROM {indicators} WHERE indicator_code <> 'LOW' OR year < 1997)"

QUERIES = {
    "indicator_five_row_difference": (
        indicator_five_row_difference,
        """WITH a AS (SELECT country_code, year, max(value) AS a FROM {indicators} WHERE indicator_code = 'URGENT' AND year % 2 = 0 GROUP BY 1, 2), l AS (SELECT country_code, year, max(value) AS l FROM {indicators} WHERE indicator_code = 'LOW' GROUP BY 1, 2), h AS (SELECT country_code, year, max(value) AS h FROM {indicators} WHERE indicator_code = 'HIGH' GROUP BY 1, 2),
v AS (SELECT country_code, year, coalesce(a, l + h) AS v FROM a FULL JOIN (SELECT * FROM l JOIN h USING (country_code, year)) b USING (country_code, year)), y AS (SELECT year, row_number() OVER (ORDER BY year) AS i FROM (SELECT DISTINCT year FROM v)), g AS (SELECT * FROM v JOIN y USING (year))
SELECT x.country_code, 'd' AS indicator_code, x.year, round(x.v - z.v, 2) AS value FROM g x JOIN g z ON x.country_code = z.country_code AND z.i = x.i - 2 WHERE x.v - z.v IS NOT NULL""",
    ),
    "indicator_net_exports": (
        indicator_net_exports,
        """WITH w AS (SELECT country_code, year, max(value) FILTER (indicator_code = 'LOW') AS l, max(value) FILTER (indicator_code = 'MEDIUM') AS m, max(value) FILTER (indicator_code = 'URGENT') AS u, max(value) FILTER (indicator_code = 'HIGH') AS h, max(value) FILTER (indicator_code = 'NOT SPECIFIED') AS n FROM {indicators} GROUP BY 1, 2),
x AS (SELECT country_code, 'net_low' AS indicator_code, year, (l / 100 * u - m / 100 * h) / n * 100 AS value FROM w UNION ALL SELECT country_code, 'net_medium', year, (m / 100 * u - l / 100 * h) / n * 100 FROM w) SELECT country_code, indicator_code, year, round(value, 2) AS value FROM x WHERE value IS NOT NULL""",
    ),
    "indicator_vetting": (
        indicator_vetting,
        f"""WITH {_VET}, a AS (SELECT indicator_code, count(DISTINCT country_code) / 25 AS coverage, count(DISTINCT country_code) FILTER (year >= 1999) / 25 AS recent, count(*) / ((max(year) - min(year) + 1) * 25) AS fill, count(*) / count(DISTINCT country_code) AS per_country, stddev_samp(value) AS spread FROM r GROUP BY 1),
b AS (SELECT indicator_code, count(*) / ((max(year) - min(year) + 1) * 25) AS rfill, count(*) / count(DISTINCT country_code) AS rper FROM r WHERE year >= 1999 GROUP BY 1), c AS (SELECT indicator_code, value, count(*) AS n FROM r GROUP BY 1, 2), d AS (SELECT indicator_code, count(*) AS nd, max(n) / sum(n) AS modal, coalesce(sum(n) FILTER (value = 0), 0) / sum(n) AS zero FROM c GROUP BY 1),
e AS (SELECT indicator_code, avg(v) AS within FROM (SELECT indicator_code, country_code, var_samp(value) AS v FROM r GROUP BY 1, 2) GROUP BY 1),
g AS (SELECT indicator_code, coalesce(coverage >= 0.5, false) AS g_coverage, coalesce(recent >= 0.5, false) AS g_recent, coalesce(nd >= 5 AND modal <= 0.9 AND zero <= 0.5 AND spread > 0, false) AS g_varied, coalesce(rfill >= 0.3, false) AS g_recent_fill, coalesce(rper >= 2, false) AS rp, coalesce(fill >= 0.3, false) AS gf, coalesce(per_country >= 3, false) AS g_per_country, coalesce(within > 0, false) AS g_moves
  FROM a LEFT JOIN b USING (indicator_code) JOIN d USING (indicator_code) JOIN e USING (indicator_code))
SELECT indicator_code, g_coverage, g_recent, g_varied, g_recent_fill, g_per_country, g_moves, g_coverage AND g_recent AND g_varied AS level_ok, g_coverage AND g_recent AND g_varied AND g_recent_fill AND rp AND gf AND g_per_country AND g_moves AS change_ok FROM g""",
    ),
    "indicator_scale_dependent": (indicator_scale_dependent, r"""WITH l AS (SELECT o_orderkey, lower(o_orderpriority || list_extract([' (Current US$)', ' (constant 2015)', ' per capita (current US$)', ', % of GDP (current)'], CAST(o_orderkey % 4 + 1 AS INTEGER))) AS label FROM {orders})
SELECT o_orderkey, (contains(label, '(current') OR contains(label, '(constant')) AND NOT (contains(label, 'per capita') OR contains(label, '% of') OR regexp_matches(label, 'per \d')) AS scale_dependent FROM l"""),
    "indicator_fence_sweep": (
        indicator_fence_sweep,
        """WITH q AS (SELECT quantile_cont(c_acctbal, 0.5) - z * (quantile_cont(c_acctbal, 0.75) - quantile_cont(c_acctbal, 0.25)) AS a, quantile_cont(c_nationkey, 0.5) - z * (quantile_cont(c_nationkey, 0.75) - quantile_cont(c_nationkey, 0.25)) AS b, z FROM {customer}, (VALUES (0.25), (0.5), (1.0)) t(z) GROUP BY z),
f AS (SELECT CAST(z AS DOUBLE) AS z, c_acctbal, c_nationkey, c_mktsegment, c_acctbal < a OR c_nationkey < b AS bad FROM {customer}, q)
SELECT z, count(*) FILTER (NOT bad) AS kept, count(*) FILTER (bad) AS failed, min(c_acctbal) FILTER (NOT bad) AS least_c_acctbal, min(c_nationkey) FILTER (NOT bad) AS least_c_nationkey, count(DISTINCT c_mktsegment) FILTER (NOT bad) AS n_different FROM f GROUP BY 1""",
    ),
    "gauge_tree_weights": (gauge_tree_weights, f"WITH {_EFF} SELECT path, depth, round(effective, 9) AS effective FROM eff"),
    "gauge_component_weights": (gauge_component_weights, f"WITH {_CW} SELECT leaf, name, kind, round(weight, 9) AS weight FROM cw"),
    "gauge_weight_sums": (gauge_weight_sums, f"WITH {_CW}, s AS (SELECT parent, sum(weight) AS t FROM {_TN} WHERE parent IS NOT NULL GROUP BY 1 UNION ALL SELECT leaf, sum(weight) FROM cw GROUP BY 1) SELECT parent, round(t, 6) AS total, abs(t - 1) <= 0.001 AS ok FROM s"),
    "gauge_retained": (gauge_retained, f"SELECT DISTINCT indicator_code AS code FROM {{indicators}} WHERE indicator_code NOT IN (SELECT code FROM {_TA} WHERE code <> 'LOW') AND indicator_code NOT IN (SELECT indicator_code FROM {{indicators}} WHERE year > 2020)"),
    "gauge_weight_shares": (
        gauge_weight_shares,
        f"""WITH {_EFF}, {_CW}, {_ALIVE}, st AS (SELECT leaf, name, bool_or(alive.code IS NOT NULL) AS live, arg_min(tier, idx) FILTER (alive.code IS NOT NULL) AS t, arg_min(tier, idx) AS f FROM {_TA} a LEFT JOIN alive ON alive.code = a.code GROUP BY 1, 2),
x AS (SELECT eff.gauge, eff.effective * cw.weight AS w, CASE WHEN live THEN 'live' WHEN f = 'gap' THEN 'gap' ELSE 'dead' END AS state, CASE WHEN live THEN t ELSE 'gap' END AS tier FROM cw JOIN eff ON eff.path = cw.leaf JOIN st USING (leaf, name) WHERE gauge IS NOT NULL),
y AS (SELECT gauge, 'state' AS "by", state AS value, sum(w) AS w FROM x GROUP BY 1, 3 UNION ALL SELECT gauge, 'tier', tier, sum(w) FROM x GROUP BY 1, 3) SELECT gauge, "by", value, round(w / sum(w) OVER (PARTITION BY gauge, "by"), 6) AS share FROM y""",
    ),
    "gauge_registry": (
        gauge_registry,
        f"""WITH t AS (SELECT code, bool_and(tier = 'proxy') AS p, string_agg(DISTINCT leaf, '; ' ORDER BY leaf) AS leaves FROM {_TA} WHERE leaf < 'n2' GROUP BY 1), f AS (SELECT indicator_code AS code, min(CASE WHEN indicator_code = 'LOW' THEN 'b' ELSE 'a' END) AS source, count(DISTINCT country_code) AS n_countries, min(year) AS first_year, max(year) AS last_year FROM {{indicators}} GROUP BY 1)
SELECT code, source, n_countries, first_year, last_year, CASE WHEN p THEN 'stand_in' WHEN NOT p THEN 'wired' WHEN code LIKE 'N%' THEN 'carried' WHEN code LIKE 'H%' THEN 'derived_input' ELSE 'no_consumer' END AS status, coalesce(leaves, '') AS leaves FROM f LEFT JOIN t USING (code)""",
    ),
    "gauge_alternative_coverage": (
        gauge_alternative_coverage,
        f"""WITH w AS (SELECT upper(metric) AS country_code, count(*) / sum(count(*)) OVER () AS weight FROM {{obs_country}} GROUP BY 1), r AS (SELECT indicator_code AS code, count(*) AS n, sum(weight) AS s FROM (SELECT DISTINCT indicator_code, country_code FROM {{indicators}} WHERE value > 2000000) LEFT JOIN w USING (country_code) GROUP BY 1)
SELECT leaf, name, idx, code, tier, coalesce(n, 0) AS countries, round(coalesce(s, 0), 6) AS weighted, n IS NULL AND tier <> 'gap' AS dead FROM {_TA} LEFT JOIN r USING (code)""",
    ),
    "gauge_source_ledger": (
        gauge_source_ledger,
        f"""WITH {_ALIVE}, x AS (SELECT leaf, name, min(CASE tier WHEN 'exact' THEN 0 WHEN 'substitute' THEN 1 WHEN 'proxy' THEN 2 END) FILTER (alive.code IS NOT NULL) AS b, count(*) FILTER (alive.code IS NULL) AS n_dead FROM {_TA} a LEFT JOIN alive ON alive.code = a.code GROUP BY 1, 2) SELECT leaf, name, CASE b WHEN 0 THEN 'live' WHEN 1 THEN 'substitute' WHEN 2 THEN 'proxy' ELSE 'gap' END AS status, n_dead FROM x""",
    ),
    "gauge_direction_map": (
        gauge_direction_map,
        f"""SELECT code, leaf, direction, tier, regexp_matches(code, 'MEDI|URG') OR (contains(name, 'cost') AND contains(code, 'GDP')) AS ambiguous FROM {_TA} QUALIFY row_number() OVER (PARTITION BY code, leaf ORDER BY name, idx, direction, tier) = 1""",
    ),
    "gauge_structure_checks": (
        gauge_structure_checks,
        f"""WITH n AS (SELECT path, CASE path WHEN 'n4' THEN 'n3' WHEN 'n5' THEN 'n6' END AS reference FROM {_TN} WHERE path <> 'n3'), a AS (SELECT * FROM {_TA} UNION ALL SELECT * FROM {_TA} WHERE leaf = 'n7' AND name = 'm')
SELECT 'duplicate code' AS "check", leaf || '/' || name || '/' || code AS item FROM a GROUP BY leaf, name, code HAVING count(*) > 1 UNION ALL SELECT 'unresolved reference', reference FROM n WHERE reference NOT IN (SELECT path FROM n) UNION ALL SELECT DISTINCT 'unknown leaf', leaf FROM {_TC} WHERE leaf NOT IN (SELECT path FROM n)""",
    ),
    "gauge_proxy_candidates": (
        gauge_proxy_candidates,
        f"""WITH {_ALIVE}, lack AS (SELECT y.year, n_name AS country_code, n_regionkey = 1 AS target FROM (SELECT DISTINCT year FROM {{indicators}}) y CROSS JOIN {{nation}} LEFT JOIN (SELECT year, country_code FROM {{indicators}} WHERE indicator_code = 'MEDIUM' AND value > 2500000) m ON m.year = y.year AND m.country_code = n_name WHERE m.year IS NULL),
a AS (SELECT indicator_code AS code, count(*) AS added, count(*) FILTER (target) AS added_targets FROM lack JOIN (SELECT DISTINCT indicator_code, year, country_code FROM {{indicators}}) i USING (year, country_code) GROUP BY 1)
SELECT leaf, name, p.code, CASE WHEN name = 'm' THEN coalesce(added, 0) ELSE 0 END AS added, CASE WHEN name = 'm' THEN coalesce(added_targets, 0) ELSE 0 END AS added_targets FROM {_TA} p JOIN alive USING (code) LEFT JOIN a USING (code) WHERE tier = 'proxy' AND idx > 0""",
    ),
    "gauge_published_agreement": (
        gauge_published_agreement,
        """WITH p AS (SELECT n_name AS country_code, avg(c_acctbal) AS ref FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey GROUP BY 1), b AS (SELECT i.country_code, value AS score, ref, length(i.country_code) / 10.0 - 0.25 AS wp FROM {indicators} i JOIN p USING (country_code) WHERE indicator_code = 'HIGH' AND year = 1997),
e AS (SELECT 'all' AS which, score, ref FROM b UNION ALL SELECT 'present', score, ref FROM b WHERE wp >= 0.6), r AS (SELECT which, rank() OVER (PARTITION BY which ORDER BY score) AS ra, rank() OVER (PARTITION BY which ORDER BY ref) AS rb FROM e) SELECT which, count(*) AS n, round(CASE WHEN count(*) >= 10 THEN corr(ra, rb) END, 6) AS rho FROM r GROUP BY 1""",
    ),
    "gauge_deviation": (
        gauge_deviation,
        """WITH d AS (SELECT indicator_code, abs(value - value * (1 + (year - 1995) * 0.1)) / abs(value * (1 + (year - 1995) * 0.1)) AS d FROM {indicators}) SELECT indicator_code, round(quantile_cont(d, 0.5), 6) AS median, round(max(d), 6) AS largest, round(count(*) FILTER (d <= 0.3) / count(d), 6) AS within FROM d GROUP BY 1""",
    ),
    "gauge_switches": (
        gauge_switches,
        """WITH c AS (SELECT indicator_code AS leaf, country_code, year % 3 AS idx FROM {indicators} WHERE year % 3 < 2 OR indicator_code <> 'LOW'), b AS (SELECT leaf, country_code, count(DISTINCT idx) AS k, count(*) AS n FROM c GROUP BY 1, 2)
SELECT leaf, 'x' AS name, CAST(sum(n) AS BIGINT) AS n_scored, count(*) FILTER (k > 1) AS n_switching, (SELECT count(DISTINCT idx) FROM c WHERE c.leaf = b.leaf) AS n_alternatives FROM b GROUP BY leaf""",
    ),
    "capture_table_freshness": (capture_table_freshness, "SELECT CAST(floor(epoch(max(created_at))) AS BIGINT) AS seconds, greatest(CAST(epoch(TIMESTAMP '2024-01-31') AS BIGINT) - CAST(floor(epoch(max(created_at))) AS BIGINT), 0) <= 72 * 3600 AS fresh FROM {snapshots}"),
    "fx_bars": (fx_bars, f"WITH {_RATES} SELECT CASE WHEN source_currency = 'CNH' THEN 'CNY' ELSE source_currency END AS priced_as, source_currency, target_currency, date, round(close, 9) AS close FROM rt"),
    "fx_extent": (fx_extent, f"WITH {_RATES} SELECT source_currency, target_currency, max(date) AS last_date, count(*) AS n_bars FROM rt GROUP BY 1, 2"),
    "fx_historical_change": (
        fx_historical_change,
        f"WITH {_RATES}, l AS (SELECT source_currency, target_currency, max(date) AS last_date FROM rt GROUP BY 1, 2) SELECT source_currency, target_currency, bool_or(source_currency = 'LOW' AND year(date) = 1996) AS changed FROM rt JOIN l USING (source_currency, target_currency) WHERE date < last_date - 14 GROUP BY 1, 2",
    ),
    "audit_feature_summary": (audit_feature_summary, "SELECT split_part(family || '_' || metric, '_', 1) AS prefix, count(*) AS n_rows, count(DISTINCT family || '_' || metric) AS n_features, min(effective_date) AS first_date, max(effective_date) AS last_date FROM {observations} GROUP BY 1"),
}
