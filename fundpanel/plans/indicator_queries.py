"""Queries of indicators and gauges over the country-year view, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gauges, macro
from ..operators import indicators as ind
from ..sources.staging import stage
from .adapters import view


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(view(spark, sf_dir, "indicators"))


def _r(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def indicator_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ind.growth(_rows(spark, sf_dir), "URGENT", "g"), "value")


def indicator_own_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ind.growth(_rows(spark, sf_dir), "URGENT", "g", own_years=True), "value")


def indicator_forward_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ind.forward(_rows(spark, sf_dir), "HIGH", "f", years=3), "value")


def indicator_forward_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ind.forward(_rows(spark, sf_dir), "HIGH", "f", years=3, annualised=False), "value")


def indicator_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ind.trailing(_rows(spark, sf_dir), "LOW", "v", span=4, least=3), "value", digits=4)


def indicator_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ind.ratio(_rows(spark, sf_dir), "LOW", "HIGH", "r", 100.0), "value")


def indicator_ratio_of_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ind.ratio_of_means(_rows(spark, sf_dir), "LOW", "HIGH", "r", span=4, least=3), "value")


def indicator_mean_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ind.mean_of(_rows(spark, sf_dir), ["LOW", "HIGH", "MEDIUM"], "m"), "value", digits=4)


def indicator_self_sufficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ind.self_sufficiency(_rows(spark, sf_dir), "LOW", "HIGH", "s", net=True), "value")


def indicator_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ind.derive(_rows(spark, sf_dir), {"share": "`LOW` / (`LOW` + `HIGH`)", "gap": "(`URGENT` - `LOW`) / 1000"}), "value")


def indicator_structural_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).filter("value > 3000000 OR country_code < 'NATION_2'")
    return ind.structural_zeros(rows, view(spark, sf_dir, "nation").select(F.col("n_name").alias("country_code")), ["NATION_7"])


def indicator_priority_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.keyed import priority_merge

    rows = _rows(spark, sf_dir).select("country_code", "indicator_code", "year", "value")
    return priority_merge([rows.filter("year % 2 = 0"), rows.withColumn("value", -F.col("value"))], ind.KEY)


def indicator_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).filter("value > 2000000")
    return _r(ind.coverage(rows, 25, 1999), "coverage", "recent_coverage", "fill", "per_country")


def indicator_degeneracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).withColumn("value", F.floor(F.col("value") / 1e6).cast("double"))
    return _r(ind.degeneracy(rows), "modal_share", "zero_share")


def indicator_variance_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).withColumn("value", F.col("value") / 1e6)
    return _r(ind.variance_parts(rows), "between", "within", "dynamism", "icc").withColumn("role", ind.role(F.col("dynamism")))


def indicator_log_if_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).withColumn("value", F.when(F.col("indicator_code") == "LOW", F.col("value") * F.col("value")).otherwise(F.col("value")) / 1e6)
    return _r(ind.log_if_skewed(rows), "value").select("country_code", "indicator_code", "year", "value", "logged")


def indicator_gate_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).select((F.col("value") > 2e6).alias("large"), (F.col("year") > 1997).alias("late"), (F.col("indicator_code") != "LOW").alias("other"))
    return ind.gate_funnel(rows, ["large", "late", "other"])


def indicator_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "obs_country").withColumn("code", F.upper("metric"))
    return _r(ind.observation_weights(obs), "weight")


def indicator_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(ind.spearman(_rows(spark, sf_dir)), "rho")


def indicator_annual_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = view(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("country_code"), F.col("o_orderpriority").alias("indicator_code"), F.year("o_orderdate").alias("year"), (F.col("o_custkey") % 100).cast("double").alias("value"))
    return _r(ind.annual_mean(o), "value")


def gauge_percent_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(gauges.percent_ranks(_rows(spark, sf_dir).withColumn("value", F.floor(F.col("value") / 5e5)), view_alternatives(spark), least=10), "score")


def view_nodes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("all", None, 1.0, None, None), ("trade", "all", 0.6, None, None), ("mood", "all", 0.4, None, None), ("again", "all", 0.5, None, "trade.fast"), ("trade.fast", "trade", 0.5, 0.4, None), ("trade.slow", "trade", 0.5, 0.0, None), ("mood.calm", "mood", 1.0, 0.0, None)],
        "path string, parent string, weight double, size_share double, reference string",
    )


def view_components(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("trade.fast", "u", "size"), ("trade.fast", "h", "intensity"), ("trade.fast", "m", "intensity"), ("trade.slow", "l", "intensity"), ("mood.calm", "x", "intensity")], "leaf string, name string, kind string")


def view_alternatives(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("trade.fast", "u", 0, "URGENT", "exact", 1), ("trade.fast", "h", 0, "NOWHERE", "exact", 1), ("trade.fast", "h", 1, "HIGH", "substitute", 1), ("trade.fast", "m", 0, "MEDIUM", "exact", -1), ("trade.slow", "l", 0, "LOW", "exact", -1), ("trade.slow", "l", 1, "HIGH", "proxy", 1), ("mood.calm", "x", 0, "NOT SPECIFIED", "exact", 1)],
        "leaf string, name string, idx int, code string, tier string, direction int",
    )


def gauge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node scores of a small tree with alternatives, a reference and a size share."""
    rows = _rows(spark, sf_dir).filter("NOT (country_code = 'NATION_3' AND indicator_code = 'LOW')")
    nodes = view_nodes(spark)
    components = gauges.component_weights(view_components(spark), nodes)
    countries = view(spark, sf_dir, "nation").select(F.col("n_name").alias("country_code"))
    return _r(gauges.run(rows, nodes, components, view_alternatives(spark), countries, 1996, least=10)[1], "score", "weight_present")


def gauge_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(gauges.alternative_agreement(_rows(spark, sf_dir), view_alternatives(spark)), "rho")


def gauge_series_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(gauges.series_health(_rows(spark, sf_dir), 25, least=20), "coverage")


def macro_share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(macro.share_of_total(_rows(spark, sf_dir)), "value").select("country_code", "indicator_code", "year", "value")


def macro_smoothed_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(macro.smoothed_growth(_rows(spark, sf_dir)), "growth").select("country_code", "indicator_code", "year", "growth")


def macro_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = view(spark, sf_dir, "obs_country").select("product_id", F.col("effective_date").alias("as_of_date"), F.when(F.col("metric") != "nation_4", F.upper("metric")).alias("country_code"), F.col("value").alias("weight"))
    rows = _rows(spark, sf_dir).filter("country_code <> 'NATION_5'").withColumn("value", F.col("value") / 1e6)
    return _r(macro.collapse(w, rows), "value", "covered", digits=4)


_W = "WITH y AS (SELECT year, row_number() OVER (ORDER BY year) AS i FROM (SELECT DISTINCT year FROM {indicators} WHERE indicator_code = '%s')), o AS (SELECT country_code, year, max(value) AS value FROM {indicators} WHERE indicator_code = '%s' GROUP BY 1, 2)"


def _o(code: str, name: str) -> str:
    return f"{name} AS (SELECT country_code, year, max(value) AS {name} FROM {{indicators}} WHERE indicator_code = '{code}' GROUP BY 1, 2)"


def _trail(code: str, name: str, stat: str) -> str:
    return f"""q_{name}y AS (SELECT year, row_number() OVER (ORDER BY year) AS i FROM (SELECT DISTINCT year FROM {{indicators}} WHERE indicator_code = '{code}')), {_o(code, "q_" + name + "o")},
{name} AS (SELECT c.country_code, y.year, CASE WHEN count(q_{name}o) OVER w >= 3 THEN {stat}(q_{name}o) OVER w END AS {name} FROM (SELECT DISTINCT country_code FROM q_{name}o) c CROSS JOIN q_{name}y y LEFT JOIN q_{name}o o ON o.country_code = c.country_code AND o.year = y.year WINDOW w AS (PARTITION BY c.country_code ORDER BY y.i ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))"""


QUERIES = {
    "indicator_growth": (indicator_growth, (_W % ("URGENT", "URGENT")) + ", j AS (SELECT * FROM o JOIN y USING (year)) SELECT a.country_code, 'g' AS indicator_code, a.year, round((a.value / b.value - 1) * 100, 6) AS value FROM j a JOIN j b ON a.country_code = b.country_code AND b.i = a.i - 1"),
    "indicator_own_growth": (indicator_own_growth, f"WITH {_o('URGENT', 'v')}, g AS (SELECT country_code, year, (v / lag(v) OVER (PARTITION BY country_code ORDER BY year) - 1) * 100 AS g FROM v) SELECT country_code, 'g' AS indicator_code, year, round(g, 6) AS value FROM g WHERE g IS NOT NULL"),
    "indicator_forward_growth": (indicator_forward_growth, f"WITH {_o('HIGH', 'v')} SELECT a.country_code, 'f' AS indicator_code, a.year, round((pow(b.v / a.v, 1.0 / 3) - 1) * 100, 6) AS value FROM v a JOIN v b ON a.country_code = b.country_code AND b.year = a.year + 3"),
    "indicator_forward_change": (indicator_forward_change, f"WITH {_o('HIGH', 'v')} SELECT a.country_code, 'f' AS indicator_code, a.year, round(b.v - a.v, 6) AS value FROM v a JOIN v b ON a.country_code = b.country_code AND b.year = a.year + 3"),
    "indicator_volatility": (indicator_volatility, f"WITH {_trail('LOW', 't', 'stddev_samp')} SELECT country_code, 'v' AS indicator_code, year, round(t, 4) AS value FROM t WHERE t IS NOT NULL"),
    "indicator_ratio": (indicator_ratio, f"WITH {_o('LOW', 'a')}, {_o('HIGH', 'b')} SELECT country_code, 'r' AS indicator_code, year, round(a / b * 100, 6) AS value FROM a JOIN b USING (country_code, year)"),
    "indicator_ratio_of_means": (indicator_ratio_of_means, f"WITH {_trail('LOW', 'a', 'avg')}, {_trail('HIGH', 'b', 'avg')} SELECT country_code, 'r' AS indicator_code, year, round(a / b, 6) AS value FROM a JOIN b USING (country_code, year) WHERE b > 0 AND a IS NOT NULL"),
    "indicator_mean_of": (indicator_mean_of, "SELECT country_code, 'm' AS indicator_code, year, round(avg(value), 4) AS value FROM {indicators} WHERE indicator_code IN ('LOW', 'HIGH', 'MEDIUM') GROUP BY 1, 3"),
    "indicator_self_sufficiency": (indicator_self_sufficiency, f"WITH {_o('LOW', 'a')}, {_o('HIGH', 'b')} SELECT country_code, 's' AS indicator_code, year, round((a - b) / b, 6) AS value FROM a JOIN b USING (country_code, year)"),
    "indicator_derived": (
        indicator_derived,
        f"WITH {_o('LOW', 'l')}, {_o('HIGH', 'h')}, {_o('URGENT', 'u')}, w AS (SELECT country_code, year, l, h, u FROM l FULL JOIN h USING (country_code, year) FULL JOIN u USING (country_code, year)) SELECT country_code, 'share' AS indicator_code, year, round(l / (l + h), 6) AS value FROM w WHERE l + h IS NOT NULL UNION ALL SELECT country_code, 'gap', year, round((u - l) / 1000, 6) FROM w WHERE u - l IS NOT NULL",
    ),
    "indicator_structural_zeros": (
        indicator_structural_zeros,
        """WITH r AS (SELECT * FROM {indicators} WHERE value > 3000000 OR country_code < 'NATION_2'), g AS (SELECT n_name AS country_code, indicator_code, year FROM (SELECT DISTINCT indicator_code, year FROM r) CROSS JOIN {nation} WHERE n_name <> 'NATION_7')
SELECT country_code, indicator_code, year, value, is_projection FROM r UNION ALL SELECT country_code, indicator_code, year, 0, false FROM g ANTI JOIN r USING (country_code, indicator_code, year)""",
    ),
    "indicator_priority_merge": (indicator_priority_merge, "SELECT country_code, indicator_code, year, CASE WHEN year % 2 = 0 THEN value ELSE -value END AS value FROM {indicators}"),
    "indicator_coverage": (
        indicator_coverage,
        "SELECT indicator_code, round(count(DISTINCT country_code) / 25, 6) AS coverage, round(count(DISTINCT country_code) FILTER (year >= 1999) / 25, 6) AS recent_coverage, round(count(*) / ((max(year) - min(year) + 1) * 25), 6) AS fill, round(count(*) / count(DISTINCT country_code), 6) AS per_country, max(year) AS latest FROM {indicators} WHERE value > 2000000 GROUP BY 1",
    ),
    "indicator_degeneracy": (
        indicator_degeneracy,
        "WITH c AS (SELECT indicator_code, floor(value / 1e6) AS v, count(*) AS n FROM {indicators} GROUP BY 1, 2) SELECT indicator_code, count(*) AS n_distinct, round(max(n) / sum(n), 6) AS modal_share, round(coalesce(sum(n) FILTER (v = 0), 0) / sum(n), 6) AS zero_share FROM c GROUP BY 1",
    ),
    "indicator_variance_parts": (
        indicator_variance_parts,
        """WITH c AS (SELECT indicator_code, country_code, avg(value / 1e6) AS m, var_samp(value / 1e6) AS v FROM {indicators} GROUP BY 1, 2), p AS (SELECT indicator_code, var_samp(m) AS b, avg(v) AS w FROM c GROUP BY 1),
q AS (SELECT indicator_code, round(b, 6) AS "between", round(w, 6) AS within, round(sqrt(w) / (sqrt(b) + 1e-9), 6) AS dynamism, round(b / (b + w), 6) AS icc FROM p) SELECT *, CASE WHEN dynamism <= 0.1 THEN 'structural' WHEN dynamism <= 0.3 THEN 'mixed' ELSE 'cyclical' END AS role FROM q""",
    ),
    "indicator_log_if_skewed": (
        indicator_log_if_skewed,
        """WITH r AS (SELECT country_code, indicator_code, year, CASE WHEN indicator_code = 'LOW' THEN value * value ELSE value END / 1e6 AS value FROM {indicators}), s AS (SELECT indicator_code, min(value) > 0 AND skewness(value) > 1 AS logged FROM r GROUP BY 1)
SELECT country_code, indicator_code, year, round(CASE WHEN logged THEN ln(value) ELSE value END, 6) AS value, logged FROM r JOIN s USING (indicator_code)""",
    ),
    "indicator_gate_funnel": (
        indicator_gate_funnel,
        """WITH r AS (SELECT value > 2e6 AS a, year > 1997 AS b, indicator_code <> 'LOW' AS c FROM {indicators}) SELECT 'large' AS gate, 0 AS position, count(*) FILTER (a) AS survivors, count(*) FILTER (NOT a) AS failures FROM r UNION ALL SELECT 'late', 1, count(*) FILTER (a AND b), count(*) FILTER (NOT b) FROM r UNION ALL SELECT 'other', 2, count(*) FILTER (a AND b AND c), count(*) FILTER (NOT c) FROM r""",
    ),
    "indicator_weights": (indicator_weights, "SELECT upper(metric) AS country_code, round(count(*) / sum(count(*)) OVER (), 6) AS weight FROM {obs_country} GROUP BY 1"),
    "indicator_spearman": (
        indicator_spearman,
        """WITH j AS (SELECT x.indicator_code AS a, y.indicator_code AS b, x.value AS va, y.value AS vb FROM {indicators} x JOIN {indicators} y ON x.country_code = y.country_code AND x.year = y.year AND x.indicator_code < y.indicator_code),
r AS (SELECT a, b, rank() OVER (PARTITION BY a, b ORDER BY va) + (count(*) OVER (PARTITION BY a, b, va) - 1) / 2 AS ra, rank() OVER (PARTITION BY a, b ORDER BY vb) + (count(*) OVER (PARTITION BY a, b, vb) - 1) / 2 AS rb FROM j) SELECT a, b, count(*) AS n, round(corr(ra, rb), 6) AS rho FROM r GROUP BY 1, 2""",
    ),
    "indicator_annual_mean": (indicator_annual_mean, "SELECT o_orderstatus AS country_code, o_orderpriority AS indicator_code, CAST(year(o_orderdate) AS INTEGER) AS year, round(avg(o_custkey % 100), 6) AS value FROM {orders} GROUP BY 1, 2, 3"),
    "gauge_percent_ranks": (
        gauge_percent_ranks,
        """WITH d AS (SELECT DISTINCT * FROM (VALUES ('URGENT', 1), ('HIGH', 1), ('MEDIUM', -1), ('LOW', -1), ('NOT SPECIFIED', 1)) t(indicator_code, direction)), v AS (SELECT i.*, direction, floor(value / 5e5) * direction AS v FROM {indicators} i JOIN d USING (indicator_code)),
r AS (SELECT *, count(*) OVER (PARTITION BY indicator_code, direction, year) AS n, rank() OVER (PARTITION BY indicator_code, direction, year ORDER BY v) + (count(*) OVER (PARTITION BY indicator_code, direction, year, v) - 1) / 2 AS k FROM v) SELECT indicator_code, direction, year, country_code, round((k - 1) / (n - 1) * 100, 6) AS score FROM r WHERE n >= 10""",
    ),
    "gauge_scores": (
        gauge_scores,
        """WITH r AS (SELECT * FROM {indicators} WHERE NOT (country_code = 'NATION_3' AND indicator_code = 'LOW')), span AS (SELECT DISTINCT year FROM r WHERE NOT is_projection AND year >= 1996), grid AS (SELECT year, n_name AS country_code FROM span CROSS JOIN {nation}),
v AS (SELECT indicator_code, year, country_code, value * CASE WHEN indicator_code IN ('MEDIUM', 'LOW') THEN -1 ELSE 1 END AS v FROM r JOIN span USING (year)),
k AS (SELECT *, count(*) OVER (PARTITION BY indicator_code, year) AS n, rank() OVER (PARTITION BY indicator_code, year ORDER BY v) + (count(*) OVER (PARTITION BY indicator_code, year, v) - 1) / 2 AS k FROM v), s AS (SELECT indicator_code, year, country_code, (k - 1) / (n - 1) * 100 AS s FROM k WHERE n >= 10),
w AS (SELECT * FROM (VALUES ('trade.fast', 'URGENT', 0.4), ('trade.fast', 'HIGH', 0.3), ('trade.fast', 'MEDIUM', 0.3), ('trade.slow', 'LOW', 1.0), ('mood.calm', 'NOT SPECIFIED', 1.0)) t(path, indicator_code, w)),
leaf AS (SELECT path, year, country_code, sum(w * s) / sum(w) FILTER (s IS NOT NULL) AS score, coalesce(sum(w) FILTER (s IS NOT NULL), 0) / sum(w) AS wp FROM w CROSS JOIN grid LEFT JOIN s USING (indicator_code, year, country_code) GROUP BY 1, 2, 3),
e AS (SELECT * FROM (VALUES ('trade', 'trade.fast', 0.5), ('trade', 'trade.slow', 0.5), ('mood', 'mood.calm', 1.0)) t(parent, path, w)),
l1 AS (SELECT parent AS path, year, country_code, sum(w * score) / sum(w) FILTER (score IS NOT NULL) AS score, sum(w * wp) / sum(w) AS wp FROM leaf JOIN e USING (path) GROUP BY 1, 2, 3 UNION ALL SELECT 'again', year, country_code, score, wp FROM leaf WHERE path = 'trade.fast'),
top AS (SELECT 'all' AS path, year, country_code, sum(w * score) / sum(w) FILTER (score IS NOT NULL) AS score, sum(w * wp) / sum(w) AS wp FROM l1 JOIN (VALUES ('trade', 0.6), ('mood', 0.4), ('again', 0.5)) t(path, w) USING (path) GROUP BY 2, 3)
SELECT path, year, country_code, round(score, 6) AS score, round(wp, 6) AS weight_present FROM (SELECT * FROM leaf UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM top)""",
    ),
    "gauge_agreement": (
        gauge_agreement,
        """WITH j AS (SELECT -x.value AS va, y.value AS vb FROM {indicators} x JOIN {indicators} y ON x.country_code = y.country_code AND x.year = y.year AND x.indicator_code = 'LOW' AND y.indicator_code = 'HIGH'),
r AS (SELECT rank() OVER (ORDER BY va) + (count(*) OVER (PARTITION BY va) - 1) / 2 AS ra, rank() OVER (ORDER BY vb) + (count(*) OVER (PARTITION BY vb) - 1) / 2 AS rb FROM j) SELECT 'trade.slow' AS leaf, 'l' AS name, 0 AS a, 1 AS b, count(*) AS n, round(corr(ra, rb), 6) AS rho FROM r HAVING count(*) >= 5""",
    ),
    "gauge_series_health": (
        gauge_series_health,
        """WITH b AS (SELECT indicator_code, year, count(DISTINCT country_code) AS n FROM {indicators} GROUP BY 1, 2) SELECT i.indicator_code, round(count(DISTINCT country_code) / 25, 6) AS coverage, count(DISTINCT value) <= 1 AS degenerate, bool_or(is_projection) AS projected, min(year) AS first_year, max(year) AS last_year,
(SELECT min(year) FROM b WHERE b.indicator_code = i.indicator_code AND n >= 20) AS first_ranked FROM {indicators} i GROUP BY i.indicator_code""",
    ),
    "macro_share_of_total": (macro_share_of_total, "SELECT country_code, indicator_code, year, round(value / sum(value) OVER (PARTITION BY indicator_code, year), 6) AS value FROM {indicators}"),
    "macro_smoothed_growth": (macro_smoothed_growth, "SELECT country_code, indicator_code, year, round((value - lag(value, 3) OVER w) / (3 * lag(value, 3) OVER w), 6) AS growth FROM {indicators} WINDOW w AS (PARTITION BY indicator_code, country_code ORDER BY year)"),
    "macro_collapse": (
        macro_collapse,
        """WITH w AS (SELECT product_id, effective_date AS as_of_date, upper(metric) AS country_code, value AS weight, CAST(year(effective_date) - CASE WHEN month(effective_date) < 6 THEN 1 ELSE 0 END AS INTEGER) AS year FROM {obs_country} WHERE metric <> 'nation_4'), t AS (SELECT product_id, as_of_date, sum(weight) AS total FROM w GROUP BY 1, 2),
s AS (SELECT product_id, as_of_date, indicator_code, sum(weight * value / 1e6) AS s, sum(weight) AS covered FROM w JOIN {indicators} USING (country_code, year) WHERE country_code <> 'NATION_5' GROUP BY 1, 2, 3) SELECT product_id, as_of_date, indicator_code, round(s / total, 4) AS value, round(covered, 4) AS covered FROM s JOIN t USING (product_id, as_of_date)""",
    ),
}
