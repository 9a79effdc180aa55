"""Queries of the panel operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import panel
from ..vocab import CLOSED_UNIVERSE
from .adapters import parts, view


#: Added before a comparison's rounding: means of amounts in cents are often exact ties.
OFF_TIES = 3.3e-7
#: The observations that panel_pruned adds once more under the name of a metric of its own.
RARE = "family = 'esg' AND metric = 'r_f' AND product_id = 1 AND date_source_depth > 6"


def _get(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    known: dict[str, DataFrame] = {}
    return [view(spark, sf_dir, n, known) for n in names]


def panel_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices, obs = _get(spark, sf_dir, "prices", "obs_scalar")
    return panel.month_spine(panel.trading_bounds(prices, obs))


def panel_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices, obs = _get(spark, sf_dir, "prices", "obs_scalar")
    return panel.trading_bounds(prices, obs)


def panel_theme_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.theme_mapping(view(spark, sf_dir, "themes"))


def panel_root_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, themes = _get(spark, sf_dir, "obs_theme", "themes")
    wrong = obs.filter("metric = 'nation_3'").withColumn("code", F.when(F.col("product_id") % 2 == 0, F.lit("r1"))).withColumn("metric", F.when(F.col("code").isNull(), F.lit("asia")).otherwise(F.col("metric")))
    return panel.root_observations(obs.unionByName(wrong), themes).select("product_id", "metric", "code", "effective_date")


def panel_continuous_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = panel.continuous_metrics(view(spark, sf_dir, "observations"), parts(spark, sf_dir))
    return found.withColumn("skew", F.round("skew", 6))


def panel_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.outliers(view(spark, sf_dir, "obs_scalar"), parts=parts(spark, sf_dir))


def panel_outlier_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.outlier_summary(panel_outliers(spark, sf_dir))


def panel_without_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.without_outliers(view(spark, sf_dir, "obs_scalar"), parts=parts(spark, sf_dir)).groupBy("family", "metric").agg(F.count("*").alias("n"), F.max("value").alias("hi"))


def panel_theme_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, themes = _get(spark, sf_dir, "obs_theme", "themes")
    return panel.roll_up_themes(obs, themes).withColumn("value", F.round("value", 6)).drop("fetched_at")


def panel_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "observations")
    # all observations, and a metric rare enough to go
    kept, gone = panel.prune(obs.unionByName(obs.filter(RARE).withColumn("metric", F.lit("rare"))))
    return kept.groupBy("family", "metric").agg(F.count("*").alias("n"), F.lit(True).alias("kept")).unionByName(gone.select("family", "metric", "n", F.lit(False).alias("kept")))


def panel_style_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    style, hist = _get(spark, sf_dir, "obs_style", "obs_hist")
    return panel.merge_style(style.unionByName(hist)).select("product_id", "family", "metric", "effective_date", "value")


def panel_staleness_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "observations")
    return panel.staleness_caps(panel.snapshot_dates(obs), ["product_id", "family"])


def panel_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = view(spark, sf_dir, "observations")
    return panel.validity(panel.snapshot_dates(obs), ["product_id", "family"])


def panel_monthly_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.monthly_fx(view(spark, sf_dir, "fx")).withColumn("rate", F.round("rate", 9))


def panel_aum_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, fx = _get(spark, sf_dir, "obs_aum", "fx")
    return panel.aum_to_usd(obs, fx).withColumn("value", F.round(F.col("value") + OFF_TIES, 5))


def panel_densified(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, themes = _get(spark, sf_dir, "observations", "themes")
    return panel.densify(panel.merge_style(obs), themes, parts(spark, sf_dir)).withColumn("value", F.round("value", 6))


def panel_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum slice: capped last values of scalar features at every month end."""
    obs, prices, fx = _get(spark, sf_dir, "obs_scalar", "prices", "fx")
    return panel.scalar_panel(obs, fx, panel.trading_bounds(prices, obs), parts(spark, sf_dir))


def panel_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, prices, themes, fx = _get(spark, sf_dir, "observations", "prices", "themes", "fx")
    return panel.build_panel(obs, prices, themes, fx, parts=parts(spark, sf_dir)).withColumn("value", F.round(F.col("value") + OFF_TIES, 5))


_SLUG = "trim(regexp_replace(lower(replace(trim(name), '&', 'and')), '[^a-z0-9]+', '_', 'g'), '_')"
_MAP = f"root AS (SELECT theme_id, {_SLUG} AS slug FROM {{themes}} WHERE parent_id IS NULL), child AS (SELECT c.theme_id, {_SLUG.replace('name', 'c.name')} AS slug, c.parent_id, r.slug AS parent_slug FROM {{themes}} c JOIN root r ON c.parent_id = r.theme_id)"
_CAND = """cand AS (SELECT family, metric, count(*) AS n_total, count(DISTINCT value) AS n_distinct, skewness(value) AS skew, min(value) AS lo, max(value) AS hi FROM {obs}
  WHERE family IN ('ratios', 'profile', 'esg', 'theme', 'rank_adj_theme') AND metric <> 'is_passive' GROUP BY 1, 2 HAVING count(DISTINCT value) > 10 AND count(DISTINCT value) / count(*) >= 0.05)"""
_OUT = """z AS (SELECT o.product_id, o.family, o.metric, o.effective_date, o.value, CASE WHEN skew > 3 THEN ln(o.value - lo + 1) WHEN skew < -3 THEN ln(hi - o.value + 1) ELSE o.value END AS z FROM {obs} o JOIN cand USING (family, metric)),
q AS (SELECT *, quantile_cont(z, 0.25) OVER w AS a, quantile_cont(z, 0.5) OVER w AS b, quantile_cont(z, 0.75) OVER w AS c FROM z WINDOW w AS (PARTITION BY product_id, family, metric ORDER BY effective_date ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)),
outl AS (SELECT product_id, family, metric, effective_date, value FROM q WHERE c - a > 0 AND abs(z - b) > 5 * (c - a))"""
_SPINE = "b AS (SELECT product_id, min(date) AS lo, max(date) AS hi FROM {prices} WHERE product_id IN (SELECT product_id FROM {obs}) GROUP BY 1), spine AS (SELECT product_id, last_day(CAST(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS DATE)) AS as_of_date FROM b)"


def _valid(name: str, source: str, key: str) -> str:
    return f"""{name}_g AS (SELECT *, date_diff('day', lag(effective_date) OVER w, effective_date) AS gap, lead(effective_date) OVER w AS nxt FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY effective_date)),
{name}_c AS (SELECT {key}, count(gap) AS n_gaps, CAST(round(quantile_cont(gap, 0.99), 6) AS INTEGER) AS cap, min(effective_date) AS first_date FROM {name}_g GROUP BY {key}),
{name} AS (SELECT g.* EXCLUDE (gap, nxt), CASE WHEN n_gaps > 0 THEN effective_date END AS valid_from, CASE WHEN n_gaps > 0 THEN CASE WHEN nxt IS NULL THEN effective_date + cap ELSE least(effective_date + cap, nxt - 1) END END AS valid_to FROM {name}_g g JOIN {name}_c USING ({key}))"""


_UNIVERSE = "u AS (SELECT * FROM (VALUES " + ", ".join(f"('{f}', '{m}')" for f, ms in CLOSED_UNIVERSE.items() for m in ms) + ") t(family, metric) UNION ALL SELECT DISTINCT f, slug FROM root, (VALUES ('theme'), ('rank_adj_theme')) t(f))"
_STYLE = """st AS (SELECT product_id, 'style_box' AS family, metric, effective_date, value FROM {obs} WHERE family IN ('style_box', 'style_box_hist')
  QUALIFY NOT bool_or(family = 'style_box') OVER (PARTITION BY product_id, effective_date) OR family = 'style_box'),
dz AS (SELECT product_id, family, metric, effective_date, value FROM {obs} WHERE family IN ('asset_class', 'country', 'industry', 'credit_rating', 'maturity', 'theme', 'rank_adj_theme') UNION ALL SELECT * FROM st),
snaps AS (SELECT DISTINCT product_id, family, effective_date FROM dz)"""
_DENSE = """k AS (SELECT s.product_id, s.family, s.effective_date, u.metric FROM snaps s JOIN u USING (family)
  UNION ALL SELECT s.product_id, s.family, s.effective_date, c.metric FROM snaps s JOIN (SELECT DISTINCT product_id, family, metric FROM dz WHERE family = 'country') c USING (product_id, family)),
dense AS (SELECT k.*, coalesce(o.value, 0) AS value FROM k LEFT JOIN dz o USING (product_id, family, metric, effective_date))"""
_FXM = "fxm AS (SELECT source_currency AS code, last_day(date) AS m, avg(close) AS rate FROM {fx} WHERE target_currency = 'USD' GROUP BY 1, 2)"
_AUM = "aum AS (SELECT product_id, last_day(effective_date) AS effective_date, avg(value * CASE WHEN o.code = 'USD' THEN 1 ELSE rate END) AS value FROM {obs} o LEFT JOIN fxm ON fxm.code = o.code AND fxm.m = last_day(o.effective_date) WHERE family = 'profile' AND metric = 'total_net_assets_local' AND (o.code = 'USD' OR rate IS NOT NULL) GROUP BY 1, 2)"
_ROLL = """th AS (SELECT o.*, c.parent_id, c.parent_slug FROM {obs} o JOIN child c ON o.code = c.theme_id WHERE o.family IN ('theme', 'rank_adj_theme')
  UNION ALL SELECT o.*, c.parent_id, c.parent_slug FROM {obs} o JOIN child c ON o.code IS NULL AND o.metric = c.slug WHERE o.family IN ('theme', 'rank_adj_theme')),
rolled AS (SELECT product_id, family, metric, code, effective_date, date_source_depth, fetched_at, value FROM {obs} WHERE family NOT IN ('theme', 'rank_adj_theme')
  UNION ALL SELECT product_id, family, parent_slug, parent_id, effective_date, max(date_source_depth), max(fetched_at), sum(value) FROM th GROUP BY product_id, family, parent_slug, parent_id, effective_date)"""
_PRUNE = """mc AS (SELECT family, metric, count(*) AS n FROM {obs} GROUP BY 1, 2),
cut AS (SELECT CAST(greatest(5, quantile_cont(n, 0.5) - 3 * (quantile_cont(n, 0.75) - quantile_cont(n, 0.25))) AS INTEGER) AS cutoff FROM mc)"""
_IN_VALID = "(valid_from IS NULL OR (as_of_date >= valid_from AND as_of_date <= valid_to))"


def _on(text: str, obs: str) -> str:
    return text.replace("{obs}", obs)


_FULL = f"""WITH {_MAP}, {_on(_CAND, "{observations}")}, {_on(_OUT, "{observations}")},
clean AS (SELECT o.* FROM {{observations}} o ANTI JOIN outl x USING (product_id, family, metric, effective_date)),
{_on(_ROLL, "clean")}, {_on(_PRUNE, "rolled")}, sv AS (SELECT r.* FROM rolled r JOIN mc USING (family, metric), cut WHERE n >= cutoff),
{_on(_SPINE, "{observations}")}, {_on(_STYLE, "sv")}, {_valid("live", "snaps", "product_id, family")}, {_UNIVERSE}, {_DENSE},
{_FXM}, {_on(_AUM, "sv")},
sc AS (SELECT product_id, family || '_' || metric AS feature_id, effective_date, value FROM sv WHERE family IN ('ratios', 'esg', 'mstar', 'lipper', 'profile') AND metric <> 'total_net_assets_local'
  UNION ALL SELECT product_id, 'profile_total_net_assets_usd', effective_date, value FROM aum),
{_valid("scv", "sc", "product_id, feature_id")}
SELECT product_id, as_of_date, d.family || '_' || d.metric AS feature_id, round(value + {OFF_TIES}, 5) AS value FROM dense d JOIN live USING (product_id, family, effective_date) JOIN spine USING (product_id) WHERE {_IN_VALID}
UNION ALL SELECT product_id, as_of_date, feature_id, round(value + {OFF_TIES}, 5) FROM scv JOIN spine USING (product_id) WHERE {_IN_VALID}"""

QUERIES = {
    "panel_bounds": (panel_bounds, "SELECT product_id, min(date) AS first_price, max(date) AS last_price FROM {prices} WHERE product_id IN (SELECT product_id FROM {obs_scalar}) GROUP BY 1"),
    "panel_spine": (panel_spine, f"WITH {_on(_SPINE, '{obs_scalar}')} SELECT * FROM spine"),
    "panel_theme_mapping": (panel_theme_mapping, f"WITH {_MAP} SELECT * FROM child"),
    "panel_root_observations": (
        panel_root_observations,
        """SELECT product_id, CASE WHEN product_id % 2 = 0 THEN metric ELSE 'asia' END AS metric, CASE WHEN product_id % 2 = 0 THEN 'r1' END AS code, effective_date FROM {obs_theme} WHERE metric = 'nation_3'""",
    ),
    "panel_continuous_metrics": (panel_continuous_metrics, f"WITH {_on(_CAND, '{observations}')} SELECT * EXCLUDE (skew), round(skew, 6) AS skew FROM cand"),
    "panel_outliers": (panel_outliers, f"WITH {_on(_CAND, '{obs_scalar}')}, {_on(_OUT, '{obs_scalar}')} SELECT * FROM outl"),
    "panel_outlier_summary": (panel_outlier_summary, f"WITH {_on(_CAND, '{obs_scalar}')}, {_on(_OUT, '{obs_scalar}')} SELECT family, metric, count(*) AS n, min(value) AS lo, max(value) AS hi FROM outl GROUP BY 1, 2"),
    "panel_without_outliers": (
        panel_without_outliers,
        f"WITH {_on(_CAND, '{obs_scalar}')}, {_on(_OUT, '{obs_scalar}')} SELECT family, metric, count(*) AS n, max(value) AS hi FROM {{obs_scalar}} o ANTI JOIN outl USING (product_id, family, metric, effective_date) GROUP BY 1, 2",
    ),
    "panel_theme_rollup": (panel_theme_rollup, f"WITH {_MAP}, {_on(_ROLL, '{obs_theme}')} SELECT product_id, family, metric, code, effective_date, date_source_depth, round(value, 6) AS value FROM rolled"),
    "panel_pruned": (
        panel_pruned,
        f"WITH o AS (SELECT * FROM {{observations}} UNION ALL SELECT * REPLACE ('rare' AS metric) FROM {{observations}} WHERE {RARE}), {_on(_PRUNE, 'o')} SELECT family, metric, n, n >= cutoff AS kept FROM mc, cut",
    ),
    "panel_style_merge": (panel_style_merge, f"WITH o AS (SELECT * FROM {{obs_style}} UNION ALL SELECT * FROM {{obs_hist}}), {_on(_STYLE, 'o')} SELECT * FROM st"),
    "panel_staleness_caps": (panel_staleness_caps, f"WITH s AS (SELECT DISTINCT product_id, family, effective_date FROM {{observations}}), {_valid('v', 's', 'product_id, family')} SELECT * FROM v_c"),
    "panel_validity": (panel_validity, f"WITH s AS (SELECT DISTINCT product_id, family, effective_date FROM {{observations}}), {_valid('v', 's', 'product_id, family')} SELECT * FROM v"),
    "panel_monthly_fx": (panel_monthly_fx, f"WITH {_FXM} SELECT code AS currency, m AS month_end, round(rate, 9) AS rate FROM fxm"),
    "panel_aum_usd": (panel_aum_usd, f"WITH {_FXM}, {_on(_AUM, '{obs_aum}')} SELECT product_id, effective_date, round(value + {OFF_TIES}, 5) AS value FROM aum"),
    "panel_densified": (panel_densified, f"WITH {_MAP}, {_on(_STYLE, '{observations}')}, {_UNIVERSE}, {_DENSE} SELECT * EXCLUDE (value), round(value, 6) AS value FROM dense"),
    "panel_scalar": (
        panel_scalar,
        f"WITH {_on(_SPINE, '{obs_scalar}')}, sc AS (SELECT product_id, family || '_' || metric AS feature_id, effective_date, value FROM {{obs_scalar}}), {_valid('scv', 'sc', 'product_id, feature_id')} SELECT product_id, as_of_date, feature_id, value FROM scv JOIN spine USING (product_id) WHERE {_IN_VALID}",
    ),
    "panel_full": (panel_full, _FULL),
}
