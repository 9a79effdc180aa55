"""Queries of payload structure, log waves and filled indicator series, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import logs, macro, profile
from .adapters import view

ENDPOINTS = {"mf_holdings": "holdings", "mf_ratios": "ratios"}
GAP = "2 hours"


def payload_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.paths(profile.nodes(view(spark, sf_dir, "payloads"))).withColumn("share", F.round("share", 9))


def payload_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.items(profile.nodes(view(spark, sf_dir, "payloads")))


def payload_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.shapes(profile.nodes(view(spark, sf_dir, "payloads"))).withColumn("samples", F.array_join("samples", "\n"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.detail_events(logs.parse_lines(view(spark, sf_dir, "log_lines")), ENDPOINTS)


def log_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.waves(_events(spark, sf_dir), GAP)


def log_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.histograms(_events(spark, sf_dir), {"pause": 1.0, "bars": 5.0})


def log_details_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return logs.details_report(events, logs.waves(events, GAP)).withColumns({c: F.round(c, 6) for c in ("minutes", "longest_wave")})


def log_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).filter("endpoint IS NOT NULL").groupBy("file", "endpoint", "event", "limited").agg(F.count("*").alias("n"))


def macro_interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return macro.interpolate(view(spark, sf_dir, "indicator_gaps")).withColumn("value", F.round("value", 4))


#: All nodes of readable payloads; kinds by the type of the JSON value.
_WALK = """WITH RECURSIVE walk AS (SELECT url_prefix, row_number() OVER () AS doc, '$' AS path, json(payload) AS v FROM {payloads} WHERE json_valid(payload)
UNION ALL SELECT url_prefix, doc, c.path, c.v FROM (SELECT url_prefix, doc, unnest(CASE WHEN json_type(v) = 'OBJECT' THEN list_transform(json_keys(v), lambda k: {'path': path || '.' || k, 'v': json_extract(v, '$."' || k || '"')})
  ELSE list_transform(range(CAST(json_array_length(v) AS BIGINT)), lambda i: {'path': path || '[]', 'v': json_extract(v, '$[' || i || ']')}) END) AS c FROM walk WHERE json_type(v) IN ('OBJECT', 'ARRAY')) x),
nodes AS (SELECT *, CASE json_type(v) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'DOUBLE' THEN 'number' ELSE 'integer' END AS kind FROM walk)
"""
#: What the text of a line says.
_LINES = r"""WITH lines AS (SELECT file, CAST(value[:19] AS TIMESTAMP) AS ts, contains(value, '.details ') AS details, value AS m FROM {log_lines}),
events AS (SELECT *, CASE WHEN contains(m, 'Landing for product') THEN 'gate' WHEN contains(m, 'Failed to fetch') THEN 'endpoint_failed' WHEN contains(m, 'Request to') THEN 'retry' WHEN contains(m, 'Pausing') THEN 'pause' WHEN contains(m, ' bars)') THEN 'bars' END AS event,
  CAST(nullif(regexp_extract(m, '[Pp]roduct (\d+):', 1), '') AS BIGINT) AS product_id, contains(m, 'Pausing') OR contains(m, 'status 429') AS limited,
  CAST(coalesce(nullif(regexp_extract(m, 'for ([\d.]+)s', 1), ''), nullif(regexp_extract(m, '\((\d+) bars', 1), '')) AS DOUBLE) AS number FROM lines),
hits AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY file ORDER BY ts) + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS starts FROM events WHERE limited),
waves AS (SELECT file, min(ts) AS start, max(ts) AS "end", count(*) AS n_hits, count(*) FILTER (event = 'pause') AS n_pauses, coalesce(sum(number) FILTER (event = 'pause'), 0) AS paused
  FROM (SELECT *, sum(starts) OVER (PARTITION BY file ORDER BY ts) AS wave FROM hits) x GROUP BY file, wave)
"""
#: Knots with their slopes to both sides, by the rule of the spline's edges; every year between its knots.
_AKIMA = """WITH g AS (SELECT * FROM {indicator_gaps}), k AS (SELECT *, row_number() OVER w AS i, (lead(value) OVER w - value) / (lead(year) OVER w - year) AS m FROM g WHERE value IS NOT NULL WINDOW w AS (PARTITION BY indicator_code, country_code ORDER BY year)),
s AS (SELECT *, lag(m, 2) OVER w AS a, lag(m) OVER w AS b, m AS c, lead(m) OVER w AS d FROM k WINDOW w AS (PARTITION BY indicator_code, country_code ORDER BY year)),
s1 AS (SELECT * REPLACE (coalesce(b, 2 * c - d, c) AS b, coalesce(c, 2 * b - a, b) AS c) FROM s), s2 AS (SELECT * REPLACE (coalesce(a, 2 * b - c) AS a, coalesce(d, 2 * c - b) AS d) FROM s1),
t AS (SELECT *, CASE WHEN abs(d - c) + abs(b - a) > 0 THEN (abs(d - c) * b + abs(b - a) * c) / (abs(d - c) + abs(b - a)) ELSE (b + c) / 2 END AS t FROM s2),
j AS (SELECT g.country_code, g.indicator_code, g.year, g.value, p.year AS py, p.value AS pv, p.t AS pt, n.year AS ny, n.value AS nv, n.t AS nt FROM g
  ASOF LEFT JOIN t p ON g.country_code = p.country_code AND g.indicator_code = p.indicator_code AND g.year >= p.year ASOF LEFT JOIN t n ON g.country_code = n.country_code AND g.indicator_code = n.indicator_code AND g.year <= n.year),
r AS (SELECT country_code, indicator_code, lo, regr_slope(value, year) AS slope, regr_intercept(value, year) AS intercept, count(*) AS n, any_value(value) AS v FROM (
  SELECT k.*, true AS lo FROM k WHERE i <= 3 UNION ALL SELECT * FROM (SELECT k.*, false AS lo FROM k) y QUALIFY row_number() OVER (PARTITION BY indicator_code, country_code ORDER BY year DESC) <= 3) x GROUP BY 1, 2, 3),
f AS (SELECT j.*, (year - py) / (ny - py) AS u, ny - py AS h, r.n, r.v, r.slope, r.intercept FROM j LEFT JOIN r ON j.country_code = r.country_code AND j.indicator_code = r.indicator_code AND r.lo = (j.py IS NULL)),
e AS (SELECT country_code, indicator_code, year, coalesce(value, CASE WHEN py IS NOT NULL AND ny IS NOT NULL THEN (1 + 2 * u) * (1 - u) * (1 - u) * pv + u * (1 - u) * (1 - u) * h * pt + u * u * (3 - 2 * u) * nv + u * u * (u - 1) * h * nt
  WHEN n >= 2 THEN intercept + slope * year ELSE v END) AS value FROM f)
SELECT country_code, indicator_code, year, round(coalesce(value, avg(value) OVER (PARTITION BY indicator_code, year)), 4) AS value FROM e"""

QUERIES = {
    "payload_paths": (payload_paths, _WALK + "SELECT url_prefix, path, kind, count(*) AS n_values, count(DISTINCT doc) AS n_payloads, round(count(DISTINCT doc) / (SELECT count(*) FROM {payloads} t WHERE json_valid(t.payload) AND t.url_prefix = n.url_prefix), 9) AS share FROM nodes n GROUP BY url_prefix, path, kind"),
    "payload_items": (
        payload_items,
        _WALK + """SELECT url_prefix, path, path LIKE '%.financials[]' AS metric, CASE WHEN v->>'$.name_tag' IS NOT NULL THEN 'name_tag:' || (v->>'$.name_tag') WHEN v->>'$.name' IS NOT NULL THEN 'name:' || (v->>'$.name') END AS identity, count(*) AS n
FROM nodes WHERE kind = 'object' AND path LIKE '%[]' GROUP BY ALL""",
    ),
    "payload_shapes": (
        payload_shapes,
        _WALK + """, o AS (SELECT url_prefix, path, list_aggregate(list_sort(json_keys(v)), 'string_agg', ',') AS shape, CAST(v AS VARCHAR) AS text FROM nodes WHERE kind = 'object'), d AS (SELECT DISTINCT *, sha256(text) AS digest FROM o),
few AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY url_prefix, path, shape, CAST('0x' || digest[:8] AS BIGINT) % 3 ORDER BY digest) = 1)
SELECT url_prefix, path, shape, n, samples FROM (SELECT url_prefix, path, shape, count(*) AS n FROM o GROUP BY ALL) c JOIN (SELECT url_prefix, path, shape, string_agg(text, chr(10) ORDER BY digest) AS samples FROM few GROUP BY ALL) s USING (url_prefix, path, shape)""",
    ),
    "log_waves": (log_waves, _LINES + "SELECT * FROM waves"),
    "log_histograms": (log_histograms, _LINES + "SELECT file, event, CASE event WHEN 'pause' THEN floor(number) ELSE floor(number / 5) * 5 END AS bin, count(*) AS n FROM events WHERE event IN ('pause', 'bars') GROUP BY ALL"),
    "log_details_report": (
        log_details_report,
        _LINES + """SELECT file, min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT product_id) AS n_products, count(DISTINCT product_id) FILTER (event = 'endpoint_failed') AS n_failed_products, sum(number) FILTER (event = 'pause') AS paused, max(number) FILTER (event = 'pause') AS longest_pause,
count(*) FILTER (event = 'gate') AS n_checks, count(*) FILTER (contains(m, 'changed=True')) AS n_changed, count(*) FILTER (contains(m, 'changed=False')) AS n_unchanged, count(*) FILTER (contains(m, 'not satisfied')) AS n_unsatisfied, count(*) FILTER (event = 'pause') AS n_pauses, count(*) FILTER (contains(m, 'active wave')) AS n_suppressed,
count(*) FILTER (contains(m, 'status 429')) AS n_retries_429, count(*) FILTER (event = 'endpoint_failed') AS n_endpoint_failures, any_value(w.n_waves) AS n_waves, any_value(w.longest_wave) AS longest_wave, round(date_diff('second', min(ts), max(ts)) / 60, 6) AS minutes
FROM events JOIN (SELECT file, count(*) AS n_waves, round(max(date_diff('second', start, "end")) / 60, 6) AS longest_wave FROM waves GROUP BY 1) w USING (file) WHERE details AND event IS NOT NULL GROUP BY file""",
    ),
    "log_endpoints": (log_endpoints, _LINES + "SELECT file, CASE WHEN event = 'endpoint_failed' THEN regexp_extract(m, 'fetch (\\w+)', 1) WHEN contains(m, 'mf_holdings') THEN 'holdings' ELSE 'ratios' END AS endpoint, event, limited, count(*) AS n FROM events WHERE event IN ('endpoint_failed', 'retry') GROUP BY ALL"),
    "macro_interpolated": (macro_interpolated, _AKIMA),
}
