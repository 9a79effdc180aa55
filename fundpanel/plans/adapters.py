"""Views that give the warehouse tables the shapes of the data model.

A view is one SQL text for Spark and DuckDB alike; table names stand in braces, braces of the text itself are doubled.  Sums are taken over whole
cents, so both engines get the same doubles whatever their order of summation.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import stage

_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_DATE = "CAST(l_shipdate AS DATE)"
_MONTH = "CAST(date_trunc('month', l_shipdate) AS DATE)"


def _share(family: str, metric: str, code: str = "nullif('', '')", source: str = "{lineitem}") -> str:
    """A monthly share of each supplier's sales."""
    return f"""SELECT product_id, '{family}' AS family, metric, code, effective_date, depth AS date_source_depth, fetched_at,
  CAST(cents AS DOUBLE) / sum(cents) OVER (PARTITION BY product_id, effective_date) AS value
FROM (SELECT l_suppkey AS product_id, {metric} AS metric, {code} AS code, {_MONTH} AS effective_date, max(l_linenumber) AS depth, max(l_shipdate) AS fetched_at,
  sum({_CENTS}) AS cents FROM {source} GROUP BY 1, 2, 3, 4) x"""


#: Views that Spark stores: several branches of a query read them.
STORED = ("observations",)
#: Views whose groups lie within a product: Spark deals lineitem by product once for all of them.
BY_PRODUCT = ("prices", "obs_scalar", "obs_aum", "obs_asset", "obs_style", "obs_hist")
#: Rows of lineitem in a part of the products: the parts of a larger table are more, not larger.
PART_ROWS = 250_000
#: Rows of customer in a part of the payload views: a payload takes long to read, and the table's own file may be a single split.
PAYLOAD_ROWS = 20_000
#: What the views by product read of lineitem.
LINE = ("l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus")

VIEWS = {
    "prices": f"""SELECT product_id, date, CAST(cents AS DOUBLE) / n / 100 AS close, CAST(hi AS DOUBLE) / 100 AS high, CAST(lo AS DOUBLE) / 100 AS low, CAST(volume AS DOUBLE) AS volume
FROM (SELECT l_suppkey AS product_id, {_DATE} AS date, sum(CAST(round(l_extendedprice / l_quantity * 100) AS BIGINT)) AS cents, count(*) AS n,
  max(CAST(round(l_extendedprice / l_quantity * 100) AS BIGINT)) AS hi, min(CAST(round(l_extendedprice / l_quantity * 100) AS BIGINT)) AS lo, sum(CAST(l_quantity AS BIGINT)) AS volume
  FROM {{lineitem}} GROUP BY 1, 2) x""",
    "series_new": """SELECT product_id, date, CASE WHEN product_id % 7 = 0 THEN close * 0.5 WHEN product_id % 5 = 0 AND recent <= 5 THEN close * 1.005
  WHEN product_id % 13 = 0 AND recent <= 3 THEN close + 40 ELSE close END AS close, volume
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY date DESC) AS recent FROM {prices}) x WHERE NOT (product_id % 11 = 0 AND recent = 3)""",
    "obs_scalar": f"""SELECT product_id, family, metric, nullif('', '') AS code, effective_date, depth AS date_source_depth, fetched_at, CAST(cents AS DOUBLE) / n / 100 AS value
FROM (SELECT l_suppkey AS product_id, CASE WHEN l_linenumber < 4 THEN 'ratios' ELSE 'esg' END AS family, lower(concat(l_returnflag, '_', l_linestatus)) AS metric, {_DATE} AS effective_date,
  max(l_linenumber) AS depth, max(l_shipdate) AS fetched_at, sum({_CENTS} * CASE WHEN l_orderkey % 211 = 0 THEN 60 ELSE 1 END) AS cents, count(*) AS n
  FROM {{lineitem}} GROUP BY 1, 2, 3, 4) x""",
    "obs_aum": f"""SELECT product_id, 'profile' AS family, 'total_net_assets_local' AS metric, code, effective_date, 3 AS date_source_depth, fetched_at, CAST(cents AS DOUBLE) / 100 AS value
FROM (SELECT l_suppkey AS product_id, max(CASE l_suppkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'URGENT' WHEN 2 THEN 'HIGH' ELSE 'XXX' END) AS code, {_DATE} AS effective_date, max(l_shipdate) AS fetched_at, sum({_CENTS}) AS cents
  FROM {{lineitem}} GROUP BY 1, 3) x""",
    "obs_asset": _share("asset_class", "CASE l_linenumber % 3 WHEN 0 THEN 'equity' WHEN 1 THEN 'fixed_income' ELSE 'cash' END"),
    "line_nation": "SELECT l_suppkey, l_linenumber, l_shipdate, l_extendedprice, n_name, n_nationkey FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey",
    "obs_country": _share("country", "lower(n_name)", source="{line_nation}"),
    "obs_theme": _share("theme", "lower(n_name)", "CASE WHEN n_nationkey % 2 = 0 THEN concat('n', CAST(n_nationkey AS {text})) END", "{line_nation}"),
    "obs_style": _share("style_box", "CASE l_linenumber % 3 WHEN 0 THEN 'large_value' WHEN 1 THEN 'mid_core' ELSE 'small_growth' END"),
    "obs_hist": _share("style_box_hist", "CASE l_linenumber % 2 WHEN 0 THEN 'large_core' ELSE 'multi_growth' END"),
    "observations": " UNION ALL ".join(f"SELECT product_id, family, metric, code, effective_date, date_source_depth, fetched_at, value FROM {{obs_{x}}}" for x in ("scalar", "aum", "asset", "country", "theme", "style", "hist")),
    "themes": """SELECT concat('r', CAST(r_regionkey AS {text})) AS theme_id, r_name AS name, nullif('', '') AS parent_id FROM {region}
UNION ALL SELECT concat('n', CAST(n_nationkey AS {text})), n_name, concat('r', CAST(n_regionkey AS {text})) FROM {nation}""",
    "fx": """SELECT upper(split_part(o_orderpriority, '-', 2)) AS source_currency, 'USD' AS target_currency, CAST(o_orderdate AS DATE) AS date, 0.5 + CAST(sum(o_custkey % 100) AS DOUBLE) / count(*) / 100 AS close
FROM {orders} GROUP BY 1, 2, 3""",
    "snapshots": """SELECT event_id AS snapshot_id, user_id AS product_id, event_type AS url_prefix, props AS payload, CAST(concat('h', CAST(user_id % 7 AS {text}), CAST(event_id % 3 AS {text})) AS {text}) AS hash, ts AS created_at FROM {events}""",
    "payloads": """SELECT 'orders' AS url_prefix, concat(CASE WHEN o_orderkey % 97 = 0 THEN 'x' ELSE '' END, '{{"customer":{{"id":', CAST(o_custkey AS {text}), CASE WHEN o_custkey % 3 = 0 THEN ',"vip":true' ELSE '' END, '}},"financials":[{{"name_tag":"', lower(split_part(o_orderpriority, '-', 2)), '","value":', CAST(o_custkey % 100 AS {text}), '}}',
  CASE WHEN o_orderkey % 5 = 0 THEN ',{{"as_of_date":0}}' ELSE '' END, '],"holdings":[', CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('{{"code":', CASE WHEN o_custkey % 2 = 0 THEN 'null' ELSE '"[x{{"' END, ',"name":"n', CAST(o_custkey % 50 AS {text}), '","tags":["a",null,1.5,[', CAST(o_orderkey % 3 AS {text}), ']]}}') END,
  '],"status":"', o_orderstatus, '"}}') AS payload FROM {orders} UNION ALL SELECT event_type, props FROM {events}""",
    "holdings_payloads": """SELECT c_custkey AS snapshot_id, c_custkey % 90 AS product_id, TIMESTAMP '2024-03-05 10:00:00' AS created_at, CASE WHEN c_custkey % 5 <> 0 THEN 'USD' END AS currency, concat('{{"as_of_date":"2024-01-31","top_10_weight":"', CAST(c_custkey % 90 AS {text}), '.5%","industry":[{{"name":"Technology","weight":', CAST(c_custkey % 7 + 1 AS {text}), '}},{{"name":"Telecommunication Services-Discontinued eff 09/19/2020","weight":', CAST(c_custkey % 5 + 1 AS {text}), '}},{{"name":"Non Classified Equity","weight":', CAST(c_custkey % 3 + 1 AS {text}), '}}],"debtor":[{{"name":"% Quality/AAA","weight":', CAST(c_custkey % 4 + 1 AS {text}), '}},{{"name":"Not Rated","weight":', CAST(c_custkey % 6 + 1 AS {text}), '}},{{"name":"BB","weight":-3}}],"maturity":[{{"name":"Maturity Less Than 1 Year","weight":', CAST(c_custkey % 9 + 1 AS {text}), '}},{{"name":"Maturity Other","weight":', CAST(c_custkey % 2 + 1 AS {text}), '}}],"investor_country":[{{"name":"Guam","weight":', CAST(c_custkey % 8 + 1 AS {text}), ',"country_code":"XX"}},{{"name":"Unidentified","weight":', CAST(c_custkey % 3 + 1 AS {text}), '}},{{"name":"Japan","weight":', CAST(c_custkey % 5 + 1 AS {text}), ',"country_code":"JP"}}]}}') AS payload FROM {customer}""",
    "profile_payloads": """SELECT c_custkey AS snapshot_id, c_custkey % 90 AS product_id, TIMESTAMP '2024-03-05 10:00:00' AS created_at, CASE WHEN c_custkey % 5 <> 0 THEN 'USD' END AS currency, concat('{{"expenses_allocation":[{{"name":"Management Expenses","value":"a","ratio":0.', CAST(c_custkey % 90 + 10 AS {text}), '}},{{"name":"Other","ratio":1}}],"fund_and_profile":[{{"name_tag":"Total_Expense_Ratio","value":"', CAST(c_custkey % 300 AS {text}), '.5%"}},{{"name":"Management Approach","value":"', CASE c_custkey % 3 WHEN 0 THEN 'Passive' WHEN 1 THEN 'Active' ELSE '-' END, '"}},{{"name":"Total Net Assets (Month End)","value":"', CASE c_custkey % 2 WHEN 0 THEN '$' ELSE 'EUR ' END, '', CAST(c_custkey % 900 AS {text}), ',5M (2024/01/31)"}},{{"name_tag":"Manager_Tenure","value":"20', lpad(CAST(c_custkey % 24 AS {text}), 2, '0'), '/03/01"}},{{"name_tag":"Inception_Date","value":"2001"}}],"reports":[{{"name":"Annual Report","as_of_date":"2024-01-15","fields":[{{"name":"Total Net Expense","value":"', CAST(c_custkey % 7 AS {text}), '.25%"}}]}},{{"name":"Prospectus Report","as_of_date":"2025-01-01","fields":[{{"name":"Prospectus Fee Waiver Ratio","value":"-"}},{{"name":"Prospectus Net 12b-1 Fee Ratio","value":"0.', CAST(c_custkey % 9 AS {text}), '"}}]}}],"mstar":{{"x_axis_tag":["Value","Core","Growth"],"y_axis_tag":["Large","Multi","Mid","Small"],"selected":[[', CAST(c_custkey % 3 AS {text}), ',', CAST(c_custkey % 4 AS {text}), ']]}}}}') AS payload FROM {customer}""",
    "mstar_payloads": """SELECT c_custkey AS snapshot_id, c_custkey % 90 AS product_id, TIMESTAMP '2024-03-05 10:00:00' AS created_at, CASE WHEN c_custkey % 5 <> 0 THEN 'USD' END AS currency, concat('{{"as_of_date":"20240131","summary":[{{"id":"q_quantitative_rating","value":"', CASE c_custkey % 3 WHEN 0 THEN 'Gold' WHEN 1 THEN 'Silver' ELSE 'Neutral' END, '"}},{{"id":"people","value":"', CASE WHEN c_custkey % 4 = 0 THEN 'High' ELSE 'below average' END, '","publish_date":"20240215"}},{{"id":"process","value":"-"}},{{"id":"category","value":"x"}},{{"id":"', CASE WHEN c_custkey % 11 = 0 THEN 'weird' ELSE 'morningstar_rating' END, '","value":"', CAST(1 + c_custkey % 5 AS {text}), '"}}]}}') AS payload FROM {customer}""",
    "lipper_payloads": """SELECT c_custkey AS snapshot_id, c_custkey % 90 AS product_id, TIMESTAMP '2024-03-05 10:00:00' AS created_at, CASE WHEN c_custkey % 5 <> 0 THEN 'USD' END AS currency, concat('{{"universes":[{{"name":"Japan","overall":[{{"name":"a","name_tag":"Total Return","rating":{{"name":"', CASE WHEN c_custkey % 4 = 0 THEN '5,000' ELSE '10' END, ' funds","value":', CAST(c_custkey % 5 AS {text}), '}}}}]}},{{"name":"UK","as_of_date":1706659200000,"overall":[{{"name":"a","name_tag":"Total Return","rating":{{"name":"1,200 funds","value":', CAST(c_custkey % 6 AS {text}), '}}}}],"3_year":[{{"name":"b","name_tag":"Expense","rating":{{"name":"900 funds","value":', CAST(c_custkey % 4 AS {text}), '}}}}]}}]}}') AS payload FROM {customer}""",
    "log_lines": """SELECT concat('run', CAST(user_id % 5 AS {text})) AS file, concat(CAST(date_trunc('second', ts) AS {text}), ' app.ingest.', CASE WHEN user_id % 5 = 4 THEN 'prices' ELSE 'details' END, ' INFO ', CASE
  WHEN user_id % 5 = 4 THEN concat('Product ', CAST(user_id AS {text}), ': incremental price update complete (', CAST(event_id % 40 AS {text}), ' bars)')
  WHEN event_type = 'error' THEN concat('Request to https://host/', CASE WHEN event_id % 2 = 0 THEN 'mf_holdings/' ELSE 'mf_ratios/' END, CAST(user_id AS {text}), ' failed (status ', CASE WHEN event_id % 3 = 0 THEN '503' ELSE '429' END, '), attempt ', CAST(1 + event_id % 4 AS {text}), '/5')
  WHEN event_type = 'click' THEN concat('HTTP 429 hit. Pausing outbound requests for ', CAST(event_id % 7 AS {text}), '.5s (next backoff: 9.0s)')
  WHEN event_type = 'view' THEN concat('Landing for product ', CAST(user_id AS {text}), ': changed=', CASE WHEN event_id % 3 = 0 THEN 'True' ELSE 'False' END)
  WHEN event_type = 'signup' THEN concat('Failed to fetch holdings for product ', CAST(user_id AS {text}), ': timeout') ELSE concat('Stored ', CAST(event_id AS {text})) END) AS value FROM {events}""",
    "indicator_gaps": "SELECT country_code, indicator_code, year, CASE WHEN CAST(round(value * 100) AS BIGINT) % 5 < 2 THEN nullif(0.0, 0.0) ELSE value END AS value FROM {indicators}",
    "indicators": """SELECT n_name AS country_code, split_part(o_orderpriority, '-', 2) AS indicator_code, y AS year, CAST(cents AS DOUBLE) / 100 AS value, y >= 2001 AS is_projection
FROM (SELECT n_name, o_orderpriority, CAST(year(o_orderdate) AS INT) AS y, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey GROUP BY 1, 2, 3) x""",
    "tree_nodes": """SELECT 'world' AS path, nullif('', '') AS parent, CAST(1 AS DOUBLE) AS weight, CAST(0 AS DOUBLE) AS size_share, nullif('', '') AS reference FROM (SELECT count(*) AS n FROM {region}) x
UNION ALL SELECT concat('r', CAST(r_regionkey AS {text})), 'world', CAST(1 AS DOUBLE) / count(*) OVER (), CAST(0 AS DOUBLE), nullif('', '') FROM {region}
UNION ALL SELECT concat('n', CAST(n_nationkey AS {text})), concat('r', CAST(n_regionkey AS {text})), CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY n_regionkey), CASE WHEN n_nationkey % 2 = 0 THEN CAST(0.4 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END, nullif('', '') FROM (SELECT n_nationkey, n_regionkey, 1 + count(c_custkey) AS n FROM {nation} LEFT JOIN {customer} ON c_nationkey = n_nationkey GROUP BY 1, 2) y""",
    "tree_components": """SELECT concat('n', CAST(n_nationkey AS {text})) AS leaf, 'u' AS name, 'size' AS kind FROM {nation} WHERE n_nationkey % 2 = 0
UNION ALL SELECT concat('n', CAST(n_nationkey AS {text})), 'h', 'intensity' FROM {nation} UNION ALL SELECT concat('n', CAST(n_nationkey AS {text})), 'm', 'intensity' FROM {nation}""",
    "tree_alternatives": """SELECT leaf, name, 0 AS idx, CASE WHEN name = 'u' THEN 'URGENT' WHEN name = 'h' THEN 'NOWHERE' ELSE 'MEDIUM' END AS code, CASE WHEN leaf = 'n9' AND name = 'h' THEN 'gap' ELSE 'exact' END AS tier, CASE WHEN name = 'm' THEN -1 ELSE 1 END AS direction FROM {tree_components}
UNION ALL SELECT leaf, name, 1, CASE WHEN name = 'm' THEN 'LOW' ELSE 'HIGH' END, CASE WHEN name = 'm' THEN 'proxy' ELSE 'substitute' END, 1 FROM {tree_components} WHERE name <> 'u' AND leaf <> 'n9' AND leaf <> 'n11'""",
    "tree_sources": "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN 'PAYWALL' ELSE nullif('', '') END AS reason FROM {supplier}",
    "tree_cites": "SELECT leaf, name, s_suppkey AS id FROM {tree_components} JOIN {supplier} ON leaf = concat('n', CAST(s_nationkey AS {text})) WHERE s_suppkey % 4 <> 0 AND (s_suppkey % 2 = 0 OR name = 'h')",
    "numbers_text": """SELECT l_orderkey, l_linenumber,
  concat(CASE l_linenumber % 4 WHEN 0 THEN '$' WHEN 1 THEN 'EUR ' WHEN 2 THEN '€' ELSE '' END, CAST(CAST(floor(l_extendedprice) AS BIGINT) AS {text}), '.', CAST(CAST(l_quantity AS BIGINT) AS {text}), CASE l_orderkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'K' WHEN 2 THEN 'B' ELSE '' END,
    CASE WHEN l_orderkey % 3 = 0 THEN concat(' (', CAST({date} AS {text}), ')') ELSE '' END) AS amount,
  concat(CASE WHEN l_orderkey % 5 = 0 THEN '<' ELSE '' END, CASE WHEN l_orderkey % 17 = 0 THEN 'n/a' WHEN l_orderkey % 23 = 0 THEN 'bad' ELSE concat(CAST(CAST(l_quantity AS BIGINT) AS {text}), '%') END) AS pct,
  CASE l_linenumber % 4 WHEN 0 THEN CAST({date} AS {text}) WHEN 1 THEN replace(CAST({date} AS {text}), '-', '/') WHEN 2 THEN replace(CAST({date} AS {text}), '-', '') ELSE 'n.a.' END AS day,
  concat(l_returnflag, ' & ', l_linestatus, ' No. ', CAST(l_linenumber AS {text}), '!') AS label, concat(CAST(l_orderkey AS {text}), ' of ', CAST(l_partkey AS {text}), ' funds') AS funds, {date} AS ref FROM {lineitem}""".replace("{date}", _DATE),
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations")


def needed(text: str) -> list[str]:
    """The views a text uses, each after those it uses itself."""
    out: list[str] = []
    for name in re.findall(r"\{(\w+)\}", text):
        if name in VIEWS:
            for x in (*needed(VIEWS[name]), name):
                if x not in out:
                    out.append(x)
    return out


def parts(spark: SparkSession, sf_dir: str) -> int:
    """How many parts the products are dealt into."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(view(spark, sf_dir, "lineitem").count() / PART_ROWS))


def lines(spark: SparkSession, sf_dir: str, of: int = 1) -> DataFrame:
    """lineitem dealt by product, into a multiple of `of` parts."""
    return view(spark, sf_dir, "lineitem").select(*LINE).repartition(of * math.ceil(parts(spark, sf_dir) / of), "l_suppkey")


def lines_with_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with nations, the keys of its orders' customers' nations (null without any), stored by product.

    The array keeps a line one row whatever the joins find.  Every exchange has as many parts as the lines have.
    """
    n = parts(spark, sf_dir)
    orders = view(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").repartition(n, "o_custkey")
    customers = view(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").repartition(n, "o_custkey")
    homes = orders.join(customers, "o_custkey").select(F.col("o_orderkey").alias("l_orderkey"), "c_nationkey").repartition(n, "l_orderkey")
    homes = homes.groupBy("l_orderkey").agg(F.collect_list("c_nationkey").alias("nations"))
    found = view(spark, sf_dir, "lineitem").select(*LINE).repartition(n, "l_orderkey").join(homes, "l_orderkey", "left")
    return stage(found.repartition(n, "l_suppkey"), "l_suppkey", n)


def line_nation(spark: SparkSession, sf_dir: str, stored: DataFrame) -> DataFrame:
    """The view of that name from stored lines_with_nations()."""
    nation = view(spark, sf_dir, "nation").select("n_name", "n_nationkey")
    found = stored.select("l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice", F.explode("nations").alias("n_nationkey"))
    return found.join(F.broadcast(nation), "n_nationkey")


def view(spark: SparkSession, sf_dir: str, name: str, known: dict[str, DataFrame] | None = None) -> DataFrame:
    """A table or view as a frame; a stored one is made once for all that it is part of."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    known = {} if known is None else known
    if name not in known:
        text = VIEWS[name].replace("{text}", "STRING")
        if "lines" not in known and "line_nation" in (name, *needed(text)):
            known["lines"] = lines_with_nations(spark, sf_dir)
        if name == "line_nation":
            found = line_nation(spark, sf_dir, known["lines"])
        else:
            given = {x: view(spark, sf_dir, x, known) for x in set(re.findall(r"\{(\w+)\}", text))}
            if name.endswith("_payloads"):
                n = max(spark.sparkContext.defaultParallelism, math.ceil(given["customer"].count() / PAYLOAD_ROWS))
                given["customer"] = given["customer"].repartition(n, "c_custkey")
            if name in BY_PRODUCT:
                given["lineitem"] = known["lines"] if "lines" in known else lines(spark, sf_dir)
            found = spark.sql(text, **given)
        if name in STORED:
            # a union of views: each is stored on its own, in the union's types
            views = [given[x].select(*(F.col(c).cast(kind) for c, kind in found.dtypes)) for x in re.findall(r"\{(\w+)\}", text)]
            found = stage(views[0], "product_id", parts(spark, sf_dir), *views[1:])
        known[name] = found
    return known[name]


def duckdb(text: str) -> str:
    """DuckDB's SQL for a query over tables and views in braces: views become CTEs."""
    named = lambda t: re.sub(r"\{(\w+)\}", lambda m: "v_" + m[1] if m[1] in VIEWS else m[1], t.replace("{text}", "VARCHAR"))
    body = named(text)
    ctes = [f"v_{x} AS ({named(VIEWS[x]).replace('{{', '{').replace('}}', '}')})" for x in needed(text)]
    if not ctes:
        return body
    if body.lstrip().upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {', '.join(ctes)}, {body.lstrip()[len('WITH RECURSIVE') :]}"
    if body.lstrip().upper().startswith("WITH"):
        return f"WITH {', '.join(ctes)}, {body.lstrip()[4:]}"
    return f"WITH {', '.join(ctes)} {body}"
