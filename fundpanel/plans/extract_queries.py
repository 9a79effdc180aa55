"""Queries of the extractors' values over payloads of text, and SQL that reads the same text with JSON functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract
from .adapters import view

KNOWN = ("EUR", "USD")
SHOWN = ("snapshot_id", "family", "metric", "code", "effective_date", "date_source_depth")


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select(*SHOWN, F.round("value", 6).alias("value"), "error")


def extract_sleeves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top ten, countries, industries, ratings and maturities, with renamed, residual and negative members."""
    return _shown(extract.holdings(view(spark, sf_dir, "holdings_payloads")))


def extract_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expenses, tags, reports and the style box."""
    return _shown(extract.profile(view(spark, sf_dir, "profile_payloads"), F.array(*map(F.lit, KNOWN))))


def extract_pillars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pillar coverage and ratings; some snapshots name an unknown pillar."""
    return _shown(extract.mstar(view(spark, sf_dir, "mstar_payloads")))


def extract_peers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the universe with the most peers."""
    rows = extract.lipper(view(spark, sf_dir, "lipper_payloads"))
    return rows.select(*SHOWN, "value", "raw_value")


def extract_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored observations of odd days merged with new ones of all days, some of which are deeper, some later."""
    obs = view(spark, sf_dir, "obs_scalar").select(*extract.KEY, "code", "date_source_depth", F.col("fetched_at").cast("timestamp").alias("fetched_at"), "value")
    odd = F.dayofmonth("effective_date") % 2 == 1
    new = obs.withColumns({"value": F.col("value") + 1, "date_source_depth": (F.col("date_source_depth") + F.col("product_id") % 3 - 1).cast("int"), "fetched_at": F.when(F.col("product_id") % 2 == 0, F.col("fetched_at") + F.expr("interval 1 day")).otherwise(F.col("fetched_at")), "snapshot_id": F.lit(1).cast("long"), "ordinal": F.lit(0).cast("long")})
    return extract.merge_observations(obs.filter(odd), new).select(*extract.KEY, "value", "date_source_depth")


def extract_currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The currencies that contracts state."""
    contracts = view(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit("C"), "c_nationkey")).alias("currency"))
    return spark.createDataFrame([(c,) for c in extract.known_currencies(contracts)], "currency string")


def _select(metric: str, value: str, where: str = "true", family: str = "'profile'", code: str = "NULL", date: str = "DATE '2024-03-05'", depth: str = "0", error: str = "NULL") -> str:
    return f"SELECT snapshot_id, {family} AS family, {metric} AS metric, CAST({code} AS VARCHAR) AS code, {date} AS effective_date, CAST({depth} AS INTEGER) AS date_source_depth, round(CAST({value} AS DOUBLE), 6) AS value, CAST({error} AS VARCHAR) AS error FROM p WHERE {where}"


def _parsed(name: str) -> str:
    return f"WITH p AS (SELECT *, CAST(payload AS JSON) AS j FROM {{{name}}}) "


def _text(path: str) -> str:
    return f"(j->>'$.{path}')"


_PERCENT = "CAST(replace({}, '%', '') AS DOUBLE) / 100"
_ASSETS = "CASE WHEN {v} LIKE '$%' THEN CASE WHEN currency = 'USD' THEN 'USD' END ELSE 'EUR' END".format(v=_text("fund_and_profile[2].value"))
_PROFILE = [
    _select("'management_expense_ratio'", _text("expenses_allocation[0].ratio")),
    _select("'total_expense_ratio'", _PERCENT.format(_text("fund_and_profile[0].value"))),
    _select("'is_passive'", f"CASE {_text('fund_and_profile[1].value')} WHEN 'Passive' THEN 1 ELSE 0 END", f"{_text('fund_and_profile[1].value')} <> '-'"),
    _select("'total_net_assets_local'", f"CAST(replace(regexp_extract({_text('fund_and_profile[2].value')}, '([0-9]+,[0-9])M', 1), ',', '.') AS DOUBLE) * 1e6", f"{_ASSETS} IS NOT NULL", code=_ASSETS, date="DATE '2024-01-31'", depth="3"),
    _select("'manager_tenure_years'", f"round((DATE '2024-03-05' - CAST(replace({_text('fund_and_profile[3].value')}, '/', '-') AS DATE)) / 365.25, 4)"),
    _select("'audited_net_expense_ratio'", _PERCENT.format(_text("reports[0].fields[0].value")), date="DATE '2024-01-15'", depth="2"),
    _select("'prospectus_net_12b1_fee_ratio'", f"{_text('reports[1].fields[1].value')}::DOUBLE / 100"),
    _select("list_extract(['large', 'multi', 'mid', 'small'], CAST(j->>'$.mstar.selected[0][1]' AS INTEGER) + 1) || '_' || list_extract(['value', 'core', 'growth'], CAST(j->>'$.mstar.selected[0][0]' AS INTEGER) + 1)", "1", family="'style_box'"),
]


def _sleeve(items: str, family: str, names: dict[str, str], code: str = "NULL") -> str:
    """A sleeve's members that stay, by their names in the payload."""
    case = "CASE x.item->>'$.name' " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items()) + " END"
    share = f"greatest(CAST(x.item->>'$.weight' AS DOUBLE), 0) / list_sum(list_transform(CAST(j->'$.{items}' AS JSON[]), lambda y: greatest(CAST(y->>'$.weight' AS DOUBLE), 0)))"
    return f"SELECT snapshot_id, '{family}' AS family, {case} AS metric, {code} AS code, DATE '2024-01-31' AS effective_date, 1 AS date_source_depth, round({share}, 6) AS value, CAST(NULL AS VARCHAR) AS error FROM p, (SELECT unnest(CAST(j->'$.{items}' AS JSON[])) AS item) x WHERE {case} IS NOT NULL"


_TELECOM = "Telecommunication Services-Discontinued eff 09/19/2020"

QUERIES = {
    "extract_sleeves": (
        extract_sleeves,
        _parsed("holdings_payloads")
        + " UNION ALL ".join([
            _select("'top_10_weight'", _PERCENT.format(_text("top_10_weight")), date="DATE '2024-01-31'", depth="1"),
            _sleeve("industry", "industry", {"Technology": "technology", _TELECOM: "communication_services"}),
            _sleeve("debtor", "credit_rating", {"% Quality/AAA": "aaa", "BB": "bb"}),
            _sleeve("maturity", "maturity", {"Maturity Less Than 1 Year": "maturity_less_than_1_year"}),
            _sleeve("investor_country", "country", {"Guam": "guam", "Japan": "japan"}, "CASE x.item->>'$.name' WHEN 'Guam' THEN 'GU' ELSE x.item->>'$.country_code' END"),
        ]),
    ),
    "extract_profile": (extract_profile, _parsed("profile_payloads") + " UNION ALL ".join(_PROFILE)),
    "extract_pillars": (
        extract_pillars,
        _parsed("mstar_payloads")
        + " UNION ALL ".join([
            _select("'mstar_coverage'", "len(list_filter(j->>'$.summary[*].id', lambda x: x IN ('people', 'process', 'parent'))) / 3", date="DATE '2024-01-31'", depth="1"),
            _select("'medalist_rating'", f"CASE {_text('summary[0].value')} WHEN 'Gold' THEN 5 WHEN 'Silver' THEN 4 ELSE 2 END", family="'mstar'", date="DATE '2024-01-31'", depth="1"),
            _select("'people'", "CASE {0} WHEN 'High' THEN 5 ELSE 2 END".format(_text("summary[1].value")), family="'mstar'", date="DATE '2024-02-15'", depth="3"),
            _select("'morningstar_rating'", _text("summary[4].value"), f"{_text('summary[4].id')} = 'morningstar_rating'", family="'mstar'", date="DATE '2024-01-31'", depth="1"),
            _select("'weird'", "NULL", f"{_text('summary[4].id')} = 'weird'", family="'mstar'", date="DATE '2024-01-31'", depth="1", error="'unknown pillar weird'"),
        ]),
    ),
    "extract_peers": (
        extract_peers,
        _parsed("lipper_payloads")
        + """, c AS (SELECT snapshot_id, CASE WHEN j->>'$.universes[0].overall[0].rating.name' = '5,000 funds' THEN j->'$.universes[0]' ELSE j->'$.universes[1]' END AS u FROM p),
s AS (SELECT snapshot_id, u, 'overall' AS suffix, unnest(CAST(u->'$.overall' AS JSON[])) AS x FROM c UNION ALL SELECT snapshot_id, u, '3yr', unnest(CAST(u->'$."3_year"' AS JSON[])) FROM c)
SELECT snapshot_id, 'lipper' AS family, replace(lower(x->>'$.name_tag'), ' ', '_') || '_' || suffix AS metric, CAST(NULL AS VARCHAR) AS code, CASE WHEN u->>'$.as_of_date' IS NULL THEN DATE '2024-03-05' ELSE CAST(epoch_ms(CAST(u->>'$.as_of_date' AS BIGINT)) AS DATE) END AS effective_date, CASE WHEN u->>'$.as_of_date' IS NULL THEN 0 ELSE 2 END AS date_source_depth,
CAST(x->>'$.rating.value' AS DOUBLE) AS value, (x->>'$.rating.value') || ' (' || (u->>'$.name') || ': ' || replace(replace(x->>'$.rating.name', ',', ''), ' funds', '') || ' funds)' AS raw_value FROM s""",
    ),
    "extract_merged": (
        extract_merged,
        """SELECT product_id, family, metric, effective_date, CASE WHEN day(effective_date) % 2 = 1 AND (product_id % 3 = 0 OR product_id % 3 = 1 AND product_id % 2 = 1) THEN value ELSE value + 1 END AS value,
CAST(CASE WHEN day(effective_date) % 2 = 1 AND (product_id % 3 = 0 OR product_id % 3 = 1 AND product_id % 2 = 1) THEN date_source_depth ELSE date_source_depth + product_id % 3 - 1 END AS INTEGER) AS date_source_depth FROM {obs_scalar}""",
    ),
    "extract_currencies": (extract_currencies, "SELECT DISTINCT 'C' || c_nationkey AS currency FROM {customer} WHERE c_custkey % 3 > 0"),
}
