"""Country indicators: reshaping, derived series, diagnostics and vetting.

The master shape is long: country_code, indicator_code, year, value, is_projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranks

KEY = ["country_code", "indicator_code", "year"]


def tidy(rows: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Master shape: numbers coerced, incomplete rows dropped, no projection by default, countries of the universe."""
    flag = F.coalesce("is_projection", F.lit(False)) if "is_projection" in rows.columns else F.lit(False)
    out = rows.select("country_code", "indicator_code", F.col("year").cast("string").try_cast("int").alias("year"), F.col("value").cast("string").try_cast("double").alias("value"), flag.alias("is_projection")).dropna(subset=[*KEY, "value"])
    return out if universe is None else out.join(universe.select("country_code").distinct(), "country_code", "left_semi")


def flag_projections(rows: DataFrame, first_year: int, sources: Sequence[str] = ()) -> DataFrame:
    """is_projection: the year is first_year or later, or the row's source is one that projects."""
    return rows.withColumn("is_projection", (F.col("year") >= first_year) | (F.coalesce(F.col("source").isin(*sources), F.lit(False)) if sources else F.lit(False)))


def wide_to_long(rows: DataFrame, ids: Sequence[str], prefix: str = "") -> DataFrame:
    """Year columns (prefix and four digits) as rows: ids.., year, value."""
    years = [c for c in rows.columns if c.startswith(prefix) and c[len(prefix) :].isdigit() and len(c) == len(prefix) + 4]
    long = rows.select(*ids, *(F.col(c).cast("double").alias(c) for c in years)).unpivot(list(ids), years, "year", "value")
    return long.withColumn("year", F.substring("year", len(prefix) + 1, 4).cast("int")).filter("value IS NOT NULL")


def map_names(rows: DataFrame, aliases: DataFrame, name: str = "name") -> DataFrame:
    """Countries by code through a dimension (alias, country_code), in any case; unmatched names go."""
    dim = aliases.select(F.lower(F.trim("alias")).alias("__a"), "country_code").distinct()
    return rows.withColumn("__a", F.lower(F.trim(name))).join(dim, "__a").drop("__a")


def annual_mean(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.avg("value").alias("value"))


def year_end(rows: DataFrame, period: str) -> DataFrame:
    """A year's last value and its mean."""
    return rows.groupBy(*KEY).agg(F.max_by("value", period).alias("last"), F.avg("value").alias("mean"))


def period_mean(rows: DataFrame, day: str, first: str, last: str, year: int) -> DataFrame:
    """The mean of the days first..last, stamped to a year."""
    return rows.filter(F.col(day).between(F.lit(first), F.lit(last))).groupBy("country_code", "indicator_code").agg(F.avg("value").alias("value")).withColumn("year", F.lit(year))


def preferred_variant(rows: DataFrame, ranks: dict[str, Sequence[str]]) -> DataFrame:
    """Of rows with the same key the one whose columns have the values named first; values not named come last."""
    order: list[Column] = []
    for column, values in ranks.items():
        rank = F.lit(len(values))
        for i, v in reversed(list(enumerate(values))):
            rank = F.when(F.col(column) == v, i).otherwise(rank)
        order.append(rank)
    rest = [c for c in rows.columns if c not in KEY]
    return rows.groupBy(*KEY).agg(F.min_by(F.struct(*rest), F.struct(*order, *rest)).alias("r")).select(*KEY, "r.*")


def before_colon(rows: DataFrame) -> DataFrame:
    """Headers and text cells of the form code:label cut before the colon."""
    return rows.select(*(F.split_part(F.col(f"`{n}`"), F.lit(":"), F.lit(1)).alias(n.split(":")[0]) if t == "string" else F.col(f"`{n}`").alias(n.split(":")[0]) for n, t in rows.dtypes))


def structural_zeros(rows: DataFrame, universe: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """Rows and, for every code and year present, 0 for the countries that don't report, but for some."""
    years = rows.select("indicator_code", "year").distinct()
    grid = years.join(universe.filter(~F.col("country_code").isin(*excluded)).select("country_code").distinct(), how="cross")
    absent = grid.join(rows.select(*KEY), KEY, "left_anti").withColumns({"value": F.lit(0.0), "is_projection": F.lit(False)})
    return rows.select(*KEY, "value", "is_projection").unionByName(absent)


def allocate(shares: DataFrame, issuers: DataFrame, nobody: Sequence[str] = ("EUR",)) -> DataFrame:
    """A currency's share for each of its issuers (currency, country_code); some currencies are nobody's."""
    return shares.filter(~F.col("currency").isin(*nobody)).join(issuers.select("currency", "country_code"), "currency")


def rank_bands(rows: DataFrame, rank: str = "rank", tops: Sequence[int] = (100, 500)) -> DataFrame:
    """Per country and year how many ranks are in the tops; a band counts by its first number."""
    n = F.regexp_extract(rank, r"(\d+)", 1).try_cast("int")
    return rows.groupBy("country_code", "year").agg(*(F.count_if(n <= t).alias(f"top_{t}") for t in tops))


def field_sum(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Sum of fields, nulls as 0, over the rows of a country and year."""
    total = reduce(Column.__add__, (F.coalesce(f, F.lit(0.0)) for f in fields))
    return rows.groupBy("country_code", "year").agg(F.sum(total).alias("value"))


def dimension_totals(rows: DataFrame, sex: str = "sex", classif: str = "classif") -> DataFrame:
    """Rows for both sexes and for all classes."""
    c = F.col(classif)
    return rows.filter(F.col(sex).endswith("_T") & (c.isNull() | c.endswith("_TOTAL") | c.contains("GE15")))


def _code(rows: DataFrame, code: str, name: str = "value") -> DataFrame:
    return rows.filter(F.col("indicator_code") == code).groupBy("country_code", "year").agg(F.max("value").alias(name))


def _named(rows: DataFrame, code: str) -> DataFrame:
    return rows.filter("value IS NOT NULL").select("country_code", F.lit(code).alias("indicator_code"), "year", "value")


def year_index(rows: DataFrame, code: str) -> DataFrame:
    """(year, i): the years in which any country has the code, numbered."""
    return rows.filter(F.col("indicator_code") == code).select("year").distinct().withColumn("i", F.row_number().over(Window.orderBy("year")))


def growth(rows: DataFrame, code: str, name: str, own_years: bool = False) -> DataFrame:
    """Change in percent from the series' previous year: that of any country, or with own_years of the country."""
    own = _code(rows, code)
    if own_years:
        before = F.lag("value").over(Window.partitionBy("country_code").orderBy("year"))
        return _named(own.withColumn("value", (F.try_divide("value", before) - 1) * 100), name)
    own = own.join(year_index(rows, code), "year")
    old = own.select("country_code", (F.col("i") + 1).alias("i"), F.col("value").alias("old"))
    return _named(own.join(old, ["country_code", "i"]).withColumn("value", (F.try_divide("value", "old") - 1) * 100), name)


def forward(rows: DataFrame, code: str, name: str, years: int = 10, annualised: bool = True) -> DataFrame:
    """The change to the value some calendar years later, as annual growth in percent or as a difference."""
    own = _code(rows, code)
    later = own.select("country_code", (F.col("year") - years).alias("year"), F.col("value").alias("later"))
    both = own.join(later, ["country_code", "year"])
    ratio = F.try_divide("later", "value")
    value = F.when(ratio > 0, (F.pow(ratio, F.lit(1.0 / years)) - 1) * 100) if annualised else F.col("later") - F.col("value")
    return _named(both.withColumn("value", value), name)


def combine_first(a: DataFrame, b: DataFrame, key: Sequence[str] = ("country_code", "year")) -> DataFrame:
    """Values of a, those of b where a has none."""
    return a.select(*key, "value").join(b.select(*key, F.col("value").alias("other")), list(key), "full_outer").select(*key, F.coalesce("value", "other").alias("value"))


def trailing(rows: DataFrame, code: str, name: str, stat: str = "stddev_samp", span: int = 10, least: int = 8) -> DataFrame:
    """A statistic of the last `span` years of the series' index, given `least` values or more."""
    index = year_index(rows, code)
    own = _code(rows, code)
    grid = own.select("country_code").distinct().join(index, how="cross").join(own, ["country_code", "year"], "left")
    w = Window.partitionBy("country_code").orderBy("i").rowsBetween(1 - span, 0)
    value = F.when(F.count("value").over(w) >= least, F.expr(f"{stat}(value)").over(w))
    return _named(grid.withColumn("value", value), name)


def ratio(rows: DataFrame, a: str, b: str, name: str, factor: float = 1.0) -> DataFrame:
    """a / b * factor of the same country and year; none where b is 0."""
    both = _code(rows, a, "a").join(_code(rows, b, "b"), ["country_code", "year"])
    return _named(both.withColumn("value", F.try_divide("a", "b") * factor), name)


def ratio_of_means(rows: DataFrame, a: str, b: str, name: str, span: int = 10, least: int = 8) -> DataFrame:
    """Trailing mean of a over that of b, where that is positive."""
    x, y = trailing(rows, a, "a", "avg", span, least), trailing(rows, b, "b", "avg", span, least)
    both = x.select("country_code", "year", F.col("value").alias("a")).join(y.select("country_code", "year", F.col("value").alias("b")), ["country_code", "year"])
    return _named(both.filter("b > 0").withColumn("value", F.col("a") / F.col("b")), name)


def mean_of(rows: DataFrame, codes: Sequence[str], name: str) -> DataFrame:
    """Mean of whichever of some codes a country and year have."""
    return _named(rows.filter(F.col("indicator_code").isin(*codes)).groupBy("country_code", "year").agg(F.avg("value").alias("value")), name)


def self_sufficiency(rows: DataFrame, produced: str, consumed: str, name: str, net: bool = False) -> DataFrame:
    """Production over consumption, or its excess over consumption."""
    both = _code(rows, produced, "a").join(_code(rows, consumed, "b"), ["country_code", "year"])
    return _named(both.withColumn("value", F.try_divide(F.col("a") - F.col("b") if net else F.col("a"), "b")), name)


def derive(rows: DataFrame, formulas: dict[str, str]) -> DataFrame:
    """New indicators by SQL expressions over codes as columns; a formula without all its codes is skipped, infinities are null."""
    codes = sorted({c for f in formulas.values() for c in _names(f)})
    wide = rows.filter(F.col("indicator_code").isin(*codes)).groupBy("country_code", "year").pivot("indicator_code", codes).agg(F.max("value"))
    out = []
    for name, formula in formulas.items():
        value = F.expr(formula)
        out.append(_named(wide.withColumn("value", F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)), name))
    return reduce(DataFrame.unionByName, out)


def _names(formula: str) -> list[str]:
    import re

    return re.findall(r"`([^`]+)`", formula)


def log_if_skewed(rows: DataFrame) -> DataFrame:
    """Values by code, as logarithms where more than two, all positive, have a sample skewness over 1; adds logged."""
    n = F.count("value")
    skew = F.when((n > 2) & (F.stddev_pop("value") > 0), F.skewness("value") * F.sqrt(n * (n - 1)) / (n - 2))
    stats = rows.groupBy("indicator_code").agg(((F.min("value") > 0) & (skew > 1)).alias("logged"))
    return rows.join(stats, "indicator_code").withColumn("logged", F.coalesce("logged", F.lit(False))).withColumn("value", F.when(F.col("logged"), F.log("value")).otherwise(F.col("value")))


def coverage(rows: DataFrame, n_countries: int, recent: int) -> DataFrame:
    """Per code: share of countries, also in recent years, fill of the country-year grid, values per country."""
    years = F.max("year") - F.min("year") + 1
    new = F.col("year") >= recent
    return rows.groupBy("indicator_code").agg(
        (F.count_distinct("country_code") / n_countries).alias("coverage"), (F.count_distinct(F.when(new, F.col("country_code"))) / n_countries).alias("recent_coverage"),
        (F.count("*") / (years * n_countries)).alias("fill"), (F.count("*") / F.count_distinct("country_code")).alias("per_country"), F.max("year").alias("latest"),
    )


def degeneracy(rows: DataFrame) -> DataFrame:
    """Per code: different values, share of the commonest, share of zeros."""
    counts = rows.groupBy("indicator_code", "value").agg(F.count("*").alias("n"))
    return counts.groupBy("indicator_code").agg(F.count("*").alias("n_distinct"), (F.max("n") / F.sum("n")).alias("modal_share"), (F.coalesce(F.sum(F.when(F.col("value") == 0, F.col("n"))), F.lit(0)) / F.sum("n")).alias("zero_share"))


def variance_parts(rows: DataFrame) -> DataFrame:
    """Per code: variance between the countries' means, mean variance within, dynamism and intraclass correlation."""
    by = rows.groupBy("indicator_code", "country_code").agg(F.avg("value").alias("m"), F.var_samp("value").alias("v"))
    out = by.groupBy("indicator_code").agg(F.var_samp("m").alias("between"), F.avg("v").alias("within"))
    return out.withColumns({"dynamism": F.sqrt("within") / (F.sqrt("between") + 1e-9), "icc": F.try_divide("between", F.col("between") + F.col("within"))})


def role(dynamism: Column) -> Column:
    """structural up to 0.1, mixed up to 0.3, cyclical beyond."""
    return F.when(dynamism <= 0.1, "structural").when(dynamism <= 0.3, "mixed").when(dynamism > 0.3, "cyclical")


def gate_funnel(rows: DataFrame, gates: Sequence[str]) -> DataFrame:
    """(gate, position, survivors, failures): how many rows pass this gate and all before it, and how many fail it."""
    passed, parts = F.lit(True), []
    for i, g in enumerate(gates):
        passed = passed & F.coalesce(g, F.lit(False))
        parts.append(F.struct(F.lit(g).alias("gate"), F.lit(i).alias("position"), F.count_if(passed).alias("survivors"), F.count_if(~F.coalesce(g, F.lit(False))).alias("failures")))
    return rows.agg(F.array(*parts).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def observation_weights(observations: DataFrame) -> DataFrame:
    """(country_code, weight): each country's share of the country observations."""
    n = observations.filter("family = 'country' AND code IS NOT NULL").groupBy(F.col("code").alias("country_code")).agg(F.count("*").alias("n"))
    return n.select("country_code", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("weight"))


def weighted_coverage(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Per code the weight of the countries that have it."""
    return rows.select("indicator_code", "country_code").distinct().join(weights, "country_code").groupBy("indicator_code").agg(F.sum("weight").alias("weighted_coverage"))


def fence_sweep(table: DataFrame, columns: Sequence[str], zs: Sequence[float], variety: str | None = None) -> DataFrame:
    """For each z how many rows are below no column's median less z interquartile ranges, their least values (least_*), and how many different values of `variety` they have (n_different).

    One pass gives the quantiles, one more all counts.
    """
    q = table.agg(*(F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(c) for c in columns)).first()
    parts = []
    for z in zs:
        below = [F.col(c) < q[c][1] - z * (q[c][2] - q[c][0]) for c in columns if q[c] is not None]
        fails = F.coalesce(reduce(Column.__or__, below), F.lit(False)) if below else F.lit(False)
        least = [F.min(F.when(~fails, F.col(c))).alias(f"least_{c}") for c in columns]
        parts.append(F.struct(F.lit(float(z)).alias("z"), F.count_if(~fails).alias("kept"), F.count_if(fails).alias("failed"), *least, *([F.count_distinct(F.when(~fails, F.col(variety))).alias("n_different")] if variety else [])))
    return table.agg(F.array(*parts).alias("x")).select(F.inline("x"))


def five_row_difference(rows: DataFrame, first: str, fallback: Sequence[str], name: str, lag: int = 5) -> DataFrame:
    """A code's value, or where it has none the sum of the fallback codes, less the same `lag` rows earlier on the grid of years that any of them has."""
    level = _code(rows, first, "a")
    parts = [_code(rows, code, f"b{i}") for i, code in enumerate(fallback)]
    other = reduce(lambda x, y: x.join(y, ["country_code", "year"]), parts)
    both = level.join(other, ["country_code", "year"], "full_outer")
    both = both.select("country_code", "year", F.coalesce("a", reduce(Column.__add__, (F.col(f"b{i}") for i in range(len(parts))))).alias("value"))
    grid = both.select("year").distinct().withColumn("i", F.row_number().over(Window.orderBy("year")))  # a row per year
    now = both.join(grid, "year")
    before = now.select("country_code", (F.col("i") + lag).alias("i"), F.col("value").alias("old"))
    return _named(now.join(before, ["country_code", "i"]).select("country_code", "year", (F.col("value") - F.col("old")).alias("value")), name).filter("value IS NOT NULL")


def net_exports(rows: DataFrame, categories: dict[str, tuple[str, str]], exports: str, imports: str, gdp: str) -> DataFrame:
    """Per category (its codes of export and import shares in percent): exports less imports, in percent of GDP."""
    return derive(rows, {name: f"(`{x}` / 100 * `{exports}` - `{m}` / 100 * `{imports}`) / `{gdp}` * 100" for name, (x, m) in categories.items()}).filter("value IS NOT NULL")


def vetting_gates(diagnostics: DataFrame, limits: dict[str, float]) -> DataFrame:
    """diagnostics with a column per gate, and level_ok and change_ok.

    limits: coverage, recent_coverage, n_distinct, modal_share, zero_share, recent_fill, recent_per_country, fill and per_country; the shares are
    upper limits, all others lower ones.  The level tier needs coverage, recent and varied; the change tier needs all gates.
    """
    c = F.col
    gates = {
        "g_coverage": c("coverage") >= limits["coverage"],
        "g_recent": c("recent_coverage") >= limits["recent_coverage"],
        "g_varied": (c("n_distinct") >= limits["n_distinct"]) & (c("modal_share") <= limits["modal_share"]) & (c("zero_share") <= limits["zero_share"]) & (c("spread") > 0),
        "g_recent_fill": c("recent_fill") >= limits["recent_fill"],
        "g_recent_per_country": c("recent_per_country") >= limits["recent_per_country"],
        "g_fill": c("fill") >= limits["fill"],
        "g_per_country": c("per_country") >= limits["per_country"],
        "g_moves": c("within") > 0,
    }
    rows = diagnostics.withColumns({name: F.coalesce(test, F.lit(False)) for name, test in gates.items()})
    names = list(gates)
    return rows.withColumns({"level_ok": reduce(Column.__and__, map(c, names[:3])), "change_ok": reduce(Column.__and__, map(c, names))})


def scale_dependent(label: Column) -> Column:
    """Whether a label names money at current or constant prices, and no ratio or per-head figure."""
    money, ratio = r"(?i)\((?:current|constant)[^)]*\)", r"(?i)per capita|% of|per \d"
    return label.rlike(money) & ~label.rlike(ratio)


def rank_within(rows: DataFrame, by: Sequence[str], value: str = "value") -> Column:
    """Mean rank among ties."""
    w = Window.partitionBy(*by)
    return F.rank().over(w.orderBy(value)) + (F.count("*").over(Window.partitionBy(*by, value)) - 1) / 2


def spearman(rows: DataFrame) -> DataFrame:
    """(a, b, n, rho) for all pairs of codes over the country-years that both have; rho is null where one is constant."""
    return ranks.all_pairs(ranks.vectors(rows, "indicator_code", ["country_code", "year"]))


def vif_prune(wide: DataFrame, columns: Sequence[str], threshold: float = 10.0) -> list[str]:
    """Columns left after the one with the largest variance inflation is dropped again and again.

    One pass sums the products of complete rows; only that k x k matrix is on the driver.
    """
    rows = wide.select(*columns).dropna()
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    got = rows.agg(*(F.corr(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    corr = np.eye(len(columns))
    for i, j in pairs:
        if i != j:
            corr[i, j] = corr[j, i] = got[f"c{i}_{j}"] if got[f"c{i}_{j}"] is not None else 0.0
    left = list(range(len(columns)))
    while len(left) > 1:
        vif = np.diag(np.linalg.pinv(corr[np.ix_(left, left)]))
        if vif.max() <= threshold:
            break
        left.pop(int(vif.argmax()))
    return [columns[i] for i in left]
