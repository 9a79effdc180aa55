"""Country indicators collapsed to features of products, and returns against factors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType


def share_of_total(rows: DataFrame) -> DataFrame:
    """Each value as a share of the year's total over countries."""
    return rows.withColumn("value", F.try_divide("value", F.sum("value").over(Window.partitionBy("indicator_code", "year"))))


def fill_ratio(wide: DataFrame, target: str, a: str, b: str) -> DataFrame:
    """target, or a / b where it is null."""
    return wide.withColumn(target, F.coalesce(target, F.try_divide(a, b)))


def interpolate(grid: DataFrame) -> DataFrame:
    """Fills nulls of value per country_code and indicator_code over consecutive years.

    Inside a series by Akima's spline: at a known year it has the mean of the slopes to both sides, each weighted by how little
    the two slopes on the other side differ; slopes beyond the ends go on by equal differences, and two known years give a line.
    Outside by the line fitted to the nearest three values, and what then is null by the year's mean over countries.
    One exchange serves all windows but that mean.
    """
    part = Window.partitionBy("indicator_code", "country_code")
    w = part.orderBy("year")
    some = F.when(F.col("value").isNotNull(), F.struct("year", "value"))
    known_at = lambda k: F.expr(f"{'lag' if k < 0 else 'lead'}(point, {abs(k)}) IGNORE NULLS OVER (PARTITION BY indicator_code, country_code ORDER BY year)")
    rows = grid.withColumn("point", some).withColumns({f"p{k + 2}": F.col("point") if k == 0 else known_at(k) for k in range(-2, 3)})
    slope = lambda a, b: F.try_divide(F.col(f"{b}.value") - F.col(f"{a}.value"), F.col(f"{b}.year") - F.col(f"{a}.year"))
    before2, before, behind, behind2 = (slope(f"p{i}", f"p{i + 1}") for i in range(4))
    near = {"s1": F.coalesce(before, 2 * behind - behind2, behind), "s2": F.coalesce(behind, 2 * before - before2, before), "s0": before2, "s3": behind2}
    far = {"s0": F.coalesce("s0", 2 * F.col("s1") - F.col("s2")), "s3": F.coalesce("s3", 2 * F.col("s2") - F.col("s1"))}
    left, right = F.abs(F.col("s3") - F.col("s2")), F.abs(F.col("s1") - F.col("s0"))
    tangent = F.when(left + right > 0, (left * F.col("s1") + right * F.col("s2")) / (left + right)).otherwise((F.col("s1") + F.col("s2")) / 2)
    rows = rows.withColumns(near).withColumns(far).withColumn("knot", F.when(F.col("point").isNotNull(), F.struct("year", "value", tangent.alias("slope"))))
    rows = rows.withColumns({"prev": F.last("knot", True).over(w.rowsBetween(Window.unboundedPreceding, 0)), "next": F.first("knot", True).over(w.rowsBetween(0, Window.unboundedFollowing))})
    rows = rows.withColumn("known", F.array_sort(F.array_compact(F.collect_list("point").over(part))))
    h = F.col("next.year") - F.col("prev.year")
    u = F.try_divide(F.col("year") - F.col("prev.year"), h)
    inside = (1 + 2 * u) * (1 - u) * (1 - u) * F.col("prev.value") + u * (1 - u) * (1 - u) * h * F.col("prev.slope") + u * u * (3 - 2 * u) * F.col("next.value") + u * u * (u - 1) * h * F.col("next.slope")

    def line(three: Column) -> Column:
        n = F.size(three)
        middle = F.aggregate(three, F.lit(0.0), lambda acc, x: acc + x["year"], lambda acc: acc / n)
        mean = F.aggregate(three, F.lit(0.0), lambda acc, x: acc + x["value"], lambda acc: acc / n)
        sxx = F.aggregate(three, F.lit(0.0), lambda acc, x: acc + (x["year"] - middle) * (x["year"] - middle))
        sxy = F.aggregate(three, F.lit(0.0), lambda acc, x: acc + (x["year"] - middle) * (x["value"] - mean))
        return F.when(n >= 2, mean + F.try_divide(sxy, sxx) * (F.col("year") - middle)).otherwise(F.get(three, F.lit(0))["value"])

    outside = F.when(F.col("next").isNull(), line(F.slice("known", F.greatest(F.size("known") - 2, F.lit(1)), F.lit(3)))).otherwise(line(F.slice("known", F.lit(1), F.lit(3))))
    value = F.coalesce("value", F.when(F.col("prev").isNotNull() & F.col("next").isNotNull(), inside).when(F.size("known") > 0, outside))
    rows = rows.withColumn("value", value).select(*grid.columns)
    return rows.withColumn("value", F.coalesce("value", F.avg("value").over(Window.partitionBy("indicator_code", "year"))))


def smoothed_growth(rows: DataFrame) -> DataFrame:
    """(value - value three years before) / (3 * that), on complete years."""
    w = Window.partitionBy("indicator_code", "country_code").orderBy("year")
    old = F.lag("value", 3).over(w)
    return rows.withColumn("growth", F.try_divide(F.col("value") - old, 3 * old))


def available_year(day: Column, month: int = 6) -> Column:
    """The year whose figures a date may use: the last one before the month, the running one from it on."""
    return F.year(day) - F.when(F.month(day) < month, 1).otherwise(0)


def collapse(weights: DataFrame, rows: DataFrame) -> DataFrame:
    """(product_id, as_of_date, indicator_code, value, covered): country figures weighted by a product's country weights.

    weights: product_id, as_of_date, country_code, weight.  Null codes leave both sums, countries without a
    figure the numerator alone; covered is the weight of those with one.
    """
    known = weights.filter("country_code IS NOT NULL").withColumn("year", available_year(F.col("as_of_date")))
    total = known.groupBy("product_id", "as_of_date").agg(F.sum("weight").alias("total"))
    both = known.join(rows.select("country_code", "year", "indicator_code", F.col("value").alias("x")), ["country_code", "year"]).filter("x IS NOT NULL")
    out = both.groupBy("product_id", "as_of_date", "indicator_code").agg(F.sum(F.col("weight") * F.col("x")).alias("s"), F.sum("weight").alias("covered"))
    return out.join(total, ["product_id", "as_of_date"]).select("product_id", "as_of_date", "indicator_code", F.try_divide("s", "total").alias("value"), "covered")


def returns(prices: DataFrame, key: Sequence[str] = ("product_id",), close: str = "close") -> DataFrame:
    """(key.., date, ret): change from the series' previous date; nothing is filled."""
    before = F.lag(close).over(Window.partitionBy(*key).orderBy("date"))
    return prices.withColumn("ret", F.try_divide(close, before) - 1).filter("ret IS NOT NULL").select(*key, "date", "ret")


def lagged_design(rets: DataFrame, factors: DataFrame, names: Sequence[str], lags: int = 1) -> DataFrame:
    """(product_id, date, y, x): returns and a vector of 1, the factors and their lags, on dates that both have.

    factors has a row per date, so a calendar bounds what its one window holds.
    """
    w = Window.orderBy("date")
    f = factors.select("date", *names).withColumns({f"{n}_{k}": F.lag(n, k).over(w) for n in names for k in range(1, lags + 1)}).dropna()
    cols = [F.lit(1.0), *(F.col(n) for n in names), *(F.col(f"{n}_{k}") for k in range(1, lags + 1) for n in names)]
    return rets.join(f, "date").select("product_id", "date", F.col("ret").alias("y"), F.array(*cols).alias("x"))


def regress(design: DataFrame, k: int, hac_lags: int = 4) -> DataFrame:
    """(product_id, n, beta, se): least squares with Newey-West errors, per product.

    One aggregate gives X'X and X'y, a second, over lagged scores, the covariance; only the k x k solves leave SQL.
    """

    square = lambda x: np.stack(x.to_list()).reshape(-1, k, k)

    @F.pandas_udf(ArrayType(DoubleType()))
    def coefficients(xx: pd.Series, xy: pd.Series) -> pd.Series:
        """All products of a batch in one stacked solve."""
        return pd.Series(list((np.linalg.pinv(square(xx)) @ np.stack(xy.to_list())[..., None])[..., 0])) if len(xx) else pd.Series([], dtype=object)

    @F.pandas_udf(ArrayType(DoubleType()))
    def errors(xx: pd.Series, s: pd.Series) -> pd.Series:
        if not len(xx):
            return pd.Series([], dtype=object)
        inverse = np.linalg.pinv(square(xx))
        return pd.Series(list(np.sqrt(np.maximum(np.diagonal(inverse @ square(s) @ inverse, axis1=1, axis2=2), 0))))

    cross = [(i, j) for i in range(k) for j in range(k)]
    xx = F.array(*(F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in cross))
    xy = F.array(*(F.sum(F.col("x")[i] * F.col("y")) for i in range(k)))
    fit = design.groupBy("product_id").agg(F.count("*").alias("n"), xx.alias("xx"), xy.alias("xy")).withColumn("beta", coefficients("xx", "xy"))
    e = F.col("y") - F.aggregate(F.zip_with("x", "beta", lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    w = Window.partitionBy("product_id").orderBy("date")
    rows = design.join(fit.select("product_id", "beta"), "product_id").withColumn("e", e).withColumn("u", F.transform("x", lambda v: v * F.col("e")))
    rows = rows.withColumns({f"u{lag}": F.lag("u", lag).over(w) for lag in range(1, hac_lags + 1)})

    def term(i: int, j: int) -> Column:
        out = F.sum(F.col("u")[i] * F.col("u")[j])
        for lag in range(1, hac_lags + 1):
            weight = 1 - lag / (hac_lags + 1)
            out = out + weight * F.coalesce(F.sum(F.col("u")[i] * F.col(f"u{lag}")[j] + F.col(f"u{lag}")[i] * F.col("u")[j]), F.lit(0.0))
        return out

    s = rows.groupBy("product_id").agg(F.array(*(term(i, j) for i, j in cross)).alias("s"))
    return fit.join(s, "product_id").select("product_id", "n", "beta", errors("xx", "s").alias("se"))


def summed_beta(fit: DataFrame, names: Sequence[str], lags: int = 1) -> DataFrame:
    """A fit of lagged_design with summed: per factor the coefficients of all its lags added up."""
    at = lambda i: [1 + i + step * len(names) for step in range(lags + 1)]
    sums = {n: reduce(Column.__add__, (F.col("beta")[j] for j in at(i))) for i, n in enumerate(names)}
    return fit.withColumn("summed", F.create_map(*(x for n, c in sums.items() for x in (F.lit(n), c))))
