"""The month-end panel: every product and month with the numbers that were known and not stale.

Input frames: observations (product_id, family, metric, code, effective_date, date_source_depth, fetched_at,
value), prices (product_id, date), themes (theme_id, name, parent_id), fx (source_currency, target_currency,
date, close).  Functions are lazy but for the count of check_parent_themes() and what is staged: the candidate metrics, bounds, survivors.

`parts` says into how many parts the observations are dealt by product_id (see stage()): then nothing that works by product deals
them again, and what has to be dealt in another way falls into as many parts.  Without it Spark deals them where it has to.

A product's months run without a gap from its first to its last price, so carried values never
meet the spine in a range join: an interval is clipped to the product's bounds and its months are generated
(one equi-join with a row per product).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsers import snake_case
from ..sources.staging import stage
from ..sources.tables import clear, rebuild
from ..vocab import CLOSED_UNIVERSE, DEFAULT_ZERO_FAMILIES, SCALAR_FAMILIES

#: Families whose continuous metrics are tested for outliers.
OUTLIER_FAMILIES = ("ratios", "profile", "esg", "theme", "rank_adj_theme")
LOCAL_AUM = "total_net_assets_local"


def is_local_aum() -> Column:
    return (F.col("family") == "profile") & (F.col("metric") == LOCAL_AUM)


def trading_bounds(prices: DataFrame, observations: DataFrame) -> DataFrame:
    """(product_id, first_price, last_price) of products that also have observations."""
    known = observations.select("product_id").distinct()
    return prices.join(known, "product_id", "left_semi").groupBy("product_id").agg(F.min(F.to_date("date")).alias("first_price"), F.max(F.to_date("date")).alias("last_price"))


def month_ends(first: Column, last: Column) -> Column:
    """The month ends of all months from first to last; none if first is later."""
    months = F.transform(F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month")), F.last_day)
    return F.when(first <= last, months).otherwise(F.array().cast("array<date>"))


def month_spine(bounds: DataFrame) -> DataFrame:
    """(product_id, as_of_date): each month end from the first through the last price's month."""
    return bounds.select("product_id", F.explode(month_ends(F.col("first_price"), F.col("last_price"))).alias("as_of_date"))


def roots(themes: DataFrame) -> DataFrame:
    return themes.filter("parent_id IS NULL").select("theme_id", snake_case(F.trim("name")).alias("slug"))


def theme_mapping(themes: DataFrame) -> DataFrame:
    """(theme_id, slug, parent_id, parent_slug) of every theme below a root."""
    child = themes.filter("parent_id IS NOT NULL").select("theme_id", snake_case(F.trim("name")).alias("slug"), "parent_id")
    return child.join(roots(themes).select(F.col("theme_id").alias("parent_id"), F.col("slug").alias("parent_slug")), "parent_id").select("theme_id", "slug", "parent_id", "parent_slug")


def root_observations(observations: DataFrame, themes: DataFrame) -> DataFrame:
    """Theme observations that name a root: by its id, or without a child of that slug by its slug."""
    found = observations.filter(F.col("family").isin("theme", "rank_adj_theme"))
    root, child = roots(themes), theme_mapping(themes)
    by_id = found.join(root.select(F.col("theme_id").alias("code")), "code", "left_semi")
    by_slug = found.join(root.select(F.col("slug").alias("metric")), "metric", "left_semi").join(child.select(F.col("slug").alias("metric")), "metric", "left_anti")
    return by_id.unionByName(by_slug).dropDuplicates(["product_id", "family", "metric", "effective_date"])


def check_parent_themes(observations: DataFrame, themes: DataFrame) -> None:
    """Raises if an observation names a root theme."""
    n = root_observations(observations, themes).count()
    if n:
        raise ValueError(f"{n} theme observations name a parent theme")


def distinct_values(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """(family, metric, n_distinct): the values of a metric are dealt by their hashes, so no task holds more than a part of them."""
    share = F.pmod(F.xxhash64("value"), F.lit(16 * (parts or 64))).alias("share")
    by = ("family", "metric", "share")
    found = rows.filter("value IS NOT NULL").select("family", "metric", share, "value")
    found = (found.repartition(parts, *by) if parts else found.repartition(*by)).distinct()
    return found.groupBy("family", "metric").agg(F.count("*").alias("n_distinct"))


def continuous_metrics(observations: DataFrame, parts: int | None = None) -> DataFrame:
    """(family, metric, n_total, n_distinct, skew, lo, hi) of metrics with over 10 values that make 5 % of the rows."""
    n = F.count("value")
    # Spark's skewness is that of the population
    sample = F.when((n > 2) & (F.stddev_pop("value") > 0), F.skewness("value") * F.sqrt(n * (n - 1)) / (n - 2))
    rows = observations.filter(F.col("family").isin(*OUTLIER_FAMILIES) & (F.col("metric") != "is_passive"))
    found = rows.groupBy("family", "metric").agg(F.count("*").alias("n_total"), sample.alias("skew"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    found = found.join(F.broadcast(distinct_values(rows, parts)), ["family", "metric"]).select("family", "metric", "n_total", "n_distinct", "skew", "lo", "hi")
    return found.filter("n_distinct > 10 AND n_distinct / n_total >= 0.05")


def unskewed() -> Column:
    """value, its log above the minimum for a long right tail, or the log below the maximum for a long left one."""
    v = F.col("value")
    return F.when(F.col("skew") > 3, F.log(v - F.col("lo") + 1)).when(F.col("skew") < -3, F.log(F.col("hi") - v + 1)).otherwise(v)


def quantile(ordered: Column, share: float) -> Column:
    """A quantile of an array in ascending order, with linear interpolation; null for an empty one."""
    at = (F.size(ordered) - 1) * share
    low = F.get(ordered, F.floor(at).cast("int"))
    return low + (F.get(ordered, F.ceil(at).cast("int")) - low) * (at - F.floor(at))


def tested(observations: DataFrame, span: int, fences: float, parts: int | None) -> tuple[DataFrame, DataFrame]:
    """The candidate metrics' observations with is_outlier, and all others with false: beyond `fences` interquartile ranges from the median of the span before to the span after.

    Only the candidate metrics, a row per metric, are dealt by series; a window's few values are sorted once.
    """
    metrics = stage(continuous_metrics(observations, parts).select("family", "metric", "skew", "lo", "hi"))
    rows = observations.join(F.broadcast(metrics.withColumn("candidate", F.lit(True))), ["family", "metric"], "left")
    window = Window.partitionBy("product_id", "family", "metric").orderBy("effective_date").rowsBetween(-span, span)
    found = rows.filter("candidate").withColumn("z", unskewed()).withColumn("near", F.sort_array(F.collect_list("z").over(window)))
    found = found.withColumns({"q1": quantile(F.col("near"), 0.25), "q2": quantile(F.col("near"), 0.5), "q3": quantile(F.col("near"), 0.75)})
    iqr = F.col("q3") - F.col("q1")
    flag = F.coalesce((iqr > 0) & (F.abs(F.col("z") - F.col("q2")) > fences * iqr), F.lit(False))
    others = rows.filter("candidate IS NULL").select(*observations.columns, F.lit(False).alias("is_outlier"))
    return found.select(*observations.columns, flag.alias("is_outlier")), others


def flag_outliers(observations: DataFrame, span: int = 7, fences: float = 5.0, parts: int | None = None) -> DataFrame:
    """observations with is_outlier; see tested()."""
    found, others = tested(observations, span, fences, parts)
    return found.unionByName(others)


def outliers(observations: DataFrame, span: int = 7, fences: float = 5.0, parts: int | None = None) -> DataFrame:
    """The observations that flag_outliers() marks."""
    return flag_outliers(observations, span, fences, parts).filter("is_outlier").select("product_id", "family", "metric", "effective_date", "value")


def without_outliers(observations: DataFrame, span: int = 7, fences: float = 5.0, parts: int | None = None) -> DataFrame:
    """The observations without those whose key (product_id, family, metric, effective_date) some outlier has, as an anti-join with outliers() leaves them.

    A key's rows lie in one series, so a window on the series' dealing tells; a join on the whole key would deal all rows once more.
    """
    found, others = tested(observations, span, fences, parts)
    hit = F.bool_or("is_outlier").over(Window.partitionBy("product_id", "family", "metric", "effective_date"))
    # a null in a key equals nothing
    found = found.withColumn("hit", hit & F.col("product_id").isNotNull() & F.col("effective_date").isNotNull())
    return found.filter("NOT hit").select(*observations.columns).unionByName(others.select(*observations.columns))


def outlier_summary(found: DataFrame) -> DataFrame:
    """How many outliers each metric has, and their range."""
    return found.groupBy("family", "metric").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))


def roll_up_themes(observations: DataFrame, themes: DataFrame) -> DataFrame:
    """Sums theme observations to their parents: matched by code if there is one, else by slug; unmatched ones go.

    A product's themes on one date become one row per parent, with the greatest depth and fetch time.
    """
    is_theme = F.col("family").isin("theme", "rank_adj_theme")
    child = theme_mapping(themes)
    found = observations.filter(is_theme)
    # two equi-joins that no row passes both of, for what is one condition with OR; the rows are read once
    by_code = child.select(F.col("theme_id").alias("code"), F.col("parent_id").alias("of_code"), F.col("parent_slug").alias("slug_of_code"))
    by_slug = child.select(F.col("slug"), F.col("parent_id").alias("of_slug"), F.col("parent_slug").alias("slug_of_slug"))
    both = found.join(F.broadcast(by_code), "code", "left").join(F.broadcast(by_slug), F.col("code").isNull() & (F.col("metric") == F.col("slug")), "left")
    both = both.withColumns({"parent_id": F.coalesce("of_code", "of_slug"), "parent_slug": F.coalesce("slug_of_code", "slug_of_slug")}).filter("parent_id IS NOT NULL")
    up = both.groupBy("product_id", "family", "parent_slug", "parent_id", "effective_date").agg(F.sum("value").alias("value"), F.max("date_source_depth").alias("date_source_depth"), F.max("fetched_at").alias("fetched_at"))
    up = up.select("product_id", "family", F.col("parent_slug").alias("metric"), F.col("parent_id").alias("code"), "effective_date", "date_source_depth", "fetched_at", "value")
    return observations.filter(~is_theme).select(*up.columns).unionByName(up)


def metric_counts(observations: DataFrame) -> DataFrame:
    return observations.groupBy("family", "metric").agg(F.count("*").alias("n"))


def low_count_cutoff(counts: DataFrame) -> DataFrame:
    """One row (cutoff): the median count less 3 interquartile ranges, at least 5, rounded half to even."""
    q = F.percentile("n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return counts.agg(q.alias("q")).select(F.rint(F.greatest(F.lit(5.0), F.col("q")[1] - 3 * (F.col("q")[2] - F.col("q")[0]))).cast("int").alias("cutoff"))


def prune(observations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Observations of metrics that are common enough, and the list (family, metric, n, cutoff) of the others."""
    counts = metric_counts(observations)
    judged = counts.join(F.broadcast(low_count_cutoff(counts)), how="cross")
    keep = judged.filter("n >= cutoff").select("family", "metric")
    return observations.join(F.broadcast(keep), ["family", "metric"], "left_semi"), judged.filter("n < cutoff")


def merge_style(observations: DataFrame) -> DataFrame:
    """default-zero observations in which a date's style_box_hist counts only without a style_box row of that date."""
    style = observations.filter(F.col("family").isin("style_box", "style_box_hist"))
    own = F.bool_or(F.col("family") == "style_box").over(Window.partitionBy("product_id", "effective_date"))
    style = style.withColumn("own", own).filter(~F.col("own") | (F.col("family") == "style_box")).drop("own").withColumn("family", F.lit("style_box"))
    others = [f for f in DEFAULT_ZERO_FAMILIES if f != "style_box"]
    return observations.filter(F.col("family").isin(*others)).unionByName(style)


def snapshot_dates(observations: DataFrame) -> DataFrame:
    return observations.select("product_id", "family", "effective_date").distinct()


def _series(key: list[str]) -> tuple:
    part = Window.partitionBy(*key)
    return part, part.orderBy("effective_date")


def gaps(dated: DataFrame, key: list[str]) -> DataFrame:
    """Adds gap_days, the days since the series' previous date."""
    _, w = _series(key)
    return dated.withColumn("gap_days", F.datediff("effective_date", F.lag("effective_date").over(w)))


def nearest_day(days: Column) -> Column:
    """A percentile of whole days, rounded half to even; digits beyond the sixth are the interpolation's own error and would decide ties."""
    return F.rint(F.round(days, 6)).cast("int")


def staleness_caps(dated: DataFrame, key: list[str]) -> DataFrame:
    """(key.., n_gaps, cap, first_date): the 99th percentile of a series' gaps, rounded half to even."""
    cap = nearest_day(F.percentile("gap_days", F.lit(0.99)))
    return gaps(dated, key).filter("gap_days IS NULL OR gap_days > 0").groupBy(*key).agg(F.count("gap_days").alias("n_gaps"), cap.alias("cap"), F.min("effective_date").alias("first_date"))


def validity(dated: DataFrame, key: list[str]) -> DataFrame:
    """Adds valid_from and valid_to: until the day before the next date, the cap after the date at most.

    A series with a single date is valid at all times (both null).  Gaps, cap and next date come from windows
    over one partitioning, without a join.
    """
    part, w = _series(key)
    rows = gaps(dated, key)
    rows = rows.withColumns({"n_gaps": F.count("gap_days").over(part), "cap": nearest_day(F.percentile("gap_days", F.lit(0.99)).over(part)), "next": F.lead("effective_date").over(w)})
    many = F.col("n_gaps") > 0
    to = F.least(F.date_add("effective_date", F.col("cap")), F.date_sub("next", 1))
    return rows.withColumns({"valid_from": F.when(many, F.col("effective_date")), "valid_to": F.when(many, to)}).drop("gap_days", "n_gaps", "cap", "next")


def on_spine(valid: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows at each month end of the product's spine within their validity; drops valid_from and valid_to."""
    first, last = F.last_day("first_price"), F.last_day("last_price")
    start = F.greatest(first, F.last_day(F.coalesce("valid_from", first)))
    to = F.coalesce("valid_to", last)
    end = F.least(last, F.when(F.last_day(to) == to, to).otherwise(F.last_day(F.add_months(to, -1))))
    # a left join, and no months without bounds: an inner one would filter nulls below, and Spark then loses sight of how a union's rows are dealt
    months = F.when(F.col("first_price").isNotNull(), month_ends(start, end)).otherwise(F.array().cast("array<date>"))
    rows = valid.join(bounds, "product_id", "left").withColumn("as_of_date", F.explode(months))
    return rows.drop("valid_from", "valid_to", "first_price", "last_price")


def closed_universe(themes: DataFrame) -> DataFrame:
    """(family, metric): all members of the closed families, and every root theme in both theme families."""
    spark = themes.sparkSession
    fixed = spark.createDataFrame([(family, m) for family, members in CLOSED_UNIVERSE.items() for m in members], "family string, metric string")
    slug = roots(themes).select(F.explode(F.array(F.lit("theme"), F.lit("rank_adj_theme"))).alias("family"), F.col("slug").alias("metric"))
    return fixed.unionByName(slug.distinct())


def snapshots_found(observations: DataFrame, parts: int | None = None) -> DataFrame:
    """(product_id, family, effective_date, found, ever): what each snapshot reports as a map, and for countries all that the product ever reported.

    Everything works on one dealing of the rows, by product or by product and family; of a metric's several values in one snapshot the largest counts.
    """
    rows = observations.select("product_id", "family", "metric", "effective_date", "value")
    one = (rows if parts else rows.repartition("product_id", "family")).groupBy("product_id", "family", "effective_date", "metric").agg(F.max("value").alias("value"))
    ever = F.collect_set(F.when(F.col("family") == "country", F.col("metric"))).over(Window.partitionBy("product_id", "family"))
    snaps = one.withColumn("ever", ever).groupBy("product_id", "family", "effective_date")
    return snaps.agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("found"), F.first("ever").alias("ever"))


def laid_out(snaps: DataFrame, themes: DataFrame) -> DataFrame:
    """snaps with members (metric, value) in place of found and ever: all of the snapshot's universe, missing ones as zero.

    A universe is a closed one, or the countries that the product ever reported.
    """
    closed = closed_universe(themes).groupBy("family").agg(F.sort_array(F.collect_set("metric")).alias("closed"))
    rows = snaps.join(F.broadcast(closed), "family", "left")
    universe = F.when(F.col("family") == "country", F.sort_array("ever")).otherwise(F.coalesce("closed", F.array().cast("array<string>")))
    rows = rows.withColumn("universe", universe)
    members = F.transform("universe", lambda m: F.struct(m.alias("metric"), F.coalesce(F.try_element_at("found", m), F.lit(0.0)).alias("value")))
    return rows.withColumn("members", members).drop("closed", "universe", "found", "ever")


def dense_snapshots(observations: DataFrame, themes: DataFrame, parts: int | None = None) -> DataFrame:
    """(product_id, family, effective_date, members): each snapshot with all members of its universe; see laid_out()."""
    return laid_out(snapshots_found(observations, parts), themes).select("product_id", "family", "effective_date", "members")


def densify(observations: DataFrame, themes: DataFrame, parts: int | None = None) -> DataFrame:
    """(product_id, family, effective_date, metric, value): a row per member of dense_snapshots()."""
    return dense_snapshots(observations, themes, parts).select("product_id", "family", "effective_date", F.inline("members"))


def monthly_fx(fx: DataFrame, target: str = "USD") -> DataFrame:
    """(currency, month_end, rate): mean closing rate of each month."""
    return fx.filter(F.col("target_currency") == target).groupBy(F.col("source_currency").alias("currency"), F.last_day(F.to_date("date")).alias("month_end")).agg(F.avg("close").alias("rate"))


def aum_to_usd(observations: DataFrame, fx: DataFrame) -> DataFrame:
    """(product_id, effective_date, value): a month's mean of net assets in USD, dated at its end; what has no rate is left out."""
    rows = observations.filter(is_local_aum()).withColumn("month_end", F.last_day("effective_date"))
    rates = monthly_fx(fx).withColumnRenamed("currency", "code")
    rate = F.when(F.col("code") == "USD", 1.0).otherwise(F.col("rate"))
    rows = rows.join(F.broadcast(rates), ["code", "month_end"], "left").withColumn("usd", F.col("value") * rate).filter("usd IS NOT NULL")
    return rows.groupBy("product_id", F.col("month_end").alias("effective_date")).agg(F.avg("usd").alias("value"))


def feature_id(family: Column, metric: Column) -> Column:
    return F.concat_ws("_", family, metric)


def scalar_stream(observations: DataFrame, fx: DataFrame, parts: int | None = None) -> DataFrame:
    """(product_id, feature_id, effective_date, value) of scalar families, net assets in USD instead of local ones.

    Of several values of a feature on one date the one fetched last counts, then the larger.
    """
    own = observations.filter(F.col("family").isin(*SCALAR_FAMILIES) & ~is_local_aum())
    own = own.select("product_id", feature_id(F.col("family"), F.col("metric")).alias("feature_id"), "effective_date", F.col("fetched_at").cast("timestamp").alias("fetched_at"), "value")
    usd = aum_to_usd(observations, fx).select("product_id", F.lit("profile_total_net_assets_usd").alias("feature_id"), "effective_date", F.col("effective_date").cast("timestamp").alias("fetched_at"), "value")
    # one dealing by series serves the choice per date and the windows of the validity
    both = own.unionByName(usd)
    return latest_fetched(both if parts else both.repartition("product_id", "feature_id"), ["product_id", "feature_id", "effective_date"]).drop("fetched_at")


def latest_fetched(rows: DataFrame, key: list[str]) -> DataFrame:
    best = F.max_by(F.struct(*[c for c in rows.columns if c not in key]), F.struct("fetched_at", "value"))
    return rows.groupBy(*key).agg(best.alias("best")).select(*key, "best.*")


def scalar_panel(observations: DataFrame, fx: DataFrame, bounds: DataFrame, parts: int | None = None) -> DataFrame:
    valid = validity(scalar_stream(observations, fx, parts), ["product_id", "feature_id"])
    return on_spine(valid, bounds).select("product_id", "as_of_date", "feature_id", "value")


def default_zero_panel(observations: DataFrame, themes: DataFrame, bounds: DataFrame, parts: int | None = None) -> DataFrame:
    """Snapshots are carried to the month ends with what they report; zeros are laid out last."""
    live = validity(snapshots_found(merge_style(observations), parts), ["product_id", "family"])
    rows = laid_out(on_spine(live, bounds), themes).select("product_id", "as_of_date", "family", F.inline("members"))
    return rows.select("product_id", "as_of_date", feature_id(F.col("family"), F.col("metric")).alias("feature_id"), "value")


def survivors(observations: DataFrame, themes: DataFrame, parts: int | None = None) -> DataFrame:
    """Observations without outliers, themes rolled up, rare metrics pruned."""
    clean = flag_outliers(observations, parts=parts).filter("NOT is_outlier").drop("is_outlier")
    return prune(stage(roll_up_themes(clean, themes), "product_id", parts))[0]


def build_panel(observations: DataFrame, prices: DataFrame, themes: DataFrame, fx: DataFrame, check: bool = True, parts: int | None = None) -> DataFrame:
    """(product_id, as_of_date, feature_id, value) for every product with prices and observations.

    observations should be a stored table: the outlier test, the roll-up and the bounds read it.
    """
    if check:
        check_parent_themes(observations, themes)
    bounds = stage(trading_bounds(prices, observations), "product_id", parts)
    kept = survivors(observations, themes, parts)  # a filter of one stored table
    return default_zero_panel(kept, themes, bounds, parts).unionByName(scalar_panel(kept, fx, bounds, parts))


def refresh_panel(observations: DataFrame, prices: DataFrame, themes: DataFrame, fx: DataFrame, root: str) -> None:
    """Builds and stores the panel; without observations, or without a product that has both prices and observations, an empty one."""
    spark = observations.sparkSession
    if observations.isEmpty() or trading_bounds(prices, observations).isEmpty():
        clear(spark, root, "monthly_panel")
    else:
        rebuild(build_panel(observations, prices, themes, fx), root, "monthly_panel")
