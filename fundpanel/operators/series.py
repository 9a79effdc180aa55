"""Reconciling daily series (prices, currency rates) with a fresh batch, all entities in one pass.

A spec names the entity columns, the compared columns and the tolerances; every function is keyed by
the entity columns.  `old` and `new` hold (entity.., date, data..).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage


@dataclass(frozen=True)
class SeriesSpec:
    """What distinguishes price from currency series."""

    entity: tuple[str, ...]
    values: tuple[str, ...] = ("close",)
    close: str = "close"
    splits: bool = True
    rel_tol: float = 1e-6
    abs_tol: float = 1e-6
    settle_rel: float = 0.01
    settle_abs: float = 0.01
    overlap_days: int = 14
    recent: int = 5
    ratio_spread: float = 1e-3


#: Prices of a product, and rates between two currencies (no splits; a two-column entity).
PRICES = SeriesSpec(entity=("product_id",))
RATES = SeriesSpec(entity=("source_currency", "target_currency"), splits=False)
#: Currencies that are priced as another one.
PRICED_AS = {"CNH": "CNY"}


def priced_currency(currency: Column) -> Column:
    """The currency under which a rate is asked for."""
    return F.coalesce(*(F.when(currency == a, b) for a, b in PRICED_AS.items()), currency)


def normalise_rates(bars: DataFrame, source: Column, target: Column, max_date: Column | None = None) -> DataFrame:
    """Bars of a currency pair: column names in lower case, whole dates in UTC, none without a finite close."""
    rows = bars.select(*(F.col(f"`{c}`").alias(c.lower()) for c in bars.columns)).withColumns({"source_currency": source, "target_currency": target})
    return normalise_bars(rows, RATES, max_date)


def normalise_bars(bars: DataFrame, spec: SeriesSpec, max_date: Column | None = None) -> DataFrame:
    """Bars with a whole date, none after max_date, none without a finite close; of one date the row last in `ordinal`, without it or among equals the greatest by all columns."""
    day = F.coalesce(F.try_to_timestamp(F.col("date").cast("string"), F.lit("yyyyMMdd")), F.try_to_timestamp(F.substring(F.col("date").cast("string"), 1, 10), F.lit("yyyy-MM-dd"))).cast("date")
    rows = bars.withColumn("date", day).filter(F.col("date").isNotNull() & F.col(spec.close).isNotNull() & ~F.isnan(spec.close))
    if max_date is not None:
        rows = rows.filter(F.col("date") <= max_date)
    if "ordinal" not in rows.columns:
        rows = rows.withColumn("ordinal", F.lit(0))
    rest = [c for c in rows.columns if c not in (*spec.entity, "date")]
    return rows.groupBy(*spec.entity, "date").agg(F.max_by(F.struct(*rest), F.struct("ordinal", *[c for c in rest if c != "ordinal"])).alias("r")).select(*spec.entity, "date", "r.*").drop("ordinal")


def extent(rows: DataFrame, spec: SeriesSpec) -> DataFrame:
    """(entity.., last_date, n_bars)."""
    return rows.groupBy(*spec.entity).agg(F.max("date").alias("last_date"), F.count("*").alias("n_bars"))


def is_close(a: Column, b: Column, rel: float, absolute: float) -> Column:
    """Whether two numbers agree within the greater of both tolerances; null on either side counts as agreement."""
    return F.coalesce(F.abs(a - b) <= F.greatest(rel * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute)), F.lit(True))


def overlap(old: DataFrame, new: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Both sides of every date in the last overlap_days of the old series: columns o_*, n_*, has_old, has_new, recent."""
    last = old.groupBy(*spec.entity).agg(F.max("date").alias("last_date"))
    key = [*spec.entity, "date"]

    def side(rows: DataFrame, mark: str) -> DataFrame:
        rows = rows.join(last, list(spec.entity)).filter(F.col("date").between(F.date_sub("last_date", spec.overlap_days), F.col("last_date")))
        return rows.select(*key, *(F.col(c).alias(f"{mark}_{c}") for c in spec.values), F.lit(True).alias(f"has_{mark}"))

    a, b = side(old, "o"), side(new, "n")
    both = a.join(b, key, "full_outer").withColumns({"has_old": F.coalesce("has_o", F.lit(False)), "has_new": F.coalesce("has_n", F.lit(False))}).drop("has_o", "has_n")
    w = Window.partitionBy(*spec.entity).orderBy(F.col("has_old").desc(), F.col("date").desc())
    return both.withColumn("recent", F.row_number().over(w) <= spec.recent)


def _differs(spec: SeriesSpec) -> Column:
    return reduce(Column.__or__, (~is_close(F.col(f"o_{c}"), F.col(f"n_{c}"), spec.rel_tol, spec.abs_tol) for c in spec.values))


def validate(old: DataFrame, new: DataFrame, spec: SeriesSpec) -> DataFrame:
    """(entity.., verdict) of the overlap.

    date_mismatch if the dates differ; ok if nothing differs; corporate_action (restatement without splits) if a
    value before the recent dates differs, or if the recent ones differ by one ratio; value_mismatch
    if a recent one is beyond the settlement bounds; else ok.
    """
    rows = overlap(old, new, spec).withColumn("bad", F.col("has_old") & F.col("has_new") & _differs(spec))
    ratio = F.when(F.col("bad") & F.col("recent") & (F.col(f"o_{spec.close}") > 0), F.col(f"n_{spec.close}") / F.col(f"o_{spec.close}"))
    beyond = [(F.abs(F.col(f"n_{c}") - F.col(f"o_{c}")) > spec.settle_abs) & (F.abs(F.col(f"n_{c}") - F.col(f"o_{c}")) > spec.settle_rel * F.abs(F.col(f"o_{c}"))) for c in spec.values]
    stats = rows.groupBy(*spec.entity).agg(
        F.bool_or(F.col("has_old") != F.col("has_new")).alias("dates"), F.bool_or("bad").alias("any_bad"), F.bool_or(F.col("bad") & ~F.col("recent")).alias("core"),
        F.count(ratio).alias("n_ratio"), F.stddev_pop(ratio).alias("spread"), F.avg(ratio).alias("ratio"),
        F.bool_or(F.col("bad") & F.coalesce(reduce(Column.__or__, beyond), F.lit(False))).alias("beyond"),
    )
    action = "corporate_action" if spec.splits else "restatement"
    uniform = F.lit(spec.splits) & (F.col("n_ratio") >= 2) & (F.col("spread") <= spec.ratio_spread) & (F.abs(F.col("ratio") - 1) > spec.ratio_spread)
    verdict = F.when(F.col("dates"), "date_mismatch").when(~F.col("any_bad"), "ok").when(F.col("core"), action).when(uniform, "corporate_action").when(F.col("beyond"), "value_mismatch").otherwise("ok")
    return stats.select(*spec.entity, verdict.alias("verdict"))


def historical_change(old: DataFrame, new: DataFrame, spec: SeriesSpec) -> DataFrame:
    """(entity.., changed): whether an old bar before the overlap is missing from the new series or differs."""
    last = old.groupBy(*spec.entity).agg(F.max("date").alias("last_date"))
    key = [*spec.entity, "date"]
    a = old.join(last, list(spec.entity)).filter(F.col("date") < F.date_sub("last_date", spec.overlap_days)).select(*key, *(F.col(c).alias(f"o_{c}") for c in spec.values))
    b = new.select(*key, *(F.col(c).alias(f"n_{c}") for c in spec.values), F.lit(True).alias("found"))
    return a.join(b, key, "left").groupBy(*spec.entity).agg(F.bool_or(F.col("found").isNull() | _differs(spec)).alias("changed"))


def truncation(old: DataFrame, new: DataFrame, spec: SeriesSpec, share: float = 0.9) -> DataFrame:
    """(entity.., n_old, n_new, kept): whether a refetched series is long enough to replace the old one."""
    a, b = (x.groupBy(*spec.entity).agg(F.count("*").alias(n)) for x, n in ((old, "n_old"), (new, "n_new")))
    rows = a.join(b, list(spec.entity), "full_outer").fillna(0, ["n_old", "n_new"])
    return rows.withColumn("kept", F.col("n_new") >= F.when(F.col("n_old") > 5, F.floor(F.col("n_old") * share)).otherwise(1))


def upsert_tail(old: DataFrame, new: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The old series with new bars from the overlap on in place of their own."""
    key = [*spec.entity, "date"]
    last = old.groupBy(*spec.entity).agg(F.max("date").alias("last_date"))
    tail = new.join(last, list(spec.entity), "left").filter(F.col("last_date").isNull() | (F.col("date") >= F.date_sub("last_date", spec.overlap_days)))
    tail = tail.select(*old.columns)
    return old.join(tail.select(*key), key, "left_anti").unionByName(tail)


def decide(old: DataFrame, new: DataFrame, spec: SeriesSpec, refetched: DataFrame | None = None, share: float = 0.9) -> DataFrame:
    """One row per (entity.., date) of all sides, with the bars o, n and f (old, batch, refetched) and the entity's verdict, changed, n_old, n_new and action.

    All sides are dealt by entity once; bars of a date meet in an aggregate, what the overlap says comes from windows
    over the entity, both on that partitioning.  See validate, historical_change and truncation for the rules, reconcile for the actions.
    """
    entity, key = list(spec.entity), [*spec.entity, "date"]
    bar = F.struct(*(c for c in old.columns if c not in key))
    sides = {"o": old, "n": new, "f": new if refetched is None else refetched}
    kept = {m: rows for m, rows in sides.items() if m != "f" or refetched is not None}
    rows = reduce(DataFrame.unionByName, (r.select(*key, *((bar if m == mark else F.lit(None).cast(old.select(bar.alias("b")).schema["b"].dataType)).alias(m) for m in kept)) for mark, r in kept.items()))
    rows = rows.repartition(*entity).groupBy(*key).agg(*(F.first(m, ignorenulls=True).alias(m) for m in kept))
    if refetched is None:
        rows = rows.withColumn("f", F.col("n"))
    of = Window.partitionBy(*entity)
    has_old, has_new = F.col("o").isNotNull(), F.col("n").isNotNull()
    rows = rows.withColumn("last_date", F.max(F.when(has_old, F.col("date"))).over(of))
    inside = F.coalesce(F.col("date").between(F.date_sub("last_date", spec.overlap_days), F.col("last_date")), F.lit(False))
    rows = rows.withColumn("inside", inside & (has_old | has_new))
    place = F.row_number().over(of.orderBy((F.col("inside") & has_old).desc(), F.col("inside").desc(), F.col("date").desc()))

    def differs(mark: str) -> Column:
        return reduce(Column.__or__, (~is_close(F.col(f"o.{c}"), F.col(f"{mark}.{c}"), spec.rel_tol, spec.abs_tol) for c in spec.values))

    rows = rows.withColumns({"recent": place <= spec.recent, "bad": F.col("inside") & has_old & has_new & differs("n")})
    ratio = F.when(F.col("bad") & F.col("recent") & (F.col(f"o.{spec.close}") > 0), F.col(f"n.{spec.close}") / F.col(f"o.{spec.close}"))
    beyond = [(F.abs(F.col(f"n.{c}") - F.col(f"o.{c}")) > spec.settle_abs) & (F.abs(F.col(f"n.{c}") - F.col(f"o.{c}")) > spec.settle_rel * F.abs(F.col(f"o.{c}"))) for c in spec.values]
    earlier = has_old & (F.col("date") < F.date_sub("last_date", spec.overlap_days))
    rows = rows.withColumns({
        "dates": F.bool_or(F.col("inside") & (has_old != has_new)).over(of), "any_bad": F.bool_or("bad").over(of), "core": F.bool_or(F.col("bad") & ~F.col("recent")).over(of),
        "n_ratio": F.count(ratio).over(of), "spread": F.stddev_pop(ratio).over(of), "ratio": F.avg(ratio).over(of), "beyond": F.bool_or(F.col("bad") & F.coalesce(reduce(Column.__or__, beyond), F.lit(False))).over(of),
        "changed": F.bool_or(F.when(earlier, F.col("f").isNull() | differs("f"))).over(of), "n_old": F.count("o").over(of), "n_given": F.count("n").over(of), "n_new": F.count("f").over(of),
    })
    action = "corporate_action" if spec.splits else "restatement"
    uniform = F.lit(spec.splits) & (F.col("n_ratio") >= 2) & (F.col("spread") <= spec.ratio_spread) & (F.abs(F.col("ratio") - 1) > spec.ratio_spread)
    verdict = F.when(F.col("n_old") > 0, F.when(F.col("dates"), "date_mismatch").when(~F.col("any_bad"), "ok").when(F.col("core"), action).when(uniform, "corporate_action").when(F.col("beyond"), "value_mismatch").otherwise("ok"))
    long_enough = F.col("n_new") >= F.when(F.col("n_old") > 5, F.floor(F.col("n_old") * share)).otherwise(1)
    rows = rows.withColumn("verdict", verdict)
    step = F.when(F.col("n_given") == 0, "none").when(F.col("n_old") == 0, "fill").when(F.col("verdict") == "ok", "extend").when(long_enough, "replace").otherwise("error")
    rows = rows.filter("n_old > 0 OR n_given > 0").withColumn("action", step)
    return rows.select(*key, "o", "n", "f", "last_date", "verdict", "changed", "n_old", "n_new", "action")


def reconcile(old: DataFrame, new: DataFrame, spec: SeriesSpec, run_id: Column, refetched: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(series, archived, status) after a batch.

    Entities without old bars are filled, those in order extended.  Others are replaced by their refetched series (the
    batch itself if none is given) when that is long enough, and their old bars archived with run and reason
    when history changed; otherwise the old bars stay and the status is error.  Each side has one bar of a date.  The decisions are made
    in one pass and stored; the three results are filters of them.
    """
    entity, key = list(spec.entity), [*spec.entity, "date"]
    bars = stage(decide(old, new, spec, refetched))
    tail = F.col("n").isNotNull() & (F.col("date") >= F.date_sub("last_date", spec.overlap_days))
    bar = F.when(F.col("action").isin("fill", "replace"), F.col("f")).when((F.col("action") == "extend") & tail, F.col("n")).otherwise(F.col("o"))
    series = bars.withColumn("bar", bar).filter("bar IS NOT NULL").select(*key, "bar.*").select(*old.columns)
    gone = (F.col("action") == "replace") & F.coalesce("changed", F.lit(False)) & F.col("o").isNotNull()
    archived = bars.filter(gone).select(*key, "o.*", F.col("verdict").alias("reason")).select(*old.columns, "reason").withColumn("run_id", run_id)
    plan = bars.groupBy(*entity).agg(*(F.first(c).alias(c) for c in ("action", "n_old", "n_new")))
    message = F.when(F.col("action") == "error", F.substring(F.concat_ws(" ", F.lit("kept"), F.col("n_old").cast("string"), F.lit("bars, refetch has"), F.col("n_new").cast("string")), 1, 500))
    status = plan.select(*entity, "action", F.when(F.col("action") == "error", "error").when(F.col("action") == "none", "no_data").otherwise("ok").alias("status"), message.alias("error_message"))
    return series, archived, status


def load_status(rows: DataFrame, status: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Last date of every series beside its status; either may be missing."""
    entity = list(spec.entity)
    return rows.groupBy(*entity).agg(F.max("date").alias("last_date")).join(status, entity, "full_outer")


def is_fresh(last_date: Column, target: Column, status: Column, checked_at: Column, now: Column, hours: int) -> Column:
    """Bars reach the target date, or the last check, not an error, is recent enough."""
    recent = F.greatest(F.unix_seconds(now) - F.unix_seconds(checked_at), F.lit(0)) <= hours * 3600
    return F.coalesce((status != "error") | status.isNull(), F.lit(True)) & (F.coalesce(last_date >= target, F.lit(False)) | F.coalesce(status.isin("ok", "no_data") & recent, F.lit(False)))


def redundant_runs(cold: DataFrame, stored: DataFrame, spec: SeriesSpec, settle_days: int = 5) -> DataFrame:
    """(entity.., run_id) of archived runs that the stored series contains.

    Rows in a run's last settle_days + 2 days don't count.  A value differs if one side alone is null, or
    either tolerance is exceeded (the relative one against the archive, not at zero).
    """
    entity = list(spec.entity)
    last = cold.groupBy(*entity, "run_id").agg(F.max("date").alias("last_date"))
    rows = cold.join(last, [*entity, "run_id"]).filter(F.col("date") <= F.date_sub("last_date", settle_days + 2))
    a = rows.select(*entity, "run_id", "date", *(F.col(c).alias(f"o_{c}") for c in spec.values))
    b = stored.select(*entity, "date", *(F.col(c).alias(f"n_{c}") for c in spec.values), F.lit(True).alias("found"))

    def differs(c: str) -> Column:
        o, n = F.col(f"o_{c}"), F.col(f"n_{c}")
        d = F.abs(o - n)
        return (o.isNull() != n.isNull()) | F.coalesce(d > spec.abs_tol, F.lit(False)) | F.coalesce(F.try_divide(d, F.nullif(F.abs(o), F.lit(0.0))) > spec.rel_tol, F.lit(False))

    bad = a.join(b, [*entity, "date"], "left").filter(F.col("found").isNull() | reduce(Column.__or__, map(differs, spec.values)))
    return last.select(*entity, "run_id").join(bad.select(*entity, "run_id").distinct(), [*entity, "run_id"], "left_anti")
