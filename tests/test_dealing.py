"""Observations and the panel's steps stay dealt by product; parts grow with the table."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__
from fundpanel.operators import panel
from fundpanel.plans import adapters
from fundpanel.sources.staging import stage

TABLES = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_observations_are_dealt_once(spark):
    obs = adapters.view(spark, TABLES, "observations")
    assert "Exchange" not in plan(panel.staleness_caps(panel.snapshot_dates(obs), ["product_id", "family"]))
    assert "Exchange" not in plan(panel.validity(panel.snapshot_dates(obs), ["product_id", "family"]))
    assert "Exchange" not in plan(panel.snapshots_found(panel.merge_style(obs), adapters.parts(spark, TABLES)))
    themes, n = adapters.view(spark, TABLES, "themes"), adapters.parts(spark, TABLES)
    bounds = stage(spark.createDataFrame([(1, dt.date(1992, 1, 5), dt.date(1999, 1, 5))], "product_id long, first_price date, last_price date"), "product_id", n)
    assert "Exchange hashpartitioning(product_id" not in plan(panel.default_zero_panel(obs, themes, bounds, n))


def test_parts_grow_with_the_table(spark, monkeypatch):
    before = adapters.parts(spark, TABLES)
    monkeypatch.setattr(adapters, "PART_ROWS", 500)
    assert adapters.parts(spark, TABLES) > before
    obs = adapters.view(spark, TABLES, "obs_scalar")
    assert obs.rdd.getNumPartitions() == adapters.parts(spark, TABLES)


def test_values_are_counted_over_parts(spark):
    rows = [("esg", "a", v) for v in (1.0, 1.0, 2.0, None, 0.0, -0.0, float("nan"), float("nan"))] + [("esg", "b", float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "family string, metric string, value double")
    counted = panel.distinct_values(df, 7)
    assert "Exchange hashpartitioning(family" in plan(counted) and ", 7)" in plan(counted)
    assert {(r.metric, r.n_distinct) for r in counted.collect()} == {("a", 4), ("b", 500)}


def test_outliers_go_without_a_new_dealing(spark):
    obs = adapters.view(spark, TABLES, "obs_scalar")
    assert ", family" not in "".join(x for x in plan(panel.without_outliers(obs, parts=7)).split("\n") if "Exchange hashpartitioning" in x)
    day = dt.date(2024, 1, 1)
    rows = [(1, "esg", m, day + dt.timedelta(days=i), 1500.0 if i == 9 else 20.0 + i % 3 + i / 100) for i in range(20) for m in ("a", "b")]
    rows += [(1, "esg", "a", day + dt.timedelta(days=9), 20.5), (1, "mstar", "a", day, 1.0), (None, "esg", "a", day, 21.25)]  # a key twice, a family that isn't tested, a key with a null
    rows += [(2, "esg", "a", None if i == 9 else day + dt.timedelta(days=i), 900.0 if i == 9 else 30.0 + i % 3 + i / 70) for i in range(20)]  # an outlier without a date
    df = spark.createDataFrame(rows, "product_id long, family string, metric string, effective_date date, value double")
    found = panel.outliers(df)
    assert sorted(r.value for r in found.collect()) == [900.0, 1500.0, 1500.0]
    want = df.join(found, ["product_id", "family", "metric", "effective_date"], "left_anti").select(*df.columns)
    got = panel.without_outliers(df)
    assert got.columns == df.columns and got.count() == want.count() == len(rows) - 3
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_outlier_tasks_are_bounded_by_parts(spark, monkeypatch):
    monkeypatch.setattr(adapters, "PART_ROWS", 500)
    n, staged = adapters.parts(spark, TABLES), []

    def keep(df, *more):
        staged.append(df)
        return stage(df, *more)

    monkeypatch.setattr(panel, "stage", keep)
    found = __spark_entry__.queries()["panel_outlier_summary"](spark, TABLES)
    plans = "\n".join(plan(x) for x in (found, *staged))
    dealt = [x for x in plans.split("\n") if "Exchange hashpartitioning" in x]
    # lines by product and values by their hashes fall into as many parts as the table needs; else only a task's row per metric is dealt
    whole = [x for x in dealt if "l_suppkey" in x or "share" in x]
    assert len(staged) == 1 and len(whole) == 4 and all(f", {n}), REPARTITION_BY_NUM" in x for x in whole)
    assert not any("product_id" in x or "value" in x for x in dealt)


def test_lines_without_and_with_several_orders(spark, tmp_path):
    when = dt.datetime(1996, 3, 2)
    rows = [(o, 1, line, when, 10.0 * o, 1.0, "A", "F") for o, line in ((1, 1), (2, 1), (2, 2), (3, 1))]
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp, l_extendedprice double, l_quantity double, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 0), (2, 0), (2, 1)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(0, 0), (1, 1)], "c_custkey long, c_nationkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "X"), (1, "Y")], "n_nationkey long, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    joined = adapters.view(spark, str(tmp_path), "line_nation").groupBy("n_name").agg(F.count("*").alias("n")).collect()
    assert {r.n_name: r.n for r in joined} == {"X": 3, "Y": 2}
    obs = adapters.view(spark, str(tmp_path), "observations")
    assert {r.family: r.value for r in obs.filter("family IN ('ratios', 'profile')").collect()} == {"ratios": 20.0, "profile": 80.0}


def test_payloads_are_dealt_over_all_tasks(spark):
    made = adapters.view(spark, TABLES, "profile_payloads")
    assert made.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert made.count() == adapters.view(spark, TABLES, "customer").count()


def test_views_are_stored_one_after_another(spark, monkeypatch):
    staged = []

    def keep(df, by=None, parts=None, *more):
        staged.extend((df, *more))
        return stage(df, by, parts, *more)

    monkeypatch.setattr(adapters, "stage", keep)
    obs = adapters.view(spark, TABLES, "observations")
    # a task that stores observations works on one view, not on all seven
    assert len(staged) == 8 and not any("Union" in plan(x) for x in staged)
    names = ("scalar", "aum", "asset", "country", "theme", "style", "hist")
    want = spark.sql(adapters.VIEWS["observations"], **{f"obs_{x}": adapters.view(spark, TABLES, f"obs_{x}") for x in names})
    assert obs.dtypes == want.dtypes and obs.count() == want.count()
    assert obs.exceptAll(want).isEmpty() and want.exceptAll(obs).isEmpty()
