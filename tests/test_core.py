import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fundpanel.functions import parsers as p
from fundpanel.operators import capture, extract, gauges, indicators, keyed, panel, series
from fundpanel.sources import tables
from fundpanel.streaming import jobs

D = dt.date
OBS = "product_id long, family string, metric string, code string, effective_date date, date_source_depth int, fetched_at timestamp, value double"


def cells(spark, rule, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(rule(F.col("v"))).collect()]


def obs(spark, rows):
    return spark.createDataFrame([(p_, f, m, c, d, 0, dt.datetime(2024, 1, 1), float(v)) for p_, f, m, c, d, v in rows], OBS)


def themes(spark):
    return spark.createDataFrame([("r1", "Clean & Green", None), ("c1", "Solar", "r1"), ("c2", "Wind", "r1")], "theme_id string, name string, parent_id string")


def prices(spark, product, *days):
    return spark.createDataFrame([(product, d) for d in days], "product_id long, date date")


def test_text_parsers(spark):
    assert cells(spark, p.snake_case, ["S&P 500!", " A--b ", None]) == ["sandp_500", "a_b", None]
    assert cells(spark, p.percentage, ["12.5%", "-", "n/a", "x", None, "NaN"]) == [0.125, None, None, None, None, None]
    assert cells(spark, p.percentage_error, ["12.5%", "-", "x", None]) == [False, False, True, False]
    assert cells(spark, lambda c: p.percentage(c, True), ["<5%", "~ 7"]) == [0.05, 0.07]
    assert cells(spark, p.parse_date, ["20240229", "2024-02-29T10", "2024/02/29", "1709164800000", "20240230", "soon"]) == [D(2024, 2, 29)] * 4 + [None] * 2
    assert cells(spark, p.net_assets, ["$1.5B", "EUR 1,234.5K", "1.234,5M", "1,234", "12,34", "€ 2M (2024/01/31)", "-", ""]) == [1.5e9, 1234500.0, 1234500000.0, 1234.0, 12.34, 2e6, None, None]
    assert cells(spark, p.largest_integer, ["9 of 1,234 funds", "none"]) == [1234, 0]
    assert cells(spark, p.credit_label, ["% Quality/AAA", "% Quality AA", "B"]) == ["AAA", "AA", "B"]
    known = F.array(F.lit("USD"), F.lit("EUR"))
    assert cells(spark, lambda c: p.amount_currency(c, F.lit("CAD"), known), ["USD 1", "$1", "€1", "XYZ 1", "1", "USDX"]) == ["USD", "CAD", None, None, None, None]
    assert cells(spark, lambda c: p.manager_tenure(c, F.lit("2024-01-01").cast("date")), ["2014", "2030-01-01", "-"]) == [pytest.approx(9.9986, abs=1e-3), 0.0, None]


def test_spine(spark):
    bounds = spark.createDataFrame([(1, D(2015, 1, 15), D(2015, 3, 2)), (2, D(2016, 2, 1), D(2016, 2, 1)), (3, D(2016, 2, 2), D(2016, 2, 1))], "product_id long, first_price date, last_price date")
    got = sorted((r[0], r[1]) for r in panel.month_spine(bounds).collect())
    assert got == [(1, D(2015, 1, 31)), (1, D(2015, 2, 28)), (1, D(2015, 3, 31)), (2, D(2016, 2, 29))]


def built(spark, rows, price_rows, fx=None):
    fx = fx or spark.createDataFrame([], "source_currency string, target_currency string, date date, close double")
    out = panel.build_panel(obs(spark, rows), price_rows, themes(spark), fx)
    return {(r.as_of_date, r.feature_id): r.value for r in out.collect()}


def test_panel_carries_and_caps(spark):
    # enough rows of the metric to survive pruning stand with another product
    other = [(9, "ratios", "pe", None, D(2020, m, 1), 5 + m / 10) for m in range(1, 9)]
    single = built(spark, [(1, "ratios", "pe", None, D(2022, 6, 15), 3), *other], prices(spark, 1, D(2022, 1, 3), D(2022, 9, 3)))
    assert len(single) == 9 and set(single.values()) == {3.0}
    two = built(spark, [(1, "ratios", "pe", None, D(2024, 1, 31), 3), (1, "ratios", "pe", None, D(2024, 3, 31), 4), *other], prices(spark, 1, D(2023, 12, 3), D(2024, 6, 3)))
    assert {k[0]: v for k, v in two.items()} == {D(2024, 1, 31): 3.0, D(2024, 2, 29): 3.0, D(2024, 3, 31): 4.0, D(2024, 4, 30): 4.0}


def test_panel_densifies_and_converts(spark):
    rows = [(1, "asset_class", "equity", None, D(2024, 1, 31), 0.8), (1, "asset_class", "cash", None, D(2024, 1, 31), 0.2)]
    rows += [(1, "asset_class", "equity", None, D(2024, m, 28), 1.0) for m in (2, 3, 4, 5)] + [(9, "asset_class", "cash", None, D(2020, m, 1), 1.0) for m in range(1, 6)]
    got = built(spark, rows, prices(spark, 1, D(2024, 1, 3), D(2024, 2, 3)))
    assert got[(D(2024, 2, 29), "asset_class_cash")] == 0.0 and got[(D(2024, 1, 31), "asset_class_cash")] == 0.2 and got[(D(2024, 1, 31), "asset_class_fixed_income")] == 0.0
    fx = spark.createDataFrame([("CAD", "USD", D(2024, 7, 2), 0.75)], "source_currency string, target_currency string, date date, close double")
    aum = obs(spark, [(1, "profile", "total_net_assets_local", "CAD", D(2024, 7, 5), 10e6), (1, "profile", "total_net_assets_local", "USD", D(2024, 7, 6), 8e6), (1, "profile", "total_net_assets_local", "EUR", D(2024, 7, 6), 1)])
    assert [(r.effective_date, r.value) for r in panel.aum_to_usd(aum, fx).collect()] == [(D(2024, 7, 31), 7.75e6)]


def test_themes(spark):
    rows = obs(spark, [(1, "theme", "solar", "c1", D(2024, 1, 1), 0.3), (1, "theme", "wind", None, D(2024, 1, 1), 0.5), (1, "theme", "other", None, D(2024, 1, 1), 0.2)])
    up = panel.roll_up_themes(rows, themes(spark)).collect()
    assert [(r.metric, r.code, round(r.value, 6)) for r in up] == [("clean_and_green", "r1", 0.8)]
    with pytest.raises(ValueError):
        panel.check_parent_themes(obs(spark, [(1, "theme", "x", "r1", D(2024, 1, 1), 1)]), themes(spark))


def test_outliers_and_style(spark):
    rows = obs(spark, [(1, "ratios", "pe", None, D(2023, 1, 1) + dt.timedelta(i), 20 + i / 10) for i in range(14)] + [(1, "ratios", "pe", None, D(2023, 3, 1), 1500)])
    assert [r.value for r in panel.outliers(rows).collect()] == [1500.0]
    style = obs(spark, [(1, "style_box", "a", None, D(2024, 1, 1), 1), (1, "style_box_hist", "b", None, D(2024, 1, 1), 1), (1, "style_box_hist", "b", None, D(2024, 2, 1), 1)])
    assert sorted((r.metric, r.effective_date.month, r.family) for r in panel.merge_style(style).collect()) == [("a", 1, "style_box"), ("b", 2, "style_box")]


def _series(spark, *rows):
    return spark.createDataFrame([(1, D(2024, 1, d), float(v)) for d, v in rows], "product_id long, date date, close double")


def test_series_verdicts(spark):
    spec = series.SeriesSpec(entity=("product_id",))
    old = _series(spark, *((d, 100 + d) for d in range(1, 13)))
    say = lambda new: series.validate(old, new, spec).first().verdict
    assert say(old) == "ok"
    assert say(old.filter("date <> '2024-01-05'")) == "date_mismatch"
    assert say(old.withColumn("close", F.when(F.col("date") == "2024-01-02", 1.0).otherwise(F.col("close")))) == "corporate_action"
    assert say(old.withColumn("close", F.when(F.col("date") >= "2024-01-08", F.col("close") / 2).otherwise(F.col("close")))) == "corporate_action"
    assert say(old.withColumn("close", F.when(F.col("date") == "2024-01-12", F.col("close") * 1.005).otherwise(F.col("close")))) == "ok"
    assert say(old.withColumn("close", F.when(F.col("date") == "2024-01-12", F.col("close") * 1.5).otherwise(F.col("close")))) == "value_mismatch"


def test_keyed(spark):
    a = spark.createDataFrame([(1, 2, 5.0), (2, 0, 6.0)], "k int, depth int, v double")
    b = spark.createDataFrame([(1, 2, 7.0), (2, 1, 8.0), (3, 0, 9.0)], "k int, depth int, v double")
    assert sorted(tuple(r) for r in keyed.upsert_newer(a, b, ["k"], ["depth"]).collect()) == [(1, 2, 5.0), (2, 1, 8.0), (3, 0, 9.0)]
    kept, gone = keyed.purge_orphans(a, b.filter("k = 1"), "k")
    assert [r.k for r in kept.collect()] == [1] and [r.k for r in gone.collect()] == [2]


def test_changelog(spark):
    rows = spark.createDataFrame([(i, 1, "/x", h, dt.datetime(2024, 1, i)) for i, h in enumerate("aabba", 1)], "snapshot_id long, product_id long, url_prefix string, hash string, created_at timestamp")
    assert sorted((r.snapshot_id, r.hash, r.last_checked_at.day) for r in capture.changelog(rows).collect()) == [(1, "a", 2), (3, "b", 4), (5, "a", 5)]


def _snapshots(spark, payloads):
    rows = [(i, i, dt.datetime(2024, 3, 1), text, "USD") for i, text in enumerate(payloads)]
    return spark.createDataFrame(rows, "snapshot_id long, product_id long, created_at timestamp, payload string, currency string")


def test_extractors(spark):
    got = extract.holdings(_snapshots(spark, ['{"as_of_date": 1706659200000, "allocation_self": [{"name": "Equity", "weight": 60}, {"name": "Cash", "weight": -5}, {"name": "Other", "weight": 40}]}'])).collect()
    assert {(r.metric, r.value, r.effective_date, r.date_source_depth) for r in got} == {("equity", 0.6, D(2024, 1, 31), 1), ("cash", 0.0, D(2024, 1, 31), 1)}
    tree = '{"asOfDate": "20240131", "coverage": 0.9, "content": [{"name": "TRESGS", "value": 7, "children": [{"name": "TRESGENS", "value": 5, "children": [{"name": "TRESGENRRS", "value": 4}]}]}]}'
    assert {(r.metric, r.value) for r in extract.esg(_snapshots(spark, [tree])).collect()} == {("esg_coverage", 0.9), ("tresgs", 7.0), ("tresgens", 5.0), ("tresgenrrs", 4.0)}
    stars = '{"as_of_date": "20240131", "summary": [{"id": "q_quantitative_rating", "value": "Gold"}, {"id": "people", "value": "High", "publish_date": "20240215"}, {"id": "category", "value": "x"}, {"id": "parent", "value": "-"}]}'
    assert {(r.metric, r.value, r.date_source_depth) for r in extract.mstar(_snapshots(spark, [stars])).collect()} == {("mstar_coverage", 2 / 3, 1), ("medalist_rating", 5.0, 1), ("people", 5.0, 3)}
    peers = '{"universes": [{"name": "Japan", "overall": [{"name_tag": "Total Return", "rating": {"name": "10 funds", "value": 3}}]}, {"name": "UK", "as_of_date": 1706659200000, "overall": [{"name_tag": "Total Return", "rating": {"name": "1,200 funds", "value": 4}}]}]}'
    assert [(r.metric, r.value, r.raw_value) for r in extract.lipper(_snapshots(spark, [peers])).collect()] == [("total_return_overall", 4.0, "4 (UK: 1200 funds)")]
    box = '{"mstar": {"x_axis_tag": ["Value", "Core", "Growth"], "y_axis_tag": ["Large", "Multi", "Mid", "Small"], "selected": [[1, 0]], "hist": [[5, 0]]}, "fund_and_profile": [{"name_tag": "Total_Net_Assets_Month_End", "value": "$1.5M (2024/01/31)"}, {"name_tag": "Management_Approach", "value": "Passive"}]}'
    got = extract.profile(_snapshots(spark, [box]), F.array(F.lit("USD"))).collect()
    assert {(r.metric, r.value) for r in got if r.error is None} == {("large_core", 1.0), ("total_net_assets_local", 1.5e6), ("is_passive", 1.0)}
    assert [r.error for r in got if r.error] == ["bad style box"]


def test_gauges(spark):
    rows = spark.createDataFrame([(f"c{i:02d}", code, 2020, float(i), False) for i in range(40) for code in ("a", "b") if not (code == "b" and i == 0)], "country_code string, indicator_code string, year int, value double, is_projection boolean")
    nodes = spark.createDataFrame([("g", None, 1.0, None, None), ("g.x", "g", 0.5, 0.0, None), ("g.y", "g", 0.5, 0.0, None), ("h", None, 1.0, None, "g.x")], "path string, parent string, weight double, size_share double, reference string")
    parts = gauges.component_weights(spark.createDataFrame([("g.x", "a", "intensity"), ("g.y", "b", "intensity")], "leaf string, name string, kind string"), nodes)
    alts = spark.createDataFrame([("g.x", "a", 0, "none", "exact", 1), ("g.x", "a", 1, "a", "substitute", -1), ("g.y", "b", 0, "b", "exact", 1)], "leaf string, name string, idx int, code string, tier string, direction int")
    _, scores, support = gauges.run(rows, nodes, parts, alts, rows.select("country_code").distinct(), 2019)
    got = {(r.path, r.country_code): (r.score, r.weight_present) for r in scores.collect()}
    assert got[("g.x", "c00")] == (100.0, 1.0) and got[("h", "c00")][0] == 100.0 and got[("g", "c00")] == (100.0, 0.5) and got[("g.y", "c39")][0] == 100.0
    assert {(r.indicator_code, r.n) for r in support.collect()} == {("a", 40), ("b", 39)}
    with pytest.raises(ValueError):
        gauges.node_scores(spark.createDataFrame([("g.x", 2020, "c", 1.0, 1.0)], "path string, year int, country_code string, score double, weight_present double"), spark.createDataFrame([("g.x", None, 1.0, None), ("k", None, 1.0, "k")], "path string, parent string, weight double, reference string"))


def test_vif(spark):
    df = spark.range(60).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2 + F.pmod("id", F.lit(2))).cast("double").alias("b"), F.pmod(F.col("id") * 7, F.lit(11)).cast("double").alias("c"))
    assert len(indicators.vif_prune(df, ["a", "b", "c"])) == 2


def test_streams_equal_batches(spark, tmp_path):
    lines = [f"2024-01-01 00:{m:02d}:00 app.x INFO request failed {m}" for m in range(20)]
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("\n".join(lines))
    want = {(r.start, r.event, r.n) for r in jobs.log_counts(spark.read.text(str(src))).collect()}
    stream = spark.readStream.format("text").load(str(src))
    q = jobs.log_counts(stream).writeStream.outputMode("complete").format("memory").queryName("counts").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {(r.start, r.event, r.n) for r in spark.table("counts").collect()} == want and len(want) == 4


def test_rebuild(spark, tmp_path):
    root = str(tmp_path)
    tables.clear(spark, root, "monthly_panel")
    assert tables.read_table(spark, root, "monthly_panel").count() == 0
    for n in (3, 5):
        rows = spark.range(n).select(F.col("id").alias("product_id"), F.lit("2024-01-31").cast("date").alias("as_of_date"), F.lit("f").alias("feature_id"), F.lit(1.0).alias("value"))
        tables.rebuild(rows, root, "monthly_panel")
        assert tables.read_table(spark, root, "monthly_panel").count() == n
    held = tables.read_table(spark, root, "monthly_panel")  # a reader of the last version goes on after the next rebuild
    tables.rebuild(rows.filter("product_id < 4").union(rows.filter("product_id >= 4")), root, "monthly_panel")
    assert held.count() == 5 and len(list(Path(f"{root}/monthly_panel.versions").iterdir())) == 2
    with pytest.raises(Exception, match="boom"):
        tables.rebuild(rows.withColumn("value", F.raise_error(F.lit("boom")).cast("double")), root, "monthly_panel")
    assert tables.read_table(spark, root, "monthly_panel").count() == 5
    tables.reset_extraction(spark, root)
    assert [tables.read_table(spark, root, t).count() for t in ("monthly_panel", "processed_snapshots", "observations")] == [0, 0, 0]


def test_panel_without_input_is_empty(spark, tmp_path):
    from fundpanel.operators import panel

    root = str(tmp_path)
    empty = {t: spark.createDataFrame([], tables.SCHEMAS[t]) for t in ("observations", "prices", "themes", "fx")}
    tables.rebuild(spark.createDataFrame([(1, None, "f", 1.0)], tables.SCHEMAS["monthly_panel"]), root, "monthly_panel")
    panel.refresh_panel(empty["observations"], empty["prices"], empty["themes"], empty["fx"], root)
    assert tables.read_table(spark, root, "monthly_panel").count() == 0
    one = spark.createDataFrame([(1, "ratios", "pe", None, dt.date(2024, 1, 31), 1, dt.datetime(2024, 2, 1), 2.0, None)], tables.SCHEMAS["observations"])
    other = spark.createDataFrame([(2, dt.date(2024, 1, 31), *[1.0] * 6, 1, None)], tables.SCHEMAS["prices"])
    panel.refresh_panel(one, other, empty["themes"], empty["fx"], root)
    assert tables.read_table(spark, root, "monthly_panel").count() == 0
    panel.refresh_panel(one, other.withColumn("product_id", F.lit(1).cast("long")), empty["themes"], empty["fx"], root)
    assert [(r.product_id, r.feature_id, r.value) for r in tables.read_table(spark, root, "monthly_panel").collect()] in ([], [(1, "ratios_pe", 2.0)])


def test_tree_of_any_depth(spark):
    node = {"name": "TRESGCGVSS", "value": "1"}
    for name in ("TRESGCGSRS", "TRESGCGBDS", "TRESGCGS", "TRESGSOPRS", "TRESGS"):
        node = {"name": name, "value": "2", "children": [node]}
    payload = json.dumps({"asOfDate": "20240131", "coverage": 0.5, "content": [node]})
    got = extract.esg(_snapshots(spark, [payload])).filter("family = 'esg'").orderBy("ordinal").collect()
    assert [r.metric for r in got] == ["tresgs", "tresgsoprs", "tresgcgs", "tresgcgbds", "tresgcgsrs", "tresgcgvss"] and all(r.error is None for r in got)


def test_canonical_json(spark):
    from fundpanel.operators import capture

    texts = ['{"b": [3, 1, {"y": 1, "x": [2, "a", null]}], "a": 1}', '{"a": 1, "b": [{"x": ["a", null, 2], "y": 1}, 1, 3]}', '{"a": 1, "b": [3, 1]}', "no json", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", capture.canonical_hash(F.col("t")).alias("h")).orderBy("i").collect()
    assert got[0].h == got[1].h != got[2].h and got[3].h is None and got[4].h is None


def test_currency_bars(spark):
    from fundpanel.operators import series

    bars = spark.createDataFrame([("20240102", 1.5, "x"), ("2024-01-03T00:00:00Z", float("nan"), "x"), ("2024-01-04", 1.7, "x"), ("2024-01-04", 1.8, "x"), ("bad", 1.0, "x")], "Date string, Close double, Note string")
    got = series.normalise_rates(bars, F.lit("CNH"), F.lit("USD")).orderBy("date").collect()
    assert [(r.source_currency, str(r.date), r.close) for r in got] == [("CNH", "2024-01-02", 1.5), ("CNH", "2024-01-04", 1.8)]
    assert [r.c for r in spark.createDataFrame([("CNH",), ("EUR",)], "c string").select(series.priced_currency(F.col("c")).alias("c")).collect()] == ["CNY", "EUR"]



def test_views_read_all_of_lineitem(spark, tmp_path):
    from fundpanel.plans import adapters, panel_queries

    rows = [(order, 1 + order % 9, 1 + (order * 7 + line) % 11, line, dt.datetime(1996, 1 + (order + line) % 5, 1 + line), 10.0 * order + line, 1.0, "ANR"[order % 3], "FO"[line % 2]) for order in range(1, 41) for line in range(1, 8)]
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_partkey long, l_linenumber int, l_shipdate timestamp, l_extendedprice double, l_quantity double, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(o, o % 4) for o in range(1, 41)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(c, c) for c in range(4)], "c_custkey long, c_nationkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(n, f"NATION_{n}") for n in range(4)], "n_nationkey long, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    metrics = {
        "scalar": lambda r: (("ratios" if r[3] < 4 else "esg"), f"{r[7]}_{r[8]}".lower()),
        "aum": lambda r: ("profile", "total_net_assets_local"),
        "asset": lambda r: ("asset_class", ("equity", "fixed_income", "cash")[r[3] % 3]),
        "country": lambda r: ("country", f"nation_{r[0] % 4}"),
        "theme": lambda r: ("theme", f"nation_{r[0] % 4}"),
        "style": lambda r: ("style_box", ("large_value", "mid_core", "small_growth")[r[3] % 3]),
        "hist": lambda r: ("style_box_hist", ("large_core", "multi_growth")[r[3] % 2]),
    }
    total = 0
    for name, metric in metrics.items():
        cents, whole, n = {}, {}, {}
        for r in rows:
            day = r[4].date() if name in ("scalar", "aum") else r[4].date().replace(day=1)
            key, amount = (r[1], *metric(r), day), round(r[5] * 100) * (60 if name == "scalar" and r[0] % 211 == 0 else 1)
            cents[key], n[key] = cents.get(key, 0) + amount, n.get(key, 0) + 1
            whole[r[1], day] = whole.get((r[1], day), 0) + amount
        want = {k: v / n[k] / 100 if name == "scalar" else v / 100 if name == "aum" else v / whole[k[0], k[3]] for k, v in cents.items()}
        got = {(r.product_id, r.family, r.metric, r.effective_date): r.value for r in adapters.view(spark, str(tmp_path), f"obs_{name}").collect()}
        assert got == pytest.approx(want), name
        total += len(want)
    pruned = panel_queries.panel_pruned(spark, str(tmp_path)).collect()
    assert sum(r.n for r in pruned if r.metric != "rare") == total


def test_regression_equals_normal_equations(spark):
    import numpy as np

    from fundpanel.operators import macro

    rng = np.random.default_rng(3)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    f = rng.normal(size=(60, 2))
    factors = spark.createDataFrame([(d, float(a), float(b)) for d, (a, b) in zip(days, f, strict=True)], "date date, a double, b double")
    x = np.c_[np.ones(59), f[1:], f[:-1]]
    y = {p: x @ rng.normal(size=5) + rng.normal(size=59) * 0.1 for p in (1, 2)}
    rets = spark.createDataFrame([(p, d, float(v)) for p, ys in y.items() for d, v in zip(days[1:], ys, strict=True)], "product_id long, date date, ret double")
    got = {r.product_id: r for r in macro.regress(macro.lagged_design(rets, factors, ["a", "b"]), 5, hac_lags=3).collect()}
    for p, ys in y.items():
        inverse = np.linalg.inv(x.T @ x)
        beta = inverse @ x.T @ ys
        u = x * (ys - x @ beta)[:, None]
        s = u.T @ u
        for lag in range(1, 4):
            g = u[lag:].T @ u[:-lag]
            s += (1 - lag / 4) * (g + g.T)
        assert got[p].n == 59 and np.allclose(got[p].beta, beta) and np.allclose(got[p].se, np.sqrt(np.diag(inverse @ s @ inverse)))


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys

    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q))"], cwd=str(Path(__file__).parent.parent), capture_output=True, text=True, check=True)
    assert int(said.stdout.split()[-1]) > 80
