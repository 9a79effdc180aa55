"""Rank agreement, reconciliation in one pass and tree reports against plain Python."""

import random
from collections import defaultdict
from datetime import date, timedelta
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundpanel.operators import capture, gauges, indicators, macro, ranks, series


def mean_ranks(x):
    return [sum(b < a for b in x) + (sum(b == a for b in x) + 1) / 2 for a in x]


def rho(a, b):
    a, b = mean_ranks(a), mean_ranks(b)
    if len(set(a)) < 2 or len(set(b)) < 2:
        return None
    return float(np.corrcoef(a, b)[0, 1])


def near(x, y):
    return x is None and y is None or x is not None and y is not None and abs(x - y) < 1e-9


@pytest.mark.parametrize("block", [64, 3])
def test_spearman_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ranks, "BLOCK", block)
    rng, values = random.Random(1), defaultdict(dict)
    for code in [f"c{i}" for i in range(11)] + ["flat", "alone", "one"]:
        for country in range(6):
            for year in range(5):
                if code in ("c0", "c1", "c2", "flat") or code == "alone" and year > 90 or code == "one" and (country, year) == (0, 0) or code[0] == "c" and rng.random() < 0.6:
                    values[code][f"n{country}", 2000 + year] = 1.0 if code == "flat" else float(rng.randrange(9))
    rows = [(c, i, y, v) for i, own in values.items() for (c, y), v in own.items()] + [("n0", "c0", 1990, None), ("n0", "c1", 1990, float("nan"))]
    got = {(r.a, r.b): (r.n, r.rho) for r in indicators.spearman(spark.createDataFrame(rows, "country_code string, indicator_code string, year int, value double")).collect()}
    want = {}
    for a, b in combinations(sorted(values), 2):
        both = sorted(values[a].keys() & values[b].keys())
        if both:
            want[a, b] = (len(both), rho([values[a][k] for k in both], [values[b][k] for k in both]))
    assert set(got) == set(want) and all(got[p][0] == n and near(got[p][1], r) for p, (n, r) in want.items())
    assert indicators.spearman(spark.createDataFrame([], "country_code string, indicator_code string, year int, value double")).count() == 0


def test_agreement_of_targets(spark):
    rng = random.Random(2)
    value = {(c, f"n{k}", y): rng.randrange(20) for c in "xyz" for k in range(8) for y in range(4) if rng.random() < 0.8}
    rows = spark.createDataFrame([(k, c, y, float(v)) for (c, k, y), v in value.items()], "country_code string, indicator_code string, year int, value double")
    alternatives = spark.createDataFrame([("l", "m", i, c, d) for i, (c, d) in enumerate((("x", 1), ("y", -1), ("none", 1), ("z", -1)))], "leaf string, name string, idx int, code string, direction int")
    targets = spark.createDataFrame([("n0",), ("n1",), ("n1",), ("n2",)], "country_code string")
    got = {(r.a, r.b): r for r in gauges.alternative_agreement(rows, alternatives, targets, least=4).collect()}
    assert set(got) == {(0, 1), (0, 3), (1, 3)}
    for (i, j), (a, b, sign) in {(0, 1): ("x", "y", -1), (0, 3): ("x", "z", -1), (1, 3): ("y", "z", 1)}.items():
        for keys, n, r in (({"n%d" % k for k in range(8)}, got[i, j].n, got[i, j].rho), ({"n0", "n1", "n2"}, got[i, j].n_target, got[i, j].rho_target)):
            both = [k for k in value if k[0] == a and (b, *k[1:]) in value and k[1] in keys]
            assert n == len(both) and near(r, sign * rho([value[k] for k in both], [value[b, *k[1:]] for k in both]))


def bars(rng, product, n, start=date(2024, 1, 1)):
    return {(product, start + timedelta(days=i)): float(rng.randrange(50, 150)) for i in range(n)}


def test_reconcile_equals_its_parts(spark):
    """The one pass decides as the single functions do; every action occurs."""
    rng, old, new, full = random.Random(3), {}, {}, {}
    for p in range(40):
        own = bars(rng, p, (30, 8, 60, 4, 40)[p // 8])
        batch = dict(own)
        kind = p % 8
        last = max(d for _, d in own)
        if kind == 1:
            batch = {k: v / 2 for k, v in own.items()}
        elif kind == 2:
            batch.pop((p, last - timedelta(days=2)))
        elif kind == 3:
            batch[p, last] *= 1.5
        elif kind == 4:
            batch = {k: v * (1.004 if k[1] == last else 1) for k, v in own.items()}
        elif kind == 5:
            batch[min(batch)] += 7  # before the overlap, if the series is long
        batch.update({(p, last + timedelta(days=i)): 1.0 for i in range(1, 3)})
        if kind != 6:
            old.update(own)
        if kind != 7:
            new.update(batch)
            full.update({k: v for k, v in batch.items() if p % 3 or k[1] > last - timedelta(days=3)})
    frame = lambda x: spark.createDataFrame([(p, d, v, p * 1.0) for (p, d), v in x.items()], "product_id long, date date, close double, volume double")
    a, b, c = map(frame, (old, new, full))
    spec = series.PRICES
    verdict = {r.product_id: r.verdict for r in series.validate(a, b, spec).collect()}
    kept = {r.product_id: r.kept for r in series.truncation(a, c, spec).collect()}
    changed = {r.product_id: r.changed for r in series.historical_change(a, c, spec).collect()}
    tail = {(r.product_id, r.date): r.close for r in series.upsert_tail(a, b, spec).collect()}
    found, archived, status = series.reconcile(a, b, spec, F.lit("run"), c)
    status = {r.product_id: r for r in status.collect()}
    want, gone = {}, set()
    for p in range(40):
        action = "none" if p % 8 == 7 else "fill" if p % 8 == 6 else "extend" if verdict[p] == "ok" else "replace" if kept[p] else "error"
        assert status[p].action == action and (status[p].error_message is not None) == (action == "error")
        source = old if action in ("none", "error") else tail if action == "extend" else full
        want.update({k: v for k, v in source.items() if k[0] == p})
        if action == "replace" and changed.get(p):
            gone.update(k for k in old if k[0] == p)
    assert {s.action for s in status.values()} == {"none", "fill", "extend", "replace", "error"} and gone
    assert {(r.product_id, r.date): r.close for r in found.collect()} == want
    assert {(r.product_id, r.date) for r in archived.filter("run_id = 'run' AND reason IS NOT NULL").collect()} == gone
    empty = a.limit(0)
    assert [x.count() for x in series.reconcile(empty, empty, spec, F.lit("run"))] == [0, 0, 0]
    assert series.reconcile(empty, b, spec, F.lit("run"))[0].count() == len(new)


def test_state_of_series(spark):
    now, hour = F.expr("TIMESTAMP '2024-01-02 00:00:00'"), 3600
    rows = [("reached", date(2024, 1, 1), None, None), ("reached, error", date(2024, 1, 1), "error", 0), ("short, checked", date(2023, 1, 1), "ok", 5 * hour), ("short, long ago", date(2023, 1, 1), "ok", 50 * hour), ("none, checked", None, "no_data", 5 * hour), ("to come", None, "ok", -5 * hour), ("nothing", None, None, None)]
    df = spark.createDataFrame(rows, "k string, last date, status string, age long").withColumn("at", F.timestamp_seconds(F.unix_seconds(now) - F.col("age")))
    got = {r.k for r in df.filter(series.is_fresh(F.col("last"), F.expr("DATE '2024-01-01'"), F.col("status"), F.col("at"), now, 24)).collect()}
    assert got == {"reached", "short, checked", "none, checked", "to come"}


def test_listed_products_and_projections(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "product_id long")
    products = spark.createDataFrame([(1, "A"), (2, None), (3, "C")], "product_id long, exchange_id string")
    assert sorted(tuple(r) for r in capture.listed_products(products, ids(1, 1, 2, 3), ids(1, 2, 2)).collect()) == [(1, "A"), (2, "SMART")]
    rows = spark.createDataFrame([(2025, None), (2026, "a"), (2020, "weo")], "year int, source string")
    assert [r.is_projection for r in indicators.flag_projections(rows, 2026, ["weo"]).collect()] == [False, True, True]


def test_summed_beta(spark):
    fit = spark.createDataFrame([(1, [9.0, 1.0, 2.0, 10.0, 20.0, 100.0, 200.0])], "product_id long, beta array<double>")
    assert macro.summed_beta(fit, ["a", "b"], lags=2).first().summed == {"a": 111.0, "b": 222.0}
