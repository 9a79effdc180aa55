"""Ties of percentiles between two whole days."""

import datetime as dt

from fundpanel.operators import panel


def test_caps_round_exact_ties_half_to_even(spark):
    # gaps of 39 and 189 days: 187.5 exactly, a hair less in Spark's interpolation; of 23, 23, 23 and 73: 71.5, a hair less in DuckDB's
    gaps = {1: [39, 189], 2: [23, 23, 23, 73], 3: [10]}
    rows = []
    for product, days in gaps.items():
        at = dt.date(2020, 1, 1)
        rows.append((product, at))
        for n in days:
            at += dt.timedelta(days=n)
            rows.append((product, at))
    dated = spark.createDataFrame(rows, "product_id long, effective_date date")
    want = {1: 188, 2: 72, 3: 10}
    assert {r.product_id: r.cap for r in panel.staleness_caps(dated, ["product_id"]).collect()} == want
    last = panel.validity(dated, ["product_id"]).groupBy("product_id").agg({"effective_date": "max", "valid_to": "max"}).collect()
    assert {r.product_id: (r["max(valid_to)"] - r["max(effective_date)"]).days for r in last} == want
