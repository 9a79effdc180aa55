"""Payload structure, log waves and filled series against plain Python."""

import json
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from fundpanel.operators import logs, macro, profile

PAYLOADS = [
    ("a", '{"a":1,"items":[{"id":"x","v":1.5},{"id":"y","subsection_id":"p","t":[1,null,"a[{"]}]}'), ("a", '{"a":null,"items":[]}'), ("a", '{"a":null,"items":[]}'), ("a", "[1,[2,[true]]]"), ("a", "bad{"), ("a", None), ("a", ""),
    ("b", '"x"'), ("b", '{"ratios":[{"name_tag":"pe","value":1},{"name_tag":"pe","value":2},{"as_of_date":0}],"q\\"}":{}}'), ("c", "{}"),
]


def kind(x):
    return "null" if x is None else {dict: "object", list: "list", str: "text", bool: "boolean", int: "integer", float: "number"}[type(x)]


def walk(x, path="$"):
    yield path, x
    if isinstance(x, dict):
        for k, v in x.items():
            yield from walk(v, f"{path}.{k}")
    elif isinstance(x, list):
        for v in x:
            yield from walk(v, f"{path}[]")


def walked():
    for by, text in PAYLOADS:
        try:
            yield by, list(walk(json.loads(text)))
        except (ValueError, TypeError):
            continue


def test_paths_items_and_shapes(spark):
    values, payloads, total, names, shapes = Counter(), Counter(), Counter(), Counter(), Counter()
    for by, nodes in walked():
        total[by] += 1
        values.update((by, p, kind(x)) for p, x in nodes)
        payloads.update({(by, p, kind(x)) for p, x in nodes})
        for p, x in nodes:
            if isinstance(x, dict):
                shapes[by, p, ",".join(sorted(x))] += 1
                if p.endswith("[]"):
                    first = next((f"{f}:{x[f]}" for f in profile.NAMES if x.get(f) is not None), None)
                    names[by, p, f"section:{x['id']}#{x['subsection_id']}" if x.get("subsection_id") and "id" in x else first] += 1
    found = profile.nodes(spark.createDataFrame([(*p, 1) for p in PAYLOADS], "url_prefix string, payload string, path int"))
    assert {(r.url_prefix, r.path, r.kind): (r.n_values, r.n_payloads, round(r.share, 9)) for r in profile.paths(found).collect()} == {k: (values[k], payloads[k], round(payloads[k] / total[k[0]], 9)) for k in values}
    items = profile.items(found).collect()
    assert {(r.url_prefix, r.path, r.identity): r.n for r in items} == dict(names)
    assert {r.path for r in items if r.metric} == {"$.ratios[]"}
    few = profile.shapes(found, samples=2).collect()
    assert {(r.url_prefix, r.path, r["shape"]): r.n for r in few} == dict(shapes)
    assert all(1 <= len(r.samples) <= 2 and len(set(r.samples)) == len(r.samples) and all(sorted(json.loads(s)) == [k for k in r["shape"].split(",") if k] for s in r.samples) for r in few)


def test_payloads_without_any(spark):
    empty = profile.nodes(spark.createDataFrame([], "url_prefix string, payload string"))
    bad = profile.nodes(spark.createDataFrame([("a", "{"), ("a", None)], "url_prefix string, payload string"))
    for rows in (empty, bad):
        assert profile.paths(rows).count() == profile.items(rows).count() == profile.shapes(rows).count() == 0
    deep = profile.paths(profile.nodes(spark.createDataFrame([("a", "[" * 12 + "7" + "]" * 12)], "url_prefix string, payload string")))
    assert deep.filter(F.col("path") == "$" + "[]" * 12).first().kind == "integer" and deep.count() == 13


MESSAGES = ("Landing for product {p}: changed=True", "Landing for product {p}: changed=False", "Failed to fetch holdings for product {p}: timeout", "Request to https://h/mf_ratios/{p} failed (status 429), attempt 1/5", "Request to https://h/x failed (status 503), attempt 1/5", "HTTP 429 hit. Pausing outbound requests for 7.5s (next backoff: 9.0s)", "HTTP 429 received within active wave", "Product {p}: incremental price update complete (12 bars)", "Landing fetch failed for product {p}: x", "nothing of note")


def log(rng, n, start):
    now, out = start, []
    for _ in range(n):
        now += timedelta(seconds=rng.choice((1, 20, 300, 4000)))
        out.append((f"{now:%Y-%m-%d %H:%M:%S},123 app.ingest.{rng.choice(('details', 'session', 'prices'))} INFO {rng.choice(MESSAGES).format(p=rng.randrange(6))}", rng.choice(("f", "g"))))
    return out


def waves_by_hand(lines, gap):
    times = defaultdict(list)
    for text, file in lines:
        if "429" in text:
            times[file].append((datetime.fromisoformat(text[:19]), "hit" in text))
    out = []
    for file, hits in times.items():
        for t, pause in sorted(hits):
            if not out or out[-1][0] != file or t >= out[-1][2] + gap:
                out.append([file, t, t, 0, 0, 0.0])
            out[-1][2:] = [t, out[-1][3] + 1, out[-1][4] + pause, out[-1][5] + 7.5 * pause]
    return sorted(map(tuple, out))


def test_waves_and_report(spark):
    lines = log(random.Random(1), 400, datetime(2024, 1, 1))
    lines += [("2024-01-01 00:00:00 app.ingest.prices INFO Product 1: incremental price update complete (3 bars)", "quiet"), ("", "f"), ("no line", "f")]
    events = logs.detail_events(logs.parse_lines(spark.createDataFrame(lines, "value string, file string")), {"mf_ratios": "ratios"})
    found = logs.waves(events, "10 minutes")
    want = waves_by_hand(lines, timedelta(minutes=10))
    assert sorted((r.file, r.start, r.end, r.n_hits, r.n_pauses, r.paused) for r in found.collect()) == want and len(want) > 20
    report = {r.file: r for r in logs.details_report(events, found).collect()}
    assert set(report) == {"f", "g"}  # a run without details events is left out
    for file, r in report.items():
        own = [t for t, f in lines if f == file and (".details " in t or ".session " in t)]
        products = {int(t.split("product ")[1].split(":")[0]) for t in own if " product " in t} | {int(t.split("Product ")[1].split(":")[0]) for t in own if "Product " in t}
        failed = {int(t.split("product ")[1].split(":")[0]) for t in own if "ailed" in t and " product " in t}
        assert (r.n_products, r.n_failed_products, r.n_checks, r.n_pauses, r.n_retries_429) == (len(products), len(failed), sum("changed=" in t for t in own), sum("hit" in t for t in own), sum("status 429" in t for t in own))
        assert r.n_waves == sum(w[0] == file for w in want) and r.paused == 7.5 * r.n_pauses
    bins = {(r.file, r.event, r.bin): r.n for r in logs.histograms(events, {"pause": 5.0, "bars": 10.0}).collect()}
    assert bins["f", "pause", 5.0] == sum("hit" in t for t, f in lines if f == "f") and bins["quiet", "bars", 0.0] == 1
    assert [(r.endpoint, r.n) for r in events.filter("event = 'retry'").groupBy("endpoint").agg(F.count("*").alias("n")).orderBy("endpoint").collect()] == [(None, sum("h/x" in t for t, _ in lines)), ("ratios", sum("mf_ratios" in t for t, _ in lines))]


def test_wave_stream_equals_batch(spark, tmp_path):
    lines = log(random.Random(3), 200, datetime(2024, 1, 1))
    end = [(f"2025-01-01 00:00:00 app.ingest.details INFO {MESSAGES[6]}", "f")]  # moves the watermark past all others
    for i in range(0, 200, 60):
        spark.createDataFrame(lines[i : i + 60], "value string, file string").coalesce(1).write.parquet(f"{tmp_path}/in/{i // 60}")
    spark.createDataFrame(end, "value string, file string").write.parquet(f"{tmp_path}/in/9")
    for cut in (1, 3):
        source = spark.readStream.schema("value string, file string").option("maxFilesPerTrigger", cut).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
        found = logs.waves(logs.detail_events(logs.parse_lines(source), {}), "10 minutes", late="30 days")
        out = f"{tmp_path}/out{cut}"
        found.writeStream.format("parquet").option("checkpointLocation", f"{out}-check").trigger(availableNow=True).start(out).awaitTermination()
        got = sorted((r.file, r.start, r.end, r.n_hits, r.n_pauses, r.paused) for r in spark.read.parquet(out).collect())
        assert got == waves_by_hand(lines, timedelta(minutes=10))


def akima(x, y, at):
    """The spline by its published steps, slopes padded by equal differences."""
    m = np.diff(y) / np.diff(x)
    m = np.r_[0, 0, m, 0, 0]
    if len(x) == 2:
        m[:] = m[2]
    else:
        m[1], m[-2] = 2 * m[2] - m[3], 2 * m[-3] - m[-4]
        m[0], m[-1] = 2 * m[1] - m[2], 2 * m[-2] - m[-3]
    i = min(int(np.searchsorted(x, at, side="right")) - 1, len(x) - 2)

    def slope(k):
        a, b = abs(m[k + 3] - m[k + 2]), abs(m[k + 1] - m[k])
        return (m[k + 1] + m[k + 2]) / 2 if a + b == 0 else (a * m[k + 1] + b * m[k + 2]) / (a + b)

    h, d = x[i + 1] - x[i], at - x[i]
    s0, s1 = slope(i), slope(i + 1)
    return y[i] + s0 * d + (3 * m[i + 2] - 2 * s0 - s1) / h * d**2 + (s0 + s1 - 2 * m[i + 2]) / h**2 * d**3


def test_interpolation_equals_brute_force(spark):
    rng, grid = random.Random(5), {}
    for c in range(30):
        for i in ("p", "q"):
            holes = rng.random()
            grid[i, f"c{c}"] = [None if rng.random() < holes else rng.choice((round(rng.uniform(-9, 9), 3), 4.0)) for _ in range(14)]
    filled = {}
    for key, values in grid.items():
        x = [2000 + k for k, v in enumerate(values) if v is not None]
        y = [v for v in values if v is not None]
        for k, v in enumerate(values):
            year, out = 2000 + k, v
            if v is None and x:
                if x[0] < year < x[-1]:
                    out = akima(np.array(x, float), np.array(y, float), float(year))
                else:
                    near = slice(0, 3) if year < x[0] else slice(-3, None)
                    out = y[0] if len(x) == 1 else float(np.polyval(np.polyfit(np.array(x[near], float) - year, y[near], 1), 0))
            filled[(*key, year)] = out
    for (i, c, year), v in list(filled.items()):
        if v is None:
            known = [w for (j, _, z), w in filled.items() if (j, z) == (i, year) and w is not None and grid[j, _] != [None] * 14]
            filled[i, c, year] = sum(known) / len(known)
    rows = [(c, i, 2000 + k, v, "x") for (i, c), values in grid.items() for k, v in enumerate(values)]
    got = macro.interpolate(spark.createDataFrame(rows, "country_code string, indicator_code string, year int, value double, knot string")).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"country_code", "indicator_code", "year", "value", "knot"}
    for r in got:
        assert abs(r.value - filled[r.indicator_code, r.country_code, r.year]) < 1e-6, r
