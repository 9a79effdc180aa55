"""Log lines and payload shapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines `yyyy-MM-dd HH:mm:ss logger level message` that aren't blank: ts, logger, level, message."""
    v = F.col("value")
    pattern = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\S*\s+(\S+)\s+(\S+)\s+(.*)$"
    part = lambda i: F.regexp_extract(v, pattern, i)
    rest = [c for c in lines.columns if c != "value"]
    return lines.filter(F.trim(v) != "").select(*rest, F.try_to_timestamp(part(1), F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"), part(2).alias("logger"), part(3).alias("level"), part(4).alias("message"))


def endpoint_of(url: Column, rules: Mapping[str, str]) -> Column:
    """The endpoint of the first rule (substring -> endpoint) that a URL meets."""
    out = F.lit(None).cast("string")
    for text, name in reversed(list(rules.items())):
        out = F.when(url.contains(text), name).otherwise(out)
    return out


def classify(rows: DataFrame) -> DataFrame:
    """Adds phase (the logger's last part), event and number (the first number of the message)."""
    m = F.lower("message")
    event = F.when(m.contains("429"), "rate_limited").when(m.contains("fail") | m.contains("error"), "failure").when(m.contains("pause"), "pause").when(m.contains("delay"), "delay").when(m.contains("bars"), "bars").when(m.contains("unchanged"), "gate_closed").when(m.contains("changed"), "gate_open").otherwise("other")
    number = F.regexp_extract("message", r"(\d+(?:\.\d+)?)", 1).try_cast("double")
    return rows.withColumns({"phase": F.element_at(F.split("logger", r"\."), -1), "event": event, "number": number})


def run_statistics(events: DataFrame, by: str = "file") -> DataFrame:
    """Per run: span, events, failures, gates, rate limits, pauses."""
    is_ = lambda e: F.col("event") == e
    return events.groupBy(by).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("n_lines"), F.count_if(is_("failure")).alias("n_failures"), F.count_if(is_("gate_open")).alias("n_open"), F.count_if(is_("gate_closed")).alias("n_closed"),
        F.count_if(is_("rate_limited")).alias("n_limited"), F.coalesce(F.sum(F.when(is_("pause"), F.col("number"))), F.lit(0.0)).alias("pause_sum"), F.max(F.when(is_("pause"), F.col("number"))).alias("pause_max"),
    )


def histogram(events: DataFrame, event: str, width: float, by: str = "file") -> DataFrame:
    """Counts of an event's numbers in bins of a width."""
    return events.filter(F.col("event") == event).groupBy(by, (F.floor(F.col("number") / width) * width).alias("bin")).agg(F.count("*").alias("n"))


def payload_profile(payloads: DataFrame, by: str = "url_prefix", text: str = "payload") -> DataFrame:
    """(by, key, kind, n, share): top-level fields of JSON objects, their kinds and in what share of payloads they stand."""
    rows = payloads.withColumn("v", F.expr(f"try_parse_json({text})")).filter("v IS NOT NULL")
    total = rows.groupBy(by).agg(F.count("*").alias("total"))
    fields = rows.select(by, F.expr("explode(map_entries(cast(v as map<string, variant>)))").alias("e")).select(by, F.col("e.key").alias("key"), F.expr("schema_of_variant(e.value)").alias("kind"))
    return fields.groupBy(by, "key", "kind").agg(F.count("*").alias("n")).join(total, by).select(by, "key", "kind", "n", (F.col("n") / F.col("total")).alias("share"))


#: The phrases that are counted, and what is read from their lines.
PHRASES = {
    "Landing for product": "gate",
    "Landing fetch failed": "gate_failed",
    "gated endpoint": "unsatisfied",
    "Failed to fetch": "endpoint_failed",
    "Request to": "retry",
    "HTTP 429 hit": "pause",
    "HTTP 429 received within active wave": "suppressed",
    "incremental price update complete": "bars",
}
FIELDS = {
    "product": r"[Pp]roduct (\d+):",
    "failed": r"Failed to fetch (\w+)",
    "url": r"Request to (\S+)",
    "status": r"\(status (\d+)\)",
    "changed": r"changed=(\w+)",
    "number": r"(?:requests for |complete \()([\d.]+)(?:s| bars)",
}
#: Loggers of the details phase.
DETAIL_LOGGERS = ("details", "landing", "snapshots", "session")


def detail_events(rows: DataFrame, endpoints: Mapping[str, str]) -> DataFrame:
    """Parsed lines that say something about products or limits: event, details (the phase), product_id, endpoint, changed, number (seconds or bars), limited.

    endpoints: substring of a URL -> endpoint.  A retry counts as limited if its status is 429; so does a pause, and a suppressed one.
    Works on tables and on streams.
    """
    read = lambda name: F.nullif(F.regexp_extract("message", FIELDS[name], 1), F.lit(""))
    phrase = F.regexp_extract("message", "(" + "|".join(PHRASES) + ")", 1)
    events = F.create_map(*(F.lit(x) for pair in PHRASES.items() for x in pair))
    known = rows.withColumn("event", F.element_at(events, phrase)).filter("event IS NOT NULL")
    return known.withColumns({
        "details": F.element_at(F.split("logger", r"\."), -1).isin(*DETAIL_LOGGERS),
        "product_id": read("product").cast("long"),
        "endpoint": F.coalesce(read("failed"), endpoint_of(read("url"), endpoints)),
        "changed": read("changed") == "True",
        "number": read("number").cast("double"),
        "limited": F.col("event").isin("pause", "suppressed") | F.coalesce(read("status") == "429", F.lit(False)),
    })


def waves(events: DataFrame, gap: str = "2 hours", by: str = "file", late: str = "1 hour") -> DataFrame:
    """(by, start, end, n_hits, n_pauses, paused): waves of rate limits, each hit less than a gap after the one before.

    Sessions of event time: they are merged inside tasks first, so a long run isn't one task's work.  end is the last hit.
    On a stream a wave comes out when the watermark has passed it.
    """
    hits = events.filter("limited")
    if hits.isStreaming:
        hits = hits.withWatermark("ts", late)
    pause = F.col("event") == "pause"
    found = hits.groupBy(by, F.session_window("ts", gap).alias("w")).agg(F.max("ts").alias("end"), F.count("*").alias("n_hits"), F.count_if(pause).alias("n_pauses"), F.coalesce(F.sum(F.when(pause, F.col("number"))), F.lit(0.0)).alias("paused"))
    return found.select(by, F.col("w.start").alias("start"), "end", "n_hits", "n_pauses", "paused")


def histograms(events: DataFrame, widths: Mapping[str, float], by: str = "file") -> DataFrame:
    """(by, event, bin, n): counts of the numbers of each event in bins of its width."""
    width = F.coalesce(*(F.when(F.col("event") == e, F.lit(w)) for e, w in widths.items()))
    rows = events.filter(F.col("event").isin(*widths) & F.col("number").isNotNull())
    return rows.groupBy(by, "event", (F.floor(F.col("number") / width) * width).alias("bin")).agg(F.count("*").alias("n"))


def details_report(events: DataFrame, found_waves: DataFrame, by: str = "file") -> DataFrame:
    """One row per run that has details events; runs without any are left out.

    minutes between its first and last details line, distinct and failed products, gate checks and results, waves and the
    longest one's minutes, seconds paused, retries after 429, endpoint failures.  Counted per run and product first.
    """
    one = lambda *names: F.col("event").isin(*names)
    counts: Sequence[tuple[str, Column]] = (
        ("n_checks", one("gate")), ("n_changed", one("gate") & F.col("changed")), ("n_unchanged", one("gate") & ~F.col("changed")), ("n_unsatisfied", one("unsatisfied")),
        ("n_pauses", one("pause")), ("n_suppressed", one("suppressed")), ("n_retries_429", one("retry") & F.col("limited")), ("n_endpoint_failures", one("endpoint_failed")),
    )
    rows = events.filter("details")
    per_product = rows.groupBy(by, "product_id").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.coalesce(F.sum(F.when(one("pause"), F.col("number"))), F.lit(0.0)).alias("paused"),
        F.max(F.when(one("pause"), F.col("number"))).alias("longest_pause"), F.bool_or(one("gate_failed", "endpoint_failed")).alias("failed"), *(F.count_if(c).alias(n) for n, c in counts),
    )
    report = per_product.groupBy(by).agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.count("product_id").alias("n_products"), F.count_if(F.col("failed") & F.col("product_id").isNotNull()).alias("n_failed_products"),
        F.sum("paused").alias("paused"), F.max("longest_pause").alias("longest_pause"), *(F.sum(n).alias(n) for n, _ in counts),
    )
    seconds = F.unix_seconds("end") - F.unix_seconds("start")
    of_waves = found_waves.groupBy(by).agg(F.count("*").alias("n_waves"), (F.max(seconds) / 60).alias("longest_wave"))
    report = report.join(of_waves, by, "left").fillna(0, ["n_waves"]).withColumn("minutes", (F.unix_seconds("last_ts") - F.unix_seconds("first_ts")) / 60)
    return report.filter("n_products > 0 OR n_checks > 0 OR n_pauses > 0 OR n_retries_429 > 0")
