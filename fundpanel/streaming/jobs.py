"""Streaming twins of incremental jobs: exactly-once extraction, change capture by keyed state, windowed counts."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import extract, logs
from ..operators.keyed import insert_absent
from ..sources.store import Change, Store


def extract_batch(store: Store, snapshots: DataFrame, payloads: DataFrame, contracts: DataFrame, routes: Mapping[str, str], known: Sequence[str], stream: str | None = None, number: int | None = None) -> bool:
    """Extracts the snapshots that have no watermark in the store and merges their observations: rows, watermarks and failures are one commit.

    Observations of one key keep the deeper date, then the later fetch.  A batch of a stream that has been committed changes nothing (False).
    """
    spark, stated = snapshots.sparkSession, store.state()
    if stream is not None and number <= stated["streams"].get(stream, -1):
        return False
    done_before = store.read("processed") if "processed" in stated["tables"] else spark.createDataFrame([], "snapshot_id long")
    good, failed, done = extract.run(snapshots, payloads, contracts, done_before, routes, known)
    return store.commit(
        Change("observations", good, ("product_id",), extract.merge_observations),
        Change("processed", done.select("snapshot_id"), ("snapshot_id",), lambda stored, new: stored.unionByName(insert_absent(stored, new, ["snapshot_id"]))),
        Change("failures", failed.select("snapshot_id", "error"), ("snapshot_id",), lambda stored, new: stored.unionByName(insert_absent(stored, new, ["snapshot_id"]))),
        stream=stream,
        batch=number,
    )


def extract_stream(source: DataFrame, payloads: DataFrame, contracts: DataFrame, store: Store, checkpoint: str, routes: Mapping[str, str], known: Sequence[str], name: str = "extract") -> StreamingQuery:
    """Extracts every micro-batch of snapshots into the store, each exactly once: its number is part of the commit."""

    def batch(rows: DataFrame, number: int) -> None:
        extract_batch(store, rows, payloads, contracts, routes, known, name, number)

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: State of a key: the run that is open, and the fetches that the watermark hasn't passed yet, as JSON.
_STATE = "open string, waiting string"
CHANGES = "product_id long, url_prefix string, hash string, snapshot_id long, created_at timestamp, last_checked_at timestamp"


def _changes(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Fetches of one key in the order of time: those up to the watermark are settled, later ones wait for a timer.

    A run of equal hashes comes out when it begins and again whenever a later fetch confirms it.
    """
    run, waiting = (json.loads(x) for x in state.get) if state.exists else (None, [])
    if not state.hasTimedOut:
        for frame in frames:
            micros = frame["created_at"].astype("datetime64[us]").astype("int64")
            waiting += [[int(t), int(s), None if pd.isna(h) else str(h)] for t, s, h in zip(micros, frame["snapshot_id"], frame["hash"], strict=True)]
    waiting.sort(key=lambda x: x[:2])
    limit, out = state.getCurrentWatermarkMs() * 1000, []
    while waiting and waiting[0][0] <= limit:
        at, snapshot, digest = waiting.pop(0)
        if run is None or run[2] != digest:
            run = [at, snapshot, digest]
        if out and out[-1][3] == run[1]:
            out[-1][5] = at
        else:
            out.append([*key, run[2], run[1], run[0], at])
    state.update((json.dumps(run), json.dumps(waiting)))
    if waiting:
        state.setTimeoutTimestamp(max(waiting[0][0] // 1000 + 1, state.getCurrentWatermarkMs() + 1))
    found = pd.DataFrame(out, columns=["product_id", "url_prefix", "hash", "snapshot_id", "created_at", "last_checked_at"])
    for c in ("created_at", "last_checked_at"):
        found[c] = pd.to_datetime(found[c], unit="us")
    yield found.astype({"product_id": "int64", "snapshot_id": "int64"})


def changes(fetches: DataFrame, late: str = "1 day") -> DataFrame:
    """On a stream, the versions of each payload as keyed state sees them; rows as of read_changes, several of one run.

    The state of a key is its last hash and the fetches within the lateness: fetches may come in any order within it,
    later ones are dropped by the watermark.  What the watermark hasn't reached waits.
    """
    rows = fetches.select("product_id", "url_prefix", "hash", "snapshot_id", "created_at").withWatermark("created_at", late)
    return rows.groupBy("product_id", "url_prefix").applyInPandasWithState(_changes, CHANGES, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def changes_stream(source: DataFrame, out: str, checkpoint: str, late: str = "1 day") -> StreamingQuery:
    """Writes what changes() says into a folder per batch; a repeated batch overwrites its own."""

    def batch(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return changes(source, late).writeStream.foreachBatch(batch).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_changes(written: DataFrame) -> DataFrame:
    """One row per run of equal hashes, as the batch function changelog gives it: of its rows the last confirmation counts."""
    return written.groupBy("product_id", "url_prefix", "hash", "snapshot_id", "created_at").agg(F.max("last_checked_at").alias("last_checked_at"))


def log_counts(lines: DataFrame, minutes: int = 5, late: str = "10 minutes") -> DataFrame:
    """Events of log lines per window of event time; works on a stream (with a watermark) and on a table."""
    rows = logs.classify(logs.parse_lines(lines))
    if lines.isStreaming:
        rows = rows.withWatermark("ts", late)
    return rows.groupBy(F.window("ts", f"{minutes} minutes").alias("w"), "event").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event", "n")
