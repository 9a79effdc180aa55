"""Keyed tables in buckets, changed together by numbered commits.

A store is a folder.  `data/<table>/<version>/bucket=<n>` holds the rows whose hashed key falls into a bucket, and
`log/<number>.json` says which version of each bucket of each table counts after a commit.  A change rewrites only the
buckets that its rows fall into; the commit that names them is one rename that fails if the number is taken.  So a reader
sees all tables of a commit or none, a crash leaves the state before, and of two writers one is told to try again.

A commit can carry the number of a stream's batch: a batch that comes again changes nothing.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import stage

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class Conflict(RuntimeError):
    """Another writer has committed since this one read the store."""


@dataclass(frozen=True)
class Change:
    """Rows for a table: merge makes the new rows of the touched buckets from the stored and the given ones; without it they are added.

    bucket_by: the columns whose hash deals rows to buckets, part of the key by which merge matches.  The first change of a table fixes them, the number of
    buckets and the columns.  merge gets both sides dealt by them; groups, windows and joins by the key need no other exchange.

    dealt: the rows are dealt by bucket_by into a multiple of the buckets already: as the first rows of a table they are neither staged nor dealt again, and a
    merge that reads them twice makes them twice.
    """

    table: str
    rows: DataFrame
    bucket_by: tuple[str, ...]
    merge: Merge | None = None
    buckets: int = 64
    dealt: bool = False


#: Rows that a task merges: more rows are dealt into more parts.
PART_ROWS = 250_000


class Store:
    """Tables under one folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path, fs = self._path(folder)
        return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []

    def numbers(self) -> list[int]:
        """The commits that are there, the last one last."""
        return sorted(int(n[:-5]) for n in self._names("log") if n.endswith(".json") and n[:-5].isdigit())

    def state(self, number: int | None = None) -> dict:
        """What a commit says, by default the last: number, tables, streams."""
        known = self.numbers()
        if not known:
            return {"number": 0, "tables": {}, "streams": {}}
        return json.loads(self.spark.read.text(f"{self.root}/log/{number or known[-1]}.json", wholetext=True).first().value)

    def read(self, table: str, buckets: Sequence[int] | None = None, number: int | None = None) -> DataFrame:
        """A table as of a commit, all of it or some buckets."""
        stated = self.state(number)["tables"].get(table)
        if stated is None:
            raise KeyError(f"the store has no table {table}")
        return self._read(table, stated, buckets)

    def _read(self, table: str, stated: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        found = [f"{self.root}/data/{table}/{version}/bucket={b}" for b, version in stated["parts"].items() if buckets is None or int(b) in buckets]
        if not found:
            return self.spark.createDataFrame([], stated["schema"])
        return self.spark.read.schema(stated["schema"]).parquet(*found)

    def commit(self, *changes: Change, stream: str | None = None, batch: int | None = None) -> bool:
        """Makes all changes, or none; False if the stream's batch has been committed before."""
        state = self.state()
        if stream is not None and batch <= state["streams"].get(stream, -1):
            return False
        tables = dict(state["tables"])
        for change in changes:
            tables[change.table] = self._write(change, tables.get(change.table))
        streams = state["streams"] | ({stream: batch} if stream is not None else {})
        self._publish({"number": state["number"] + 1, "tables": tables, "streams": streams})
        return True

    def _write(self, change: Change, stated: dict | None) -> dict:
        """Writes the touched buckets of a table as a version of their own; returns what the commit says of it."""
        if stated is None:
            stated = {"bucket_by": list(change.bucket_by), "buckets": change.buckets, "schema": ", ".join(f"`{n}` {kind}" for n, kind in change.rows.dtypes), "parts": {}}
        by, n, parts = stated["bucket_by"], stated["buckets"], stated["parts"]
        bucket = F.pmod(F.hash(*by), F.lit(n))
        if change.dealt and not parts:
            touched, given = [], change.rows
            stored = given.limit(0)
        else:
            given = stage(change.rows.withColumn("bucket", bucket))
            counts = {r["bucket"]: r["count"] for r in given.groupBy("bucket").count().collect()}  # as many as buckets at most
            if not counts:
                return stated
            touched = sorted(counts)
            stored = self._read(change.table, stated, touched)
            # by the hash that tells a row's bucket, into a multiple or a divisor of the buckets: a task has rows of one bucket, or all of some
            least = math.ceil((stored.count() + sum(counts.values())) / PART_ROWS)
            tasks = n * math.ceil(least / n) if least > n else next(t for t in range(least, n + 1) if n % t == 0)
            stored, given = stored.repartition(tasks, *by), given.drop("bucket").repartition(tasks, *by)
        rows = change.merge(stored, given) if change.merge else stored.unionByName(given)
        version = f"{change.table}/{uuid.uuid4().hex}"
        rows.withColumn("bucket", bucket).write.partitionBy("bucket").parquet(f"{self.root}/data/{version}")
        written = [x.removeprefix("bucket=") for x in self._names(f"data/{version}") if x.startswith("bucket=")]
        left = {b: v for b, v in parts.items() if int(b) not in touched}
        return stated | {"parts": left | dict.fromkeys(written, version.split("/")[1])}

    def _publish(self, state: dict) -> None:
        """The commit itself: a rename that fails where the number is taken."""
        jvm = self.spark.sparkContext._jvm
        fresh, fs = self._path(f"log/.{uuid.uuid4().hex}")
        out = fs.create(fresh)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        path, _ = self._path(f"log/{state['number']}.json")
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            files.rename(fresh, path, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as e:
            fs.delete(fresh, False)
            if "FileAlreadyExistsException" in str(e) or isinstance(e, PySparkException):
                raise Conflict(f"commit {state['number']} is taken") from e
            raise

    def clean(self, keep: int = 2) -> None:
        """Deletes what none of the last `keep` commits names: old versions, and those of writers that crashed.  Run it when nothing is being written."""
        numbers = self.numbers()
        named = {f"{t}/{v}/bucket={b}" for n in numbers[-keep:] for t, stated in self.state(n)["tables"].items() for b, v in stated["parts"].items()}
        for version in (f"{t}/{v}" for t in self._names("data") for v in self._names(f"data/{t}")):
            held = [f"{version}/{b}" for b in self._names(f"data/{version}")]
            gone = [b for b in held if b not in named]
            for b in gone if set(held) & named else [version]:
                path, fs = self._path(f"data/{b}")
                fs.delete(path, True)
        for number in numbers[:-keep]:
            path, fs = self._path(f"log/{number}.json")
            fs.delete(path, False)
