"""Bucketed tables, exactly-once extraction and change capture as a stream."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fundpanel.operators import capture, extract, keyed
from fundpanel.sources import store as store_module
from fundpanel.sources.staging import stage
from fundpanel.sources.store import Change, Conflict, Store
from fundpanel.streaming import jobs


def newest(stored, given):
    return keyed.upsert_newer(stored, given, ["id"], ["at"])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def files(root):
    return {str(p) for p in Path(root).rglob("*.parquet")}


def test_upserts_rewrite_only_touched_buckets(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    first = spark.range(500).select("id", F.lit(1).alias("at"), F.lit("old").alias("v"))
    assert store.commit(Change("t", first, ("id",), newest, buckets=16)) and rows(store.read("t")) == rows(first)
    before, parts = files(tmp_path), store.state()["tables"]["t"]["parts"]
    new = spark.createDataFrame([(3, 2, "new"), (4, 0, "late"), (1000, 1, "added")], "id long, at int, v string")
    store.commit(Change("t", new, ("id",), newest))
    got = {r.id: r.v for r in store.read("t").collect()}
    assert len(got) == 501 and got[3] == "new" and got[4] == "old" and got[1000] == "added"
    now = store.state()["tables"]["t"]["parts"]
    touched = {b for b in now if now[b] != parts.get(b)}
    assert 1 <= len(touched) <= 3 and len(now) == 16 and before < files(tmp_path)
    assert rows(store.read("t", number=1)) == rows(first)  # a reader of the last version goes on
    untouched = [int(b) for b in now if b not in touched]
    assert all(f"/{parts[str(b)]}/bucket={b}/" in r[0] for b in untouched for r in store.read("t", [b]).select("_metadata.file_path").distinct().collect())
    store.commit(Change("t", new.limit(0), ("id",), newest))
    store.clean(keep=1)
    assert len(store.read("t").collect()) == 501 and store.numbers() == [3]
    assert {str(p.parent.name) for p in Path(f"{tmp_path}/s/data/t").rglob("*.parquet")} == {f"bucket={b}" for b in range(16)} and len(before - files(tmp_path)) >= len(touched)
    assert len({p.parent for p in Path(f"{tmp_path}/s/data/t").rglob("*.parquet")}) == 16  # one version of each bucket is left


def test_a_change_is_dealt_once(spark, tmp_path, monkeypatch):
    seen, staged = [], []

    def spied(stored, given):
        merged = newest(stored, given)
        seen.append(merged._jdf.queryExecution().executedPlan().toString())
        return merged

    def keep(df, *more):
        staged.append(df)
        return stage(df, *more)

    monkeypatch.setattr(store_module, "stage", keep)
    store, root = Store(spark, str(tmp_path / "s")), f"{tmp_path}/s/data/t"
    first = spark.range(500).select("id", F.lit(1).alias("at"), F.lit("old").alias("v"))
    store.commit(Change("t", first.repartition(16, "id"), ("id",), spied, buckets=8, dealt=True))
    assert not staged and seen[-1].count("Exchange") == 1 and len(files(root)) == 16 and rows(store.read("t")) == rows(first)
    # stored and given rows are dealt, and nothing after that
    monkeypatch.setattr(store_module, "PART_ROWS", 30)
    new = first.filter("id % 3 = 0").withColumns({"at": F.lit(2), "v": F.lit("new")})
    before = files(root)
    store.commit(Change("t", new.repartition(16, "id"), ("id",), spied, dealt=True))
    assert len(staged) == 1 and seen[-1].count("Exchange") == 2 == seen[-1].count("Exchange hashpartitioning(id")
    assert rows(store.read("t")) == sorted((i, 1 + (i % 3 == 0), "old" if i % 3 else "new") for i in range(500))
    made = [Path(f) for f in files(root) - before]
    assert len(made) == 24 and len({f.parent for f in made}) == 8  # 667 rows in parts of 30: 24 tasks, three to a bucket
    store.commit(Change("u", first.limit(0).repartition(16, "id"), ("id",), newest, dealt=True))
    assert rows(store.read("u")) == []


def test_a_bucket_that_gets_empty(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    first = spark.range(100).select("id")
    store.commit(Change("t", first, ("id",), buckets=4))
    gone = store.read("t", [2])
    assert gone.count()
    want = rows(first.exceptAll(gone))
    store.commit(Change("t", gone, ("id",), lambda stored, given: stored.join(given, "id", "left_anti")))
    assert rows(store.read("t")) == want and set(store.state()["tables"]["t"]["parts"]) == {"0", "1", "3"}


def test_a_crash_leaves_the_state_before(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    a = spark.createDataFrame([(1, "a")], "id long, v string")
    store.commit(Change("t", a, ("id",)), Change("u", a, ("id",)))
    whole = Store._write

    def crash(self, change, stated):
        if change.table == "u":
            raise OSError("lost")
        return whole(self, change, stated)

    monkeypatch.setattr(Store, "_write", crash)
    with pytest.raises(OSError):
        store.commit(Change("t", a, ("id",)), Change("u", a, ("id",)))
    monkeypatch.undo()
    assert rows(store.read("t")) == rows(store.read("u")) == [(1, "a")] and store.numbers() == [1]
    store.commit(Change("t", a, ("id",)), Change("u", a, ("id",)))
    assert rows(store.read("t")) == rows(store.read("u")) == [(1, "a"), (1, "a")]
    held = store.state()
    store.commit(Change("t", a, ("id",)))
    with pytest.raises(Conflict):  # a writer that read before
        store._publish(held | {"number": held["number"] + 1})
    assert len(rows(store.read("t"))) == 3
    with pytest.raises(KeyError):
        store.read("none")


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    a = spark.createDataFrame([(1, "a")], "id long, v string")
    assert store.commit(Change("t", a, ("id",)), stream="x", batch=0) and not store.commit(Change("t", a, ("id",)), stream="x", batch=0)
    assert store.commit(Change("t", a, ("id",)), stream="y", batch=0) and store.commit(Change("t", a, ("id",)), stream="x", batch=1)
    assert len(rows(store.read("t"))) == 3 and store.state()["streams"] == {"x": 1, "y": 0}


def snapshots():
    """Snapshots of two endpoints; some have the same key at different depths, one is bad."""
    rng, out = random.Random(4), []
    for i in range(40):
        day = f"2024-0{1 + i % 3}-1{i % 5}"
        payload = {"as_of_date": day, "ratios": [{"name_tag": "Price/Book", "value": rng.randrange(99)}, {"name_tag": "No such ratio" if i == 7 else "Price/Earnings", "value": i}]}
        out.append((i, f"h{i}", i % 4, "/ratios" if i % 9 else "/landing", json.dumps(payload)))
    return out


ROUTES = {"/ratios": "ratios", "/landing": "landing"}


def extracted(spark, tmp_path, name, cuts, fail_at=()):
    """Runs the stream over the snapshots in parts; a failing part is run again by a new query from the same checkpoint."""
    every = snapshots()
    payloads = spark.createDataFrame([(h, p) for _, h, _, _, p in every], "hash string, payload string")
    contracts = spark.createDataFrame([(k, "USD") for k in range(4)], "product_id long, currency string")
    store, src = Store(spark, f"{tmp_path}/{name}"), f"{tmp_path}/{name}-in"
    schema = "snapshot_id long, hash string, product_id long, url_prefix string, created_at timestamp"
    publish, failing = Store._publish, set(fail_at)

    def flaky(self, state):
        if state["streams"].get("extract") in failing:
            failing.discard(state["streams"]["extract"])
            raise OSError("lost between the writes and the commit")
        publish(self, state)

    for n, part in enumerate(cuts):
        data = [(i, h, k, u) for i, h, k, u, _ in every[slice(*part)]]
        batch = spark.createDataFrame(data, "snapshot_id long, hash string, product_id long, url_prefix string").withColumn("created_at", F.timestamp_seconds(F.lit(1_715_000_000) + F.col("snapshot_id") * 60))
        batch.coalesce(1).write.parquet(f"{src}/{n}")
        for _ in range(2):
            with pytest.MonkeyPatch.context() as m:
                m.setattr(Store, "_publish", flaky)
                source = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(src)
                query = jobs.extract_stream(source, payloads, contracts, store, f"{tmp_path}/{name}-check", ROUTES, ["USD"])
                try:
                    query.awaitTermination()
                except Exception as e:
                    assert "lost between" in str(e)
                    continue
            break
    assert not failing
    return store


def test_extraction_is_exactly_once(spark, tmp_path):
    once = extracted(spark, tmp_path, "once", [(0, 40)])
    cut = extracted(spark, tmp_path, "cut", [(0, 11), (11, 12), (12, 40)], fail_at=(0, 2))
    for table, columns in (("observations", [*extract.KEY, "value", "date_source_depth", "snapshot_id"]), ("processed", ["snapshot_id"]), ("failures", ["snapshot_id", "error"])):
        assert rows(cut.read(table).select(*columns)) == rows(once.read(table).select(*columns)), table
    assert rows(once.read("failures").select("snapshot_id")) == [(7,)] and once.read("processed").count() == 39
    assert cut.state()["streams"] == {"extract": 2}
    # nothing is pending any more
    every = spark.createDataFrame([(i, h, k, u) for i, h, k, u, _ in snapshots()], "snapshot_id long, hash string, product_id long, url_prefix string")
    assert rows(extract.pending(every, cut.read("processed")).select("snapshot_id")) == [(7,)]


def fetches(n):
    rng = random.Random(8)
    return [(i, rng.randrange(3), rng.choice(("a", "b")), rng.choice(("x", "y", None)), 1_700_000_000 + 600 * i + rng.randrange(5)) for i in range(n)]


def test_changes_stream_equals_batch(spark, tmp_path):
    data, schema = fetches(150), "snapshot_id long, product_id long, url_prefix string, hash string, created_at timestamp"
    end = [(10_000 + 10 * p + k, p, u, "end", 1_900_000_000) for p in range(3) for k, u in enumerate("ab")]  # moves the watermark on

    def frame(part):
        return spark.createDataFrame(part, "snapshot_id long, product_id long, url_prefix string, hash string, s long").withColumn("created_at", F.timestamp_seconds("s")).drop("s")

    want = capture.changelog(frame(data)).select("product_id", "url_prefix", "hash", "snapshot_id", "created_at", "last_checked_at")
    want = sorted((tuple(r) for r in want.collect()), key=repr)
    for name, size in (("small", 15), ("large", 60)):
        rng = random.Random(size)
        mixed = sorted(data, key=lambda x: x[4] + rng.randrange(7000))  # late by up to two hours
        parts = [mixed[i : i + size] for i in range(0, len(mixed), size)] + [end]
        for n, part in enumerate(parts):
            frame(part).coalesce(1).write.parquet(f"{tmp_path}/{name}/{n:03}")
            if n in (1, len(parts) - 2, len(parts) - 1):  # each query starts anew from the checkpoint
                source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/{name}")
                jobs.changes_stream(source, f"{tmp_path}/{name}-out", f"{tmp_path}/{name}-check", late="3 hours").awaitTermination()
        got = jobs.read_changes(spark.read.parquet(f"{tmp_path}/{name}-out")).filter("hash IS NULL OR hash <> 'end'")
        assert sorted((tuple(r) for r in got.select(*(c.split()[0] for c in jobs.CHANGES.split(", "))).collect()), key=repr) == want
