"""A reference shard is bounded by its words, and its round reads no other's automaton."""

import random

from pyspark.sql import functions as F

from fundpanel.llm import substrings


def test_short_passages_fill_shards_by_their_words(spark, monkeypatch):
    rng, window, texts = random.Random(8), 15, []
    word = lambda: f"w{rng.randrange(10**9)}"
    for _ in range(60):
        passage = [word() for _ in range(window)]  # one window
        texts += [[*(word() for _ in range(5)), *passage, *(word() for _ in range(5))] for _ in range(2)]
    sizes, build, stream, rounds = [], substrings.build_shards, substrings.stream, []

    def built(reference, *args):
        sizes.extend(r[1] for r in reference.groupBy("shard").agg(F.sum(F.size("places") * window)).collect())
        return build(reference, *args)

    def streamed(routed, automata, *args):
        plan = automata.filter("shard = 0")._jdf.queryExecution().executedPlan().toString()
        rounds.append("PartitionFilters: [isnotnull(shard" in plan)
        return stream(routed, automata, *args)

    monkeypatch.setattr(substrings, "SHARD", 200)
    monkeypatch.setattr(substrings, "build_shards", built)
    monkeypatch.setattr(substrings, "stream", streamed)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = substrings.dedup_substrings(df, window=window).collect()
    assert {(r.doc_id, r.n_removed) for r in got} == {(i, window * (i % 2)) for i in range(120)}
    assert sum(sizes) == 900 and max(sizes) < 450
    assert rounds == [True]


def test_words_of_places(spark):
    rows = [([4],), ([4, 5, 6],), ([0, 50, 51, 200],), ([0, 49],)]
    got = spark.createDataFrame(rows, "places array<int>").select(substrings.reference_words(F.col("places"), 50).alias("n")).collect()
    assert [r.n for r in got] == [50, 52, 151, 99]
