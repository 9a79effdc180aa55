"""Session helpers of the text operators: stored intermediates, rows that go, and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rounds after which components() gives up; label propagation by stars needs about log2 of the longest chain.
MAX_ROUNDS = 60
#: Bits of the bitmap of maybe_among() for each key, and their least and largest number (the largest: 16 MB).
BITS_PER_KEY, FEWEST_BITS, MOST_BITS = 16, 1 << 18, 1 << 27
#: Spark removes the shuffle files of a finished SQL execution at once; a stored table doesn't need them any more.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local session gets a temporary folder; on a cluster executors wouldn't see one, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="fundpanel-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


class Scratch:
    """Stored intermediates of one run of an operator, each dropped when its last reader is done.

    A stored table is written compressed into the shared folder and read again: later jobs start from its
    files, so a lost executor costs no more than the tasks it ran.  What a returned, lazy result still reads stays.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}

    def store(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """by: a column with a folder per value, so that a filter on it reads only these."""
        path = self.paths[name] = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path, partitionBy=by)
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            if path := self.paths.pop(name, None):
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, name: str = "part", by: str | None = None) -> DataFrame:
    """Stores df and reads it again; the files stay."""
    return Scratch(df.sparkSession, name).store(df, name, by)


def own_columns(df: DataFrame, **named: str) -> DataFrame:
    """Only the columns an operator reads, under its own names, so that clashing extra columns can't disturb it."""
    return df.select(*(F.col(f"`{column}`").alias(alias) for alias, column in named.items()))


def row_key(id_col: str, text_col: str) -> Column:
    """A 64-bit name that only rows with equal id and text share."""
    return F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`"))


def maybe_among(rows: DataFrame, wanted: DataFrame, *key: str) -> DataFrame:
    """rows with the column maybe: false only where no row of wanted has the same key.

    A bitmap of the hashed keys is broadcast; its size follows the counted keys up to MOST_BITS.  It spares most
    rows without a partner the shuffle of a join; beyond that size it fills up, more rows pass, and the join decides alone.
    The rows must have no columns of the caller but inside a struct.
    """
    bits = min(max(FEWEST_BITS, 1 << (BITS_PER_KEY * wanted.count()).bit_length()), MOST_BITS)
    place = F.pmod(F.xxhash64(*key), F.lit(bits))
    bitmap = wanted.groupBy(F.floor(place / 32768).alias("_part")).agg(F.bitmap_construct_agg(place % 32768).alias("_bits"))
    rows = rows.withColumns({"_part": F.floor(place / 32768), "_bit": (place % 32768).cast("int")}).join(F.broadcast(bitmap), "_part", "left")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = rows.withColumns({"_byte": byte, "_bit": F.col("_bit") % 8})
    return rows.withColumn("maybe", F.expr("coalesce((_byte >> _bit) & 1 = 1, false)")).drop("_part", "_bits", "_byte", "_bit")


def in_struct(docs: DataFrame, **more: Column) -> DataFrame:
    """The caller's row as the struct `row`, beside columns of our own."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *(column.alias(name) for name, column in more.items()))


def without(docs: DataFrame, gone: DataFrame, key: Column) -> DataFrame:
    """The rows of docs, all columns, whose key isn't in gone (one column); rows that can't be in it aren't shuffled."""
    gone = materialize(gone.toDF("k").filter("k IS NOT NULL").distinct(), "gone")
    marked = maybe_among(in_struct(docs, k=key), gone, "k")
    kept = marked.filter("maybe").join(gone.hint("merge"), "k", "left_anti")
    return marked.filter("NOT maybe").unionByName(kept, allowMissingColumns=False).select("row.*")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of undirected edges (a, b); component is the smallest node reached.

    Alternates large-star and small-star steps.  A step groups by node with a map-side
    minimum and joins that minimum back; a hub's edges are never gathered in one row, and the join's
    large partitions are split.  Edges that are null, or join a node to itself, are ignored.
    """
    kind, scratch = edges.schema["a"].dataType, Scratch(edges.sparkSession, "components")
    now = scratch.store(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges0")
    for turn in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .filter("a <> b")
            .distinct()
        )
        after = scratch.store(small, f"edges{turn + 1}")
        changed = after.join(now, ["a", "b"], "left_anti").limit(1).count() or now.join(after, ["a", "b"], "left_anti").limit(1).count()
        scratch.drop(f"edges{turn}")
        now = after
        if not changed:
            nodes = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), "b"))
            return nodes.groupBy(F.col("a").alias("node")).agg(F.min("b").cast(kind).alias("component"))
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
