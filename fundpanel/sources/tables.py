"""Reading and writing of tables: fixed schemas, delimited files, log lines, rebuilt sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the stored tables.
SCHEMAS = {
    "payload_blobs": "hash string, payload string",
    "snapshots": "snapshot_id long, hash string, product_id long, url_prefix string, url_slug string, created_at timestamp, last_checked_at timestamp",
    "snapshot_previews": "product_id long, hash string, updated_at timestamp, last_checked_at timestamp",
    "prices": "product_id long, date date, open double, high double, low double, close double, volume double, average double, bar_count int, updated_at timestamp",
    "fx": "source_currency string, target_currency string, date date, open double, high double, low double, close double, updated_at timestamp",
    "themes": "theme_id string, num_id int, name string, parent_id string, created_at timestamp, updated_at timestamp, last_checked_at timestamp",
    "observations": "product_id long, family string, metric string, code string, effective_date date, date_source_depth int, fetched_at timestamp, value double, raw_value string",
    "processed_snapshots": "snapshot_id long, processed_at timestamp",
    "monthly_panel": "product_id long, as_of_date date, feature_id string, value double",
    "indicators": "country_code string, indicator_code string, year int, value double, source string, is_projection boolean",
}


def _pointer(spark: SparkSession, root: str, name: str):
    """The Hadoop path of a table's pointer, its file context, and the jvm."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}.current")
    return path, jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark.sparkContext._jsc.hadoopConfiguration()), jvm


def current(spark: SparkSession, root: str, name: str) -> str:
    """Where a table is: the version that its pointer names, else {name}.parquet."""
    path, files, _ = _pointer(spark, root, name)
    return spark.read.text(path.toString()).first().value if files.util().exists(path) else f"{root}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table by its fixed schema."""
    return spark.read.schema(SCHEMAS[name]).parquet(current(spark, root, name))


def read_delimited(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV file with a header, all text; only some columns if they are named."""
    df = spark.read.option("header", True).csv(path)
    return df.select(*columns) if columns else df


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file) of the lines that aren't blank."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).filter(F.trim("value") != "")


def with_json(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds v, the payload as a variant (null where it can't be read), and readable."""
    return rows.withColumn("v", F.expr(f"try_parse_json({payload})")).withColumn("readable", F.col("v").isNotNull())


def rebuild(df: DataFrame, root: str, name: str, partition_by: str | None = None) -> None:
    """Replaces a table: a new version is written beside the old one, then the pointer is swapped by one atomic rename.

    A crash at any time leaves the old version or the new one as the table.  The old version stays for those who still read it, until
    the rebuild after this one; versions before it go.
    """
    spark = df.sparkSession
    path, files, jvm = _pointer(spark, root, name)
    old, version = current(spark, root, name), f"{root}/{name}.versions/{uuid.uuid4().hex}"
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(version)
    fresh = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}.current.{uuid.uuid4().hex[:8]}")
    fs = fresh.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(fresh)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(fresh, path, overwrite)
    held = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}.versions")
    for f in fs.listStatus(held):
        if f.getPath().getName() not in (old.rsplit("/", 1)[-1], version.rsplit("/", 1)[-1]):
            fs.delete(f.getPath(), True)


def clear(spark: SparkSession, root: str, *names: str) -> None:
    """Rebuilds tables without rows."""
    for name in names:
        rebuild(spark.createDataFrame([], SCHEMAS[name]), root, name)


def reset_extraction(spark: SparkSession, root: str) -> None:
    """Forgets all that was extracted: the panel, then the watermarks, then the observations."""
    clear(spark, root, "monthly_panel", "processed_snapshots", "observations")


def write_delimited(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
