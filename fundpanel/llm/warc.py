"""WARC archives: writing captures of pages, reading archives, assembling transactions.

Archives are gzip files written by Spark's text sink: a row is one record, the sink's line
separator is the record separator of the format (two CRLF).  They are read back with
the binaryFile source and parsed record by record.  Pages are written by classes of size, each with so
many records a file that a file stays near FILE_BYTES, so a task never holds much more than that, or one page.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sparkops import Scratch, maybe_among, own_columns, shared_dir

CRLF = "\r\n"
#: Most records in an archive file, bytes of an archive file before it is packed, and the largest page of each class but the last.
RECORDS, FILE_BYTES, CLASSES = 3000, 1 << 28, (1 << 16, 1 << 20, 1 << 24)
#: Equal rows that are laid out together.
RUN = 1000
#: Payloads of fewer bytes are stored each time.
SMALLEST = 1000


def _record(fields: list[tuple[str, Column | str]], body: Column) -> Column:
    """A record without its closing separator; a null field is left out."""
    lines = [F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value) for name, value in fields]
    head = F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines, F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")))
    return F.concat(head, F.lit(CRLF * 2), body)


def _urn(kind: str, key: Column) -> Column:
    h = F.md5(F.concat(F.lit(kind), key))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _numbered(pages: DataFrame) -> DataFrame:
    """pages with keys of their own: of rows with equal keys all but one have a number behind it.

    Only rows whose page id stands twice are shuffled.  Equal rows are counted first, and laid out again in runs of RUN, so
    that any number of them is no single task's work.
    """
    repeated = pages.groupBy("page_id").agg(F.count("*").alias("n")).filter("n > 1").select("page_id")
    marked = maybe_among(pages.select("page_id", F.struct(*pages.columns).alias("row")), repeated, "page_id")
    counted = marked.filter("maybe").groupBy("row.key").agg(F.any_value("row").alias("row"), F.count("*").alias("n"))
    dealt = counted.select("key", "row", "n", F.explode(F.expr(f"sequence(0, (n - 1) div {RUN})")).alias("run")).repartition("key", "run")
    each = dealt.select("row", F.explode(F.expr(f"sequence(run * {RUN}, least(n - 1, run * {RUN} + {RUN - 1}))")).alias("i"))
    again = each.select("i", "row.*").withColumn("key", F.when(F.col("i") > 0, F.concat_ws("|", "key", "i")).otherwise(F.col("key"))).drop("i")
    return marked.filter("NOT maybe").select("row.*").unionByName(again)


def write_captures(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes a request, a response or revisit, and a metadata record for each page.

    Of pages with equal payloads of SMALLEST bytes or more, those with the largest id are responses,
    the others are revisits that refer to one of them.  Null pages and urls count as empty; a page without id is
    written as a response of its own.  Rows that repeat in id, url and page are numbered, and each has its own records.
    """
    pages = own_columns(pages, page_id=id_col, url=url_col, html=html_col).select(F.col("page_id").cast("long"), F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", " ").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumn("sha", F.sha2("html", 256)).withColumn("size", F.octet_length("html").cast("long"))
    pages = _numbered(pages.withColumn("key", F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.md5("url"), "sha")))
    keeper = F.max(F.struct("page_id", "key"))
    # copies are few against pages: only digests that repeat are joined back
    shared = pages.filter(F.col("size") >= SMALLEST).filter("page_id is not null").groupBy("sha").agg(keeper.alias("keeper"), F.count("*").alias("n")).filter("n > 1").select(F.col("sha").alias("shared_sha"), F.col("keeper.key").alias("keeper"), F.col("keeper.page_id").alias("keeper_id"))
    pages = pages.join(shared, (pages.sha == shared.shared_sha) & pages.page_id.isNotNull() & (pages["size"] >= SMALLEST), "left")
    revisit = F.col("keeper").isNotNull() & (F.col("keeper_id") != F.col("page_id"))
    digest = F.concat(F.lit("sha1:"), F.sha1("html"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(CRLF * 2))
    main_id, common = _urn("main", F.col("key")), [("WARC-Date", date), ("WARC-Target-URI", F.col("url"))]
    response = _record([("WARC-Type", "response"), ("WARC-Record-ID", main_id), *common, ("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response")], F.concat(http, F.col("html")))
    again = _record(
        [("WARC-Type", "revisit"), ("WARC-Record-ID", main_id), *common, ("WARC-Payload-Digest", digest), ("WARC-Refers-To", _urn("main", F.col("keeper"))), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Content-Type", "application/http; msgtype=response")],
        http,
    )
    request = _record([("WARC-Type", "request"), ("WARC-Record-ID", _urn("request", F.col("key"))), *common, ("WARC-Concurrent-To", main_id), ("Content-Type", "application/http; msgtype=request")], F.concat(F.lit("GET "), "url", F.lit(" HTTP/1.1\r\n\r\n")))
    meta = _record([("WARC-Type", "metadata"), ("WARC-Record-ID", _urn("metadata", F.col("key"))), *common, ("WARC-Concurrent-To", main_id), ("Content-Type", "application/warc-fields")], F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF)))
    bounds = (0, *(c + 1 for c in CLASSES))
    held = pages.agg(*(F.count_if(F.col("size") >= b).alias(f"from{i}") for i, b in enumerate(bounds))).first()
    for i, least in enumerate(bounds):
        own = pages.filter((F.col("size") >= least) & (F.col("size") <= CLASSES[i]) if i < len(CLASSES) else F.col("size") >= least)
        if not i or held[i] > (held[i + 1] if i < len(CLASSES) else 0):
            rows = own.select(F.explode(F.array(request, F.when(revisit, again).otherwise(response), meta)).alias("value"))
            records = min(RECORDS, 3 * max(1, FILE_BYTES // CLASSES[i])) if i < len(CLASSES) else 3
            rows.write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", records).text(f"{path}/class{i}")


def parse(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one archive, plain or gzip: header fields (names in lower case) and content."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(raw)) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw)
    stream = io.BufferedReader(stream, 1 << 20)
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a record doesn't begin with WARC/")
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields.get("content-length", "-1"))
        content = stream.read(size) if size >= 0 else b""
        if size < 0 or len(content) < size:
            raise ValueError("a record is cut short")
        yield fields, content


_FIELDS = {"record_id": "warc-record-id", "type": "warc-type", "uri": "warc-target-uri", "date": "warc-date", "concurrent_to": "warc-concurrent-to", "refers_to": "warc-refers-to", "declared_digest": "warc-payload-digest"}


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of all archives below path: its fields, the page id of metadata, payload size and digest, and by choice the payload.

    The payload is what follows the HTTP header, or the content of other records; its digest is recomputed.
    """
    names = [*_FIELDS, "page_id", "payload_bytes", "payload_digest", *["payload"] * payloads]
    kinds = {"page_id": ("long", pa.int64()), "payload_bytes": ("long", pa.int64()), "payload": ("binary", pa.binary())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                cols: dict[str, list] = {n: [] for n in names}
                for fields, content in parse(raw.as_py()):
                    for name, field in _FIELDS.items():
                        cols[name].append(fields.get(field))
                    page_id = None
                    if fields["warc-type"] == "metadata":
                        own = dict(x.split(": ", 1) for x in content.decode().splitlines() if ": " in x)
                        page_id = int(own["page-id"]) if own.get("page-id") else None
                    elif fields.get("content-type", "").startswith("application/http"):
                        content = content.partition(b"\r\n\r\n")[2]
                    cols["page_id"].append(page_id)
                    cols["payload_bytes"].append(len(content))
                    cols["payload_digest"].append(hashlib.sha1(content).hexdigest())
                    if payloads:
                        cols["payload"].append(content)
                yield pa.RecordBatch.from_arrays([pa.array(cols[n], kinds.get(n, ("", pa.string()))[1]) for n in names], names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, ", ".join(f"{n} {kinds.get(n, ('string',))[0]}" for n in names))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, uri, main, request, metadata, original.

    Requests and metadata are joined through their concurrent-to identifier, a revisit to the
    response that it refers to (null if the archives don't have it).  Missing parts are null; a record
    that stands twice counts once.
    """
    records = records.dropDuplicates(["record_id"])
    part = [c for c in records.columns if c != "record_id"]

    def side(kind: str, name: str) -> DataFrame:
        found = records.filter((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        return found.groupBy("concurrent_to").agg(F.min_by(F.struct("record_id", *part), "record_id").alias(name)).withColumnRenamed("concurrent_to", f"{name}_of")

    main = records.filter(F.col("type").isin("response", "revisit")).select("record_id", "uri", "refers_to", F.struct(*part).alias("main"))
    request, meta = side("request", "request"), side("metadata", "metadata")
    original = records.filter("type = 'response'").select(F.col("record_id").alias("original_id"), F.struct("record_id", *part).alias("original"))
    # only originals that are referred to go into the join of revisits
    referred = main.filter("refers_to is not null").select("refers_to").distinct()
    original = original.join(referred, original.original_id == referred.refers_to, "left_semi")
    out = main.join(request, main.record_id == request.request_of, "left").join(meta, main.record_id == meta.metadata_of, "left")
    return out.join(original, out.refers_to == original.original_id, "left").select("record_id", "uri", "main", "request", "metadata", "original")


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes pages as archives into the shared folder, reads them back and assembles the captures.

    Returns one row per input row: page_id, payload_bytes, payload_digest (SHA-1), record_type, refers_to.  Rows that repeat
    in id, url and page, and rows without id, are captures of their own; an empty table gives an empty result; other columns are ignored.
    """
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_captures(pages, path, id_col, url_col, html_col)
    # the archives are unpacked and parsed once; assembling reads their fields several times
    captures = assemble(Scratch(spark, "records").store(read_records(spark, path, payloads=False), "records"))
    # a revisit's payload is its original's: the page id of that comes by the metadata of the original
    owner = captures.filter("main.type = 'response'").select(F.col("record_id").alias("owner_record"), F.col("metadata.page_id").alias("refers_to"))
    wanted = captures.filter("original is not null").select(F.col("original.record_id").alias("w")).distinct()
    owner = owner.join(wanted, owner.owner_record == wanted.w, "left_semi")
    out = captures.join(owner, captures.original["record_id"] == owner.owner_record, "left")
    digest = F.when(F.col("main.type") == "revisit", F.col("original.payload_digest")).otherwise(F.col("main.payload_digest"))
    return out.select(
        F.col("metadata.page_id").alias("page_id"),
        F.when(F.col("main.type") == "revisit", F.col("original.payload_bytes")).otherwise(F.col("main.payload_bytes")).alias("payload_bytes"),
        F.when(F.concat(F.lit("sha1:"), digest) == F.col("main.declared_digest"), digest).alias("payload_digest"),
        F.col("main.type").alias("record_type"),
        "refers_to",
    )
