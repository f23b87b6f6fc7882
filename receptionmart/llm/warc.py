"""Web archive files: writing records, reading them back, and assembling transactions.

Writing uses Spark's own text writer, which commits whole files and reaches any store: a record is one value, the record
separator is the line separator. Equal payloads are found on digests alone; then each page gets its request, its response
or revisit, and its metadata record, all named by identifiers that follow from the page and tied together by
concurrent-to fields. Reading takes whole files, which hold a bounded number of records, and cuts records by their
stated lengths while the file is unpacked, so payloads may contain anything and one batch of records is held at a time.

A transaction is what concurrent-to fields tie to one response or revisit, directly or over one other record, in either
direction. Records that lead nowhere come out as transactions without a response.

Defined cases: a null payload is empty; a null page id is written as an empty field and read back as null; a page row
that occurs several times is as many captures, and the first of them is the response; an empty table gives no files and
no captures.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

RECORDS_PER_FILE = 3000
# Records and bytes of their blocks that leave a file at a time when it is read.
BATCH_RECORDS, BATCH_BYTES = 500, 16 << 20
END = "\r\n"
RECORD = (
    "record_id string, record_type string, concurrent_to array<string>, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes bigint, page_id bigint, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: four times ten hexadecimal digits are eight base32 digits."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(kind: str, row: Column) -> Column:
    d = F.md5(F.concat_ws("/", F.lit(kind), row.cast("string")))
    parts = [F.substring(d, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: Column | str, record_id: Column, fields: dict[str, Column], block: Column) -> Column:
    """A record without its final separator. Fields that are null are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), record_id)]
    head += [F.concat(F.lit(f"{name}: "), value) for name, value in fields.items()]
    head.append(F.concat(F.lit("Content-Length: "), F.octet_length(block.cast("binary")).cast("string")))
    return F.concat(F.concat_ws(END, *head), F.lit(END + END), block)


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(row, refers_row, refers_to) of rows whose payload an earlier response holds. ``pages``: (row, page_id, payload)."""
    slim = pages.select("row", "page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("bytes"))
    slim = materialize(slim.filter(F.col("bytes") >= least_bytes))
    first = slim.groupBy("digest", "bytes").agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "row")).alias("first"), F.count("*").alias("n"))
    return (
        slim.join(first.filter("n > 1"), ["digest", "bytes"])
        .filter(F.col("row") != F.col("first.row"))
        .select("row", F.col("first.row").alias("refers_row"), F.col("first.page_id").alias("refers_to"))
    )


def with_file_rows(files: DataFrame, name: str = "_row") -> DataFrame:
    """``files``, read from Parquet, with a name for each row: its file and its place there, however files are split."""
    return files.withColumn(name, F.concat_ws("/", "_metadata.file_path", F.col("_metadata.row_index").cast("string")))


def write_archives(
    pages: DataFrame,
    folder: str,
    least_bytes: int = 0,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    row_col: str | None = None,
) -> None:
    """Writes a request, a response or revisit, and a metadata record for each row to new files in ``folder``.

    Rows are scanned twice, for their digests and for the files, and both scans must name them alike. ``row_col`` names a
    column that does so (see ``with_file_rows``); without one, rows are numbered and stored first.
    """
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.coalesce(F.regexp_replace(F.col(uri_col).cast("string"), r"[\r\n]", ""), F.lit("")).alias("uri"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("body"),
        row.alias("row"),
    )
    rows = rows if row_col else materialize(rows)
    again = revisits(rows.select("row", "page_id", F.col("body").cast("binary").alias("payload")), least_bytes)
    rows = rows.join(again, "row", "left")
    is_response = F.col("refers_row").isNull()
    main, request = _urn("response", F.col("row")), _urn("request", F.col("row"))
    length = F.octet_length(F.col("body").cast("binary")).cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), length, F.lit(END + END))
    common = {"WARC-Date": F.lit("2024-01-01T00:00:00Z"), "WARC-Target-URI": F.col("uri")}
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    response = _record(
        F.when(is_response, "response").otherwise("revisit"),
        main,
        common
        | {
            "WARC-Payload-Digest": F.concat(F.lit("sha1:"), base32_sha1(F.col("body").cast("binary"))),
            "WARC-Profile": F.when(~is_response, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            "WARC-Refers-To": F.when(~is_response, _urn("response", F.col("refers_row"))),
            "WARC-Concurrent-To": request,
            "Content-Type": F.lit("application/http; msgtype=response"),
        },
        F.concat(http, F.when(is_response, F.col("body")).otherwise("")),
    )
    asked = _record(
        "request",
        request,
        common | {"WARC-Concurrent-To": main, "Content-Type": F.lit("application/http; msgtype=request")},
        F.concat(F.lit("GET "), F.col("uri"), F.lit(f" HTTP/1.1{END}{END}")),
    )
    # Metadata names the request only, so it is reached over one other record.
    meta = _record(
        "metadata",
        _urn("metadata", F.col("row")),
        common | {"WARC-Concurrent-To": request, "Content-Type": F.lit("application/warc-fields")},
        F.concat(F.lit("page-id: "), page, F.lit(END)),
    )
    (
        rows.select(F.explode(F.array(asked, response, meta)).alias("value"))
        .write.option("lineSep", END + END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(folder)
    )


def parse_records(file: BinaryIO) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Fields, in lower case, and block of each record of a file; one record is held at a time."""
    while version := file.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"a record should start here: {version[:40]!r}")
        fields: dict[str, list[str]] = {}
        while line := file.readline().decode().rstrip(END):
            name, _, value = line.partition(":")
            fields.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(fields["content-length"][0])
        block = file.read(size)
        if len(block) < size:
            raise ValueError(f"{fields['warc-record-id'][0]}: the file ends within its block")
        yield fields, block
        file.read(4)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the files in ``folder`` with their payloads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                file: BinaryIO = io.BytesIO(content.as_py())
                rows, held = [], 0
                for fields, block in parse_records(io.BufferedReader(gzip.open(file), 1 << 20) if path.endswith(".gz") else file):
                    rows.append(_row(fields, block))
                    held += len(block)
                    if len(rows) >= BATCH_RECORDS or held >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").load(folder).filter("length > 0")
    return files.select("path", "content").mapInArrow(run, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [p.split()[0] for p in RECORD.split(", ")])


def _row(fields: dict[str, list[str]], block: bytes) -> tuple:
    kind = fields["warc-type"][0]
    digest = size = page = payload = None
    if kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        digest = fields["warc-payload-digest"][0].removeprefix("sha1:")
        if kind == "response":
            size = len(payload)
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if found != digest:
                raise ValueError(f"{fields['warc-record-id'][0]}: the payload doesn't have the stated digest")
        else:
            size, payload = int(re.search(rb"(?i)content-length: *(\d+)", head)[1]), None
    elif kind == "metadata":
        named = re.search(rb"page-id: *(-?\d+)", block)
        page = int(named[1]) if named else None
    return (
        fields["warc-record-id"][0],
        kind,
        fields.get("warc-concurrent-to", []),
        fields.get("warc-refers-to", [None])[0],
        fields.get("warc-target-uri", [None])[0],
        digest,
        size,
        page,
        payload,
    )


def assemble(records: DataFrame, hops: int = 2) -> DataFrame:
    """One nested row per capture: (capture_id, response, requests, metadata).

    ``records`` is read twice or more and should be stored. A record that reaches several captures is in each.
    """
    main = F.col("record_type").isin("response", "revisit")
    links = records.select("record_id", main.alias("main"), F.explode("concurrent_to").alias("other"))
    both = links.select("record_id", "other").union(links.select(F.col("other").alias("record_id"), F.col("record_id").alias("other"))).distinct()
    known = records.filter(main).select("record_id", F.col("record_id").alias("capture_id"))
    reached = known
    for _ in range(hops):
        step = reached.select(F.col("record_id").alias("other"), "capture_id").join(both, "other").select("record_id", "capture_id")
        # Captures don't lead to each other.
        step = step.join(known.select("record_id"), "record_id", "left_anti")
        reached = reached.union(step).distinct()
    columns = [c for c in records.columns if c != "concurrent_to"]
    tied = records.select(F.struct(*columns).alias("r"), F.col("record_id"), F.col("record_type")).join(reached, "record_id", "left")
    kind = F.col("record_type")
    return tied.groupBy(F.coalesce("capture_id", "record_id").alias("capture_id")).agg(
        F.max(F.when(kind.isin("response", "revisit"), F.col("r"))).alias("response"),
        F.array_sort(F.collect_list(F.when(kind == "request", F.col("r")))).alias("requests"),
        F.array_sort(F.collect_list(F.when(~kind.isin("response", "revisit", "request"), F.col("r")))).alias("metadata"),
    )


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that all executors share."""
    materialize(spark.range(1))  # names the folder where none is set
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
