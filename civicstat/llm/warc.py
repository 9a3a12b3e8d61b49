"""WARC archives with revisits resolved.

Headers (record id, payload digest, length) are shuffled by digest, never payloads. Of the records
with equal payloads the one with the largest id stays a ``response``; the others become
``revisit`` records that name it and carry no payload. The archives are written by Spark's text
sink, one record a row, with the two line ends that close a WARC record as the line separator,
compressed by file, and read back whole-file by whole-file.

Defined results:

- null payload: empty payload;
- null id: sorts below all ids; written as ``<urn:page:null>``;
- repeated rows: records that share the largest id are all responses; an empty table writes no
  record and reads back none;
- payloads shorter than ``min_bytes`` are responses without looking for equals;
- only the named columns are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstat.llm.common import bounded_batches, scratch, stage

END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Date of the fresh headers, fixed so that a task that runs again writes the same bytes.
DATE = "2000-01-01T00:00:00Z"
#: Bytes of payload in an archive file, about.
FILE_BYTES = 32 << 20


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def headers(pages: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    """(id, digest, n_bytes) of each record."""
    bounded_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [x or b"" for x in b.column("payload").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(map(payload_digest, own), pa.string()), pa.array(map(len, own), pa.int64())], ["id", "digest", "n_bytes"])

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(payload_col).cast("string").alias("payload"))
    return rows.mapInArrow(run, "id long, digest string, n_bytes long")


def resolve(heads: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Headers with refers_to: the id of the response that a revisit repeats, null for responses.

    The largest id of a digest is a partial aggregate, so a payload that a third of all pages
    share sends one row a task; the join back is an inner join that Spark can split.
    """
    last = heads.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = heads.join(last.select("digest", "last"), "digest", "left")
    revisit = (F.col("n_bytes") >= min_bytes) & ~F.coalesce(F.col("id").eqNullSafe(F.col("last")), F.lit(True)) & F.col("last").isNotNull()
    return joined.select("id", "digest", "n_bytes", F.when(revisit, F.col("last")).alias("refers_to"))


def _record_id(c) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))


def records(pages: DataFrame, resolved: DataFrame, id_col: str, payload_col: str, url_col: str | None) -> DataFrame:
    """One text row for each record, without the separator that ends it.

    Revisits are few fields; the payload joins its verdict by id, which no hot payload skews.
    """
    url = F.col(url_col).cast("string") if url_col else F.lit(None).cast("string")
    own = pages.select(F.col(id_col).cast("long").alias("id"), url.alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    # rows that repeat an id are told apart by their payload's length and digest
    keyed = own.withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    verdict = resolved.select(F.col("id").alias("of"), "digest", "n_bytes", "refers_to").distinct().withColumn("hex", F.lower(F.hex(_from_base32("digest"))))
    joined = keyed.join(verdict, keyed["id"].eqNullSafe(verdict["of"]) & (keyed["sha"] == verdict["hex"]))
    line = "\r\n"
    clean = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{line}Content-Type: text/html; charset=utf-8{line}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(END))
    revisit = F.col("refers_to").isNotNull()
    length = F.when(revisit, F.lit(0).cast("long")).otherwise(F.octet_length(http).cast("long") + F.col("n_bytes"))
    head = F.concat(
        F.lit(f"WARC/1.1{line}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{line}WARC-Record-ID: "), _record_id(F.col("id")),
        F.lit(f"{line}WARC-Date: {DATE}{line}WARC-Target-URI: "), clean,
        F.lit(f"{line}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit(f"{line}X-Payload-Length: "), F.col("n_bytes").cast("string"),
        F.when(revisit, F.concat(F.lit(f"{line}WARC-Profile: {PROFILE}{line}WARC-Refers-To: "), _record_id(F.col("refers_to")))).otherwise(""),
        F.lit(f"{line}Content-Type: application/http; msgtype=response{line}Content-Length: "), length.cast("string"), F.lit(END))
    return joined.select(F.concat(head, F.when(revisit, "").otherwise(F.concat(http, F.col("payload")))).alias("value"))


def _from_base32(column: str) -> Column:
    """The 20 bytes of a base32 SHA-1, by its 32 digits in four groups of 40 bits."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    digits = "0123456789abcdefghijklmnopqrstuv"
    base32 = F.translate(F.col(column), alphabet, digits)
    return F.unhex(F.concat(*[F.lpad(F.conv(F.substring(base32, 8 * i + 1, 8), 32, 16), 10, "0") for i in range(4)]))


def write(pages: DataFrame, path: str, id_col: str, payload_col: str, url_col: str | None = None, min_bytes: int = 0) -> None:
    """Write the deduplicated archives as gzip files under ``path``."""
    resolved = stage(resolve(headers(pages, id_col, payload_col), min_bytes), "warc-headers")
    (records(pages, resolved, id_col, payload_col, url_col)
     .write.option("lineSep", END).option("compression", "gzip").text(path))


def _parse(content: bytes) -> Iterator[tuple[dict[str, str], int, int]]:
    """(headers, start, end) of each record's block in an archive."""
    at = 0
    while at < len(content):
        stop = content.index(END.encode(), at)
        lines = content[at:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        start = stop + len(END)
        end = start + int(head["Content-Length"])
        if content[end:end + 4] != END.encode():
            raise ValueError(f"the record at byte {at} doesn't end where its length says")
        yield head, start, end
        at = end + 4


def _of(urn: str | None) -> int | None:
    return None if urn is None or urn == "<urn:page:null>" else int(urn[10:-1])


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record: id, n_bytes, digest, record_type, refers_to, payload (null for revisits).

    The digest of a response is worked out from its payload and held against its header.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n_bytes", "digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        for b in batches:
            for packed in b.column("content"):
                content = gzip.GzipFile(fileobj=io.BytesIO(packed.as_py())).read()
                rows, size = [], 0
                for head, start, end in _parse(content):
                    payload, digest = None, head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "response":
                        payload = content[content.index(END.encode(), start) + 4:end]
                        if (found := payload_digest(payload)) != digest:
                            raise ValueError(f"{head['WARC-Record-ID']}: digest {digest}, payload {found}")
                        size += len(payload)
                    rows.append((_of(head["WARC-Record-ID"]), int(head["X-Payload-Length"]), digest, head["WARC-Type"], _of(head.get("WARC-Refers-To")), None if payload is None else payload.decode()))
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, "id long, n_bytes long, digest string, record_type string, refers_to long, payload string")


def archive(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url", min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write the archives of ``pages`` and read them back."""
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    write(pages, path, id_col, payload_col, url_col, min_bytes)
    return read(spark, path)
