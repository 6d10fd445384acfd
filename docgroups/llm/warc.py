"""WARC archives with revisit records for payloads that repeat.

A record is its header, an empty line, its block, and two line ends. Two line ends are also the line
separator under which Spark's text writer and reader see an archive, so archives are written and read by
tasks that commit and retry like any other. Files are compressed whole, so a reader has a file from its start.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgroups.session import cut

END = "\r\n\r\n"
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id string, record_type string, uri string, payload_digest string, refers_to string, block string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def headers(pages: DataFrame) -> DataFrame:
    """The rows of ``(page_id, url, html)`` with ``payload_bytes`` and ``payload_digest`` (bare upper-case base32 SHA-1) of the UTF-8 html.

    A null html is an empty payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = [(x or "").encode() for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(x) for x in payloads], pa.int64()), pa.array([payload_digest(x) for x in payloads], pa.string())],
                [*batch.schema.names, "payload_bytes", "payload_digest"],
            )

    plain = pages.select("page_id", "url", "html")
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    return plain.mapInArrow(run, f"{shape}, payload_bytes long, payload_digest string")


def resolve(rows: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``(row, record_type, refers_to)`` of ``(row, page_id, payload_bytes, payload_digest)``.

    Of the rows with one payload of at least ``least_bytes`` that with the largest page_id is the response, of
    equal page_ids the one with the largest row number; the others are revisits that refer to its page_id. A null page_id comes last. Payloads are
    equal if their digests and sizes are. Only these headers are shuffled; the best row of a payload is combined before
    its shuffle.
    """
    same = ["payload_digest", "payload_bytes"]
    large = rows.where(F.col("payload_bytes") >= least_bytes)
    best = large.groupBy(*same).agg(F.max(F.struct("page_id", "row")).alias("best"))
    joined = large.join(best, same).select("row", F.col("best.row").alias("winner"), F.col("best.page_id").alias("winner_id"))
    first = F.col("row") == F.col("winner")
    return joined.select(
        "row", F.when(first, "response").otherwise("revisit").alias("record_type"),
        F.when(~first, F.col("winner_id")).alias("refers_to"),
    )


def write(records: DataFrame, path: str) -> None:
    """Archives of ``(page_id, record_type, uri, payload_digest, refers_to, block)`` below ``path``, one for each task.

    Headers are made anew. ``block`` is a response's payload; a revisit has none. Line ends in an id or address are
    percent-encoded, as a header line can't hold them.
    """

    def clean(value):
        return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    def line(name: str, value):
        return F.when(value.isNotNull(), F.concat(F.lit(f"\r\n{name}: "), value)).otherwise(F.lit(""))

    block = F.when(F.col("record_type") == "response", F.coalesce("block", F.lit(""))).otherwise(F.lit(""))
    revisit = F.col("record_type") == "revisit"
    header = F.concat(
        F.lit(VERSION), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), clean(F.col("page_id").cast("string")), F.lit(">"))),
        line("WARC-Date", F.date_format(F.lit("1970-01-01").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", clean(F.col("uri"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Profile", F.when(revisit, F.lit(REVISIT))),
        line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), clean(F.col("refers_to").cast("string")), F.lit(">")))),
        line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", F.octet_length(block).cast("string")),
    )
    records.select(F.concat(header, F.lit(END), block).alias("value")).write.text(path, compression="gzip", lineSep=END)


def parse(chunks: Iterator[str]) -> Iterator[tuple]:
    """Records of an archive that comes in parts between the separators; memory holds one record."""
    end = END.encode()
    buffer, need, fields = bytearray(), None, {}  # grows in place: a record of very many parts takes linear time
    for chunk in chunks:
        buffer += chunk.encode()
        buffer += end
        while True:
            if need is None:
                at = buffer.find(end)
                if at < 0:
                    break
                lines = buffer[:at].decode().split("\r\n")
                fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
                need = int(fields["Content-Length"])
                del buffer[:at + len(end)]
            if len(buffer) < need + len(end):
                break
            block = buffer[:need].decode()
            del buffer[:need + len(end)]
            need = None
            yield (
                _bare(fields.get("WARC-Record-ID")), fields["WARC-Type"], fields.get("WARC-Target-URI"),
                fields.get("WARC-Payload-Digest", "").removeprefix("sha1:"), _bare(fields.get("WARC-Refers-To")), block,
            )


def _bare(value: str | None) -> str | None:
    return value and value.removeprefix("<urn:page:").removesuffix(">")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``: ``(page_id, record_type, uri, payload_digest, refers_to, block)``, ids as strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD.split(", ")]

        def parts() -> Iterator[str]:
            for batch in batches:
                yield from batch.column("value").to_pylist()

        held: list[tuple] = []
        size = 0
        # Every archive ends with a whole record, so one after another in a task is one long archive.
        for record in parse(parts()):
            held.append(record)
            size += len(record[-1])
            if size > 4_000_000 or len(held) >= 5000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*held)], names)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*held)], names)

    return spark.read.text(path, lineSep=END).mapInArrow(run, RECORD)


def deduplicate(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write one record for each of ``(page_id, url, html)`` below ``path``: a response, or a revisit of an equal payload."""
    numbered = headers(pages).withColumn("row", F.monotonically_increasing_id())
    rows = cut(numbered)
    decided = resolve(rows.select("row", "page_id", "payload_bytes", "payload_digest"), least_bytes)
    joined = rows.join(decided, "row", "left")
    write(joined.select(
        "page_id", F.coalesce("record_type", F.lit("response")).alias("record_type"), F.col("url").alias("uri"),
        "payload_digest", "refers_to", F.col("html").alias("block"),
    ), path)


def payloads(records: DataFrame) -> DataFrame:
    """``(page_id, record_type, payload_bytes, payload_digest, refers_to)``; a revisit has what its original's payload has.

    Size and digest are taken from the payloads. Revisits meet the responses that they refer to by record id and
    digest; one whose original is missing keeps the digest of its header and a null size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [(x or "").encode() for x in batch.column("block").to_pylist()]
            response = [x == "response" for x in batch.column("record_type").to_pylist()]
            digest = [payload_digest(b) if r else d for b, r, d in zip(blobs, response, batch.column("payload_digest").to_pylist())]
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("record_type"), pa.array([len(b) if r else None for b, r in zip(blobs, response)], pa.int64()),
                pa.array(digest, pa.string()), batch.column("refers_to"),
            ], ["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"])

    shape = "page_id string, record_type string, payload_bytes long, payload_digest string, refers_to string"
    seen = cut(records.mapInArrow(run, shape))
    responses = seen.where("record_type = 'response'")
    originals = responses.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("original_bytes"))
    revisits = seen.where("record_type <> 'response'").join(originals, ["refers_to", "payload_digest"], "left")
    return responses.unionByName(revisits.withColumn("payload_bytes", F.col("original_bytes")).drop("original_bytes"))
