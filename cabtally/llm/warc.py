"""WARC archives: writing captures, reading records, assembling transactions.

Archives are written by Spark's text writer, whose line separator is the blank line that
ends a WARC record; so they go through any file system that Spark reaches, and are
committed as all its output is. Reading takes whole archives as binary files, which the
writer keeps small, and parses records by their Content-Length. A transaction is put
together from the identifiers alone: request and metadata records name the capture they
are concurrent to (or are named by it), wherever in the archives they are.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabtally.llm.common import numbered, stored, table
from cabtally.sources.storage import scratch_folder

#: Payloads from this size on are written once; further ones revisit it.
REVISIT_BYTES = 1000
#: Captures of an archive file, and compressed bytes that the inflater gets at once.
CAPTURES_PER_FILE = 2000
CHUNK = 1 << 20
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = (
    "record_id string, type string, concurrent_to array<string>, target_uri string, date string, "
    "refers_to string, payload_bytes long, payload_digest string, head string, fields map<string,string>"
)
_MAP = pa.map_(pa.string(), pa.string())
_ARROW = {
    "record_id": pa.string(), "type": pa.string(), "concurrent_to": pa.list_(pa.string()),
    "target_uri": pa.string(), "date": pa.string(), "refers_to": pa.string(),
    "payload_bytes": pa.int64(), "payload_digest": pa.string(), "head": pa.string(), "fields": _MAP,
}


# Writing


def _urn(row: Column, kind: str) -> Column:
    """A record identifier for the row, always the same."""
    digest = F.md5(F.concat(F.lit(f"{kind}:"), row.cast("string")))
    parts = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[Column], block: Column) -> Column:
    """A record without the blank line at its end; null headers are left out."""
    return F.concat(
        F.concat_ws("\r\n", F.lit("WARC/1.1"), *headers),
        F.lit("\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
        block,
    )


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """One capture for each of the ``pages`` ``(page_id, url, html)``: request, response or
    revisit, and metadata with the page's id.

    Of equal payloads of at least ``REVISIT_BYTES`` the page with the largest id is the
    response, of repeated rows any one, and the others refer to it. A null html is an empty
    payload, a null url leaves out the target, a null id the metadata field. Line ends in a
    url are written as %0D and %0A.
    """
    rows = numbered(pages.select("page_id", "url", "html"), "row")
    rows = rows.withColumn("payload", F.coalesce("html", F.lit(""))).withColumn("digest", F.sha1("payload"))
    rows = rows.select("row", "page_id", "url", "payload", "digest", F.octet_length("payload").alias("size"))
    first = (
        rows.where(F.col("size") >= REVISIT_BYTES)
        .groupBy("digest", "size")
        .agg(F.max(F.struct("page_id", "row")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "size", F.col("first.row").alias("first_row"))
    )
    repeats = (
        rows.select("row", "digest", "size").join(first, ["digest", "size"])
        .where("row <> first_row").select("row", "first_row")
    )
    rows = rows.join(repeats, "row", "left")
    again = F.col("first_row").isNotNull()
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    capture = _urn(F.col("row"), "capture")

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)  # null if the value is

    shared = [line("WARC-Date", F.lit(date)), line("WARC-Target-URI", target)]
    host = F.coalesce(F.regexp_extract(target, "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(target, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)", 1), F.lit(""))
    request = _record(
        [
            line("WARC-Type", F.lit("request")),
            line("WARC-Record-ID", _urn(F.col("row"), "request")),
            *shared,
            line("WARC-Concurrent-To", capture),
            line("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(
            F.lit("GET "), F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)),
            F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END),
        ),
    )
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit(END),
    )
    response = _record(
        [
            line("WARC-Type", F.when(again, "revisit").otherwise("response")),
            line("WARC-Record-ID", capture),
            *shared,
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            line("WARC-Refers-To", F.when(again, _urn(F.col("first_row"), "capture"))),
            line("WARC-Profile", F.when(again, F.lit(PROFILE))),
            line("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.concat(head, F.when(again, F.lit("")).otherwise(F.col("payload"))),
    )
    metadata = _record(
        [
            line("WARC-Type", F.lit("metadata")),
            line("WARC-Record-ID", _urn(F.col("row"), "metadata")),
            *shared,
            line("WARC-Concurrent-To", capture),
            line("Content-Type", F.lit("application/warc-fields")),
        ],
        F.coalesce(F.concat(F.lit("page_id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("")),
    )
    rows.select(F.concat_ws(END, request, response, metadata).alias("value")).write.option(
        "maxRecordsPerFile", CAPTURES_PER_FILE
    ).option("lineSep", END).option("compression", "gzip").text(folder)


# Reading


class _Inflated(io.RawIOBase):
    """Bytes of an archive, inflated as they are read; its members follow one another."""

    def __init__(self, data: bytes):
        self._rest, self._at = memoryview(data), 0
        self._plain = data[:2] != b"\x1f\x8b"
        self._inflate = None

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        if self._plain:
            out = self._rest[self._at : self._at + len(into)]
            self._at += len(out)
            into[: len(out)] = out
            return len(out)
        while True:
            if self._inflate is None:
                if self._at >= len(self._rest):
                    return 0
                self._inflate, self._tail = zlib.decompressobj(31), b""
            if not self._tail:
                self._tail = bytes(self._rest[self._at : self._at + CHUNK])
                self._at += len(self._tail)
            ended = not self._tail
            out = self._inflate.decompress(self._tail, len(into))
            self._tail = self._inflate.unconsumed_tail
            if self._inflate.eof:
                self._at -= len(self._inflate.unused_data)
                self._inflate = None
            elif ended and not out:
                raise EOFError("an archive ends within a compressed member")
            if out:
                into[: len(out)] = out
                return len(out)


def _headers(read) -> list[tuple[str, str]]:
    """The headers up to the blank line."""
    found = []
    while line := read().decode("utf-8", "replace"):
        if not line.strip():
            break
        if line[0] in " \t" and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {line.strip()}")
            continue
        name, _, value = line.partition(":")
        found.append((name.strip().lower(), value.strip()))
    return found


def records(data: bytes) -> Iterator[dict]:
    """The records of an archive. Of request and response blocks the HTTP head is a string
    and the rest the payload; of warc-fields the fields are a map."""
    stream = io.BufferedReader(_Inflated(data), CHUNK)
    while line := stream.readline():
        # Whole lines, as the buffer may end between the two bytes of a line end.
        if line in (b"\r\n", b"\n"):
            continue
        version = line.decode("utf-8", "replace").strip()
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record begins with {version[:40]!r}")
        headers = _headers(stream.readline)
        of = dict(reversed(headers))
        block = stream.read(int(of["content-length"]))
        kind, head, fields = of.get("content-type", ""), None, None
        payload = block
        if kind.startswith("application/http"):
            at = block.find(b"\r\n\r\n")
            cut = len(block) if at < 0 else at + 4
            head, payload = block[:cut].decode("utf-8", "replace"), block[cut:]
        elif kind.startswith("application/warc-fields"):
            fields = _headers(io.BytesIO(block).readline)
            fields = list(dict(reversed(fields)).items())
        yield {
            "record_id": of.get("warc-record-id"),
            "type": of.get("warc-type"),
            "concurrent_to": [v for n, v in headers if n == "warc-concurrent-to"],
            "target_uri": of.get("warc-target-uri"),
            "date": of.get("warc-date"),
            "refers_to": of.get("warc-refers-to"),
            "payload_bytes": len(payload),
            "payload_digest": hashlib.sha1(payload).hexdigest(),
            "head": head,
            "fields": fields,
            "payload": payload,
        }


def read_records(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """All records of the archives in a folder, with their payloads if wanted. Digest and
    size are of the payload as it was read."""
    arrow = _ARROW | ({"payload": pa.binary()} if payloads else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[name] for r in rows], kind) for name, kind in arrow.items()], list(arrow)
            )

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for record in records(content.as_py()):
                    rows.append(record)
                    size += record["payload_bytes"] if payloads else 1000
                    if size > 16e6:
                        yield batch_of(rows)
                        rows, size = [], 0
                yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return files.mapInArrow(run, RECORD_SCHEMA + (", payload binary" if payloads else ""))


# Transactions


def captures(found: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``response`` (response, revisit or
    resource), ``requests`` and ``metadata``.

    A request or metadata record belongs to the capture that it names as concurrent, that
    names it, or that a record it names belongs to. One that leads to no capture is a row
    of its own, without response. A record that occurs twice is taken once. Only
    what one fetch has written is in one row; payloads, if read, stay with the response.
    """
    names = [n for n in found.columns if n != "payload"]
    is_capture = F.coalesce(F.col("type").isin("response", "revisit", "resource"), F.lit(False))
    main = found.where(is_capture)
    side = found.where(~is_capture & F.coalesce(F.col("type") != "warcinfo", F.lit(True)))
    ids = main.select(F.col("record_id").alias("capture_id")).distinct()
    named = side.select("record_id", F.explode("concurrent_to").alias("to"))
    direct = named.join(ids, F.col("to") == F.col("capture_id")).select("record_id", "capture_id")
    reverse = main.select(
        F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("capture_id")
    )
    owners = direct.union(reverse).groupBy("record_id").agg(F.min("capture_id").alias("capture_id"))
    through = named.join(
        owners.select(F.col("record_id").alias("to"), F.col("capture_id").alias("via")), "to"
    ).groupBy("record_id").agg(F.min("via").alias("via"))
    owned = side.select(F.struct(*names).alias("record"), "record_id").join(owners, "record_id", "left")
    owned = owned.join(through, "record_id", "left").select(
        F.coalesce("capture_id", "via", "record_id").alias("capture_id"), "record"
    )
    parts = main.select(F.col("record_id").alias("capture_id"), F.struct(*found.columns).alias("response"), F.lit(None).cast(owned.schema["record"].dataType).alias("record"))
    parts = parts.unionByName(owned, allowMissingColumns=True)

    def of(kind: Column) -> Column:
        return F.array_distinct(F.collect_list(F.when(kind, F.struct(*[F.col(f"record.{n}").alias(n) for n in names if n != "fields"], F.map_entries("record.fields").alias("fields")))))

    request = F.col("record.type") == "request"
    return parts.groupBy("capture_id").agg(
        F.any_value("response", ignoreNulls=True).alias("response"),
        of(request).alias("requests"),
        of(F.col("record").isNotNull() & ~F.coalesce(request, F.lit(False))).alias("metadata"),
    )


def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole payloads of revisits are those of the responses they refer to."""
    folder = f"{scratch_folder(spark, 'warc')}/archives"
    write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    # Kept without payloads: the assembly reads them several times, the archives once.
    found = captures(stored(read_records(spark, folder), "warc-records")).select(
        "capture_id",
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("refers"),
        F.col("response.payload_bytes").alias("bytes"),
        F.col("response.payload_digest").alias("digest"),
        F.element_at(F.map_from_entries(F.col("metadata")[0]["fields"]), "page_id").cast("long").alias("page_id"),
        (F.size("requests") == 1).alias("requested"),
    )
    # Written, so that the join below meets no aggregation and Spark can split a response
    # that very many revisits refer to. Responses refer to nothing and are not joined.
    found = stored(found, "captures")
    whole = found.where("record_type = 'response'").select(
        F.col("capture_id").alias("refers"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("page_id").alias("refers_to"),
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    revisits = found.where("record_type = 'revisit'").join(whole, "refers", "left")
    responses = found.where("record_type = 'response'").select(
        "page_id",
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    return responses.union(revisits.select(*columns))


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
q AS (
  SELECT page_id, strlen(t) AS payload_bytes, sha1(t) AS payload_digest,
         CASE WHEN strlen(t) >= {REVISIT_BYTES} THEN first_value(page_id) OVER (PARTITION BY t ORDER BY page_id DESC NULLS LAST) END AS first_id,
         row_number() OVER (PARTITION BY t ORDER BY page_id DESC NULLS LAST) AS k
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND k > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND k > 1 THEN first_id END AS refers_to
FROM q
"""
