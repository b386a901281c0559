"""WARC archives: writing captures, reading records and assembling transactions.

A capture is a request, a response (or a revisit of an equal payload) and a metadata record.
Records point at each other by ``WARC-Concurrent-To``; assembly resolves the pointers in
either direction with equi-joins and emits one nested row per capture.

Writing uses Spark's text writer: the text of a capture's records, with the two line ends that
close a record as the line separator. Archives therefore land wherever Spark can write. Reading
takes records out of archives (also of gzip members) by their content lengths, unpacking a piece at a time.

Scale: which record of equal payloads is the response is found on digests only, combined
map-side; digests that occur once take no part in the join, and the join key is salted, so one
payload shared by a third of all pages is spread. Archives hold at most ``RECORDS_PER_FILE``
captures and are unpacked record by record, so a reading task holds a packed file and a few records. Records meet on the salt-free id of their
capture, which few records share. Equal rows are numbered within the partitions of that first join.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewarden.llm.common import stage, table
from tracewarden.sources.staging import new_folder

LEAST_REVISIT = 1_000
RECORDS_PER_FILE = 2_000
SALTS = 32
END = "\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"
GZIP = b"\x1f\x8b"
PIECE = 1 << 16  # bytes of an archive that are unpacked at a time

# ---- writing ------------------------------------------------------------------------------


def with_digests(pages: DataFrame) -> DataFrame:
    """``page_id, url, html`` with ``payload_bytes, payload_digest``; a null payload is empty."""
    raw = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    return pages.select(
        "page_id",
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
        F.length(raw).cast("bigint").alias("payload_bytes"),
        F.sha1(raw).alias("payload_digest"),
    )


def with_targets(pages: DataFrame) -> DataFrame:
    """Adds ``refers_to``: of equal payloads of at least ``LEAST_REVISIT`` bytes, the largest page id; else null.

    Records with that id itself, or without an id, keep null. Only digests and ids are grouped and joined.
    ``__nth`` tells equal rows apart.
    """
    large = pages.filter(F.col("payload_bytes") >= LEAST_REVISIT).select("page_id", "url", "payload_digest")
    large = large.withColumn("__at", F.struct("page_id", "url"))
    targets = large.groupBy("payload_digest").agg(F.max("__at").alias("__target"), F.count(F.lit(1)).alias("__n"))
    targets = targets.filter("__n > 1").select(
        "payload_digest", "__target", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")
    )
    small = F.col("payload_bytes") < LEAST_REVISIT
    # payloads that cannot be revisits get a salt without a partner
    salt = F.when(small, -1 - F.pmod(F.xxhash64("page_id"), F.lit(SALTS))).otherwise(F.pmod(F.xxhash64("page_id"), F.lit(SALTS)))
    joined = pages.withColumn("__salt", salt.cast("int")).join(targets, ["payload_digest", "__salt"], "left")
    # equal rows share page id and digest, so also the salt; which of them gets which number does not matter
    equal = Window.partitionBy("payload_digest", "__salt", "page_id", "url").orderBy(F.lit(1))
    joined = joined.withColumn("__nth", F.row_number().over(equal))
    other = F.col("__target.page_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__target.page_id"))
    target = F.when(other, F.col("__target"))
    refers = F.when(F.col("page_id").isNotNull(), target["page_id"])
    return joined.withColumn("refers_to", refers).withColumn("__target", target).drop("__salt")


def _record_id(kind: str, within: str = ""):
    """A stable urn:uuid made of a hash of the kind of record and the page: its id, url, payload and number among equal rows.

    A target is always the first of its equal rows.
    """
    nth = F.lit("1") if within else F.col("__nth").cast("string")
    page = F.coalesce(F.concat(F.lit("v"), F.col(f"{within}page_id").cast("string")), F.lit("n"))
    parts = [page, F.col("payload_digest"), nth, F.col(f"{within}url")]
    h = F.md5(F.concat_ws(" ", F.lit(kind), *parts))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind, record_id, block, content_type: str, *more) -> F.Column:
    head = [
        F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), record_id,
        F.lit(f"\r\nWARC-Date: {DATE}\r\n"), *more,
        F.lit(f"Content-Type: {content_type}\r\nContent-Length: "), F.octet_length(block).cast("string"),
        F.lit(END),
    ]
    return F.concat(*head, block)


def captures(pages: DataFrame) -> DataFrame:
    """``value``: the request, response or revisit, and metadata record of every page as text.

    The records are in this order, each closed by two line ends but the last, which the writer closes.
    Line ends within a url are escaped, since a header is a line.
    """
    response, request, metadata = (_record_id(k) for k in ("response", "request", "metadata"))
    url = F.regexp_replace(F.col("url"), "[\\r\\n]", "%0A")
    target = F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n"))
    revisit = F.col("__target").isNotNull()
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit("\r\n"))
    profile = "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"
    refers = F.when(
        revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id("response", "__target."), F.lit(f"\r\n{profile}"))
    ).otherwise("")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
    )
    asked = F.concat(F.lit("GET "), url, F.lit(f" HTTP/1.1{END}"))
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), response, F.lit("\r\n"))
    about = F.concat(
        F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit("\r\nrefers-to-page: "), F.coalesce(F.col("refers_to").cast("string"), F.lit("")), F.lit("\r\n"),
    )
    records = [
        _record(F.lit("request"), request, asked, "application/http; msgtype=request", target, concurrent),
        _record(
            F.when(revisit, "revisit").otherwise("response"), response,
            F.when(revisit, http).otherwise(F.concat(http, F.col("html"))),
            "application/http; msgtype=response", target, digest, refers,
        ),
        _record(F.lit("metadata"), metadata, about, "application/warc-fields", target, concurrent),
    ]
    return pages.select(F.concat_ws(END, *records).alias("value"))


def write_archives(pages: DataFrame, path: str, per_file: int = RECORDS_PER_FILE) -> None:
    """Write a request, a response or revisit, and a metadata record for every row of ``page_id, url, html``."""
    found = with_targets(with_digests(pages))
    writer = captures(found).write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", per_file).text(path)


# ---- reading ------------------------------------------------------------------------------

RECORDS = (
    "record_id string, warc_type string, concurrent_to array<string>, refers_to string, target_uri string, "
    "date string, digest string, http_head string, payload binary, declared_bytes bigint"
)


class _Bytes:
    """Bytes of an archive in order, a piece at a time; gzip members one after the other are unpacked.

    ``held`` has what is read and not yet dropped: about a record, never the whole unpacked archive.
    """

    def __init__(self, data: bytes):
        self.data, self.at, self.member = data, 0, None
        self.packed = data[:2] == GZIP
        self.held, self.dropped = bytearray(), 0

    def more(self) -> bool:
        """Read another piece; false at the end. A member that breaks off ends the archive."""
        if self.packed and self.member is None:
            if self.data[self.at : self.at + 2] != GZIP:
                return False
            self.member = zlib.decompressobj(wbits=31)
        piece = self.data[self.at : self.at + PIECE]
        if not piece:
            return False
        self.at += len(piece)
        if self.packed:
            self.held += self.member.decompress(piece)
            if self.member.eof:
                self.at -= len(self.member.unused_data)
                self.member = None
        else:
            self.held += piece
        return True

    def fill(self, size: int) -> bool:
        """Whether ``size`` bytes are held, after reading what that takes."""
        while len(self.held) < size:
            if not self.more():
                return False
        return True

    def find(self, mark: bytes) -> int:
        """Where ``mark`` is in what is held, after reading on as far as it."""
        start = 0
        while (found := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                raise ValueError(f"record at byte {self.dropped} is cut off")
        return found

    def take(self, size: int) -> bytes:
        taken = bytes(self.held[:size])
        del self.held[:size]
        self.dropped += size
        return taken


def _fields(head: bytes) -> list[tuple[str, str]]:
    """Header fields in order, names in lower case; folded lines continue the field before."""
    found: list[tuple[str, str]] = []
    for line in head.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            found.append((name.strip().lower(), value.strip()))
    return found


def parse_records(data: bytes) -> Iterator[dict]:
    """Records of one archive, of any size. Parsing stops with an error at anything that is no record or breaks off.

    Null, empty and very long bodies are records like any other; repeated records are all returned (``assemble``
    counts them once).
    """
    rest = _Bytes(data)
    while True:
        while rest.fill(2) and rest.held.startswith(b"\r\n"):
            rest.take(2)
        if not rest.fill(1):
            return
        at = rest.dropped
        if not rest.fill(5) or not rest.held.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        lines = rest.take(rest.find(b"\r\n\r\n") + 4)
        fields = _fields(lines[lines.index(b"\r\n") + 2 : -2])
        named = dict(fields)
        length = int(named["content-length"])
        if not rest.fill(length):
            raise ValueError(f"record at byte {at} is cut off")
        block = rest.take(length)
        head, payload, declared = b"", block, None
        if named.get("content-type", "").startswith("application/http"):
            head, _, payload = block.partition(b"\r\n\r\n")
            size = dict(_fields(head)).get("content-length")
            declared = int(size) if size and size.isdigit() else None
        yield {
            "record_id": named.get("warc-record-id"),
            "warc_type": named.get("warc-type"),
            "concurrent_to": [v for k, v in fields if k == "warc-concurrent-to"],
            "refers_to": named.get("warc-refers-to"),
            "target_uri": named.get("warc-target-uri"),
            "date": named.get("warc-date"),
            "digest": named.get("warc-payload-digest"),
            "http_head": head.decode("utf-8", "replace"),
            "payload": payload,
            "declared_bytes": declared,
        }


def _batches(rows: Iterable[dict], schema: pa.Schema, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row["payload"])
        if size >= most:
            yield pa.RecordBatch.from_pylist(some, schema)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives in a folder."""
    kinds = {"array<string>": pa.list_(pa.string()), "binary": pa.binary(), "bigint": pa.int64(), "string": pa.string()}
    fields = [pa.field(*(x.split(" ")[0], kinds[x.split(" ")[1]])) for x in RECORDS.split(", ")]

    def work(batches):
        schema = pa.schema(fields)
        for batch in batches:
            for content in batch.column(0):
                yield from _batches(parse_records(content.as_py()), schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(work, RECORDS)


MAIN = ("response", "revisit", "resource")  # records that are a capture


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, response, requests, metadata``.

    A response, revisit or resource record is a capture. Any other record belongs to the captures it is
    concurrent to, or that are concurrent to it. Records without a partner are kept: as a capture
    without requests, or under their own id without a response. A record written twice counts once.
    ``records`` is evaluated several times: it should be a stored table, or archives that are read again.
    """
    is_main = F.col("warc_type").isin(*MAIN)
    main, other = records.filter(is_main), records.filter(~is_main)
    body = F.struct(*[F.col(c) for c in records.columns])
    own = other.withColumn("capture_id", F.explode("concurrent_to"))
    back = main.select(F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("capture_id")).distinct()
    if back.isEmpty():  # as most archives have it: the other records point at the response
        alone = other.filter(F.size("concurrent_to") == 0).withColumn("capture_id", F.col("record_id"))
        held = own.unionByName(alone)
    else:
        found = other.join(back, "record_id", "left")
        pointed = found.filter(F.col("capture_id").isNotNull() | (F.size("concurrent_to") == 0))
        pointed = pointed.withColumn("capture_id", F.coalesce("capture_id", "record_id"))
        held = own.unionByName(pointed.select(*own.columns)).distinct()
    held = held.select("capture_id", "warc_type", body.alias("body"))
    sides = held.groupBy("capture_id").agg(
        F.sort_array(F.collect_set(F.when(F.col("warc_type") == "request", F.col("body")))).alias("requests"),
        F.sort_array(F.collect_set(F.when(F.col("warc_type") != "request", F.col("body")))).alias("metadata"),
    )
    responses = main.groupBy(F.col("record_id").alias("capture_id")).agg(F.max(body).alias("response"))
    return responses.join(sides, "capture_id", "full_outer")


def payload_facts(records: DataFrame) -> DataFrame:
    """``records`` with ``payload_bytes`` and ``payload_sha1`` of what was read; captures then drop the payload itself.

    Who wants facts of bodies and not the bodies need not move them to assemble them.
    """
    is_main = F.coalesce(F.col("warc_type").isin(*MAIN), F.lit(False))
    facts = records.withColumn("payload_bytes", F.length("payload").cast("bigint"))
    facts = facts.withColumn("payload_sha1", F.sha1("payload"))
    return facts.withColumn("payload", F.when(~is_main, F.col("payload")))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Archives of all pages, read back and assembled; payload facts of revisits come from their headers.

    Bodies are digested where they are read, once; the records without them are stored and assembled.
    """
    path = new_folder(spark, "archives")
    write_archives(table(spark, folder, "pages"), path)
    whole = assemble(stage(payload_facts(read_records(spark, path)), "records"))
    about = F.decode(F.col("metadata")[0]["payload"], "UTF-8")
    number = lambda name: F.expr(f"nullif(regexp_extract({{a}}, '{name}: ([-0-9]+)', 1), '')".replace("{a}", "__about"))
    revisit = F.col("response.warc_type") == "revisit"
    return whole.withColumn("__about", about).select(
        number("page-id").cast("bigint").alias("page_id"),
        F.when(revisit, F.col("response.declared_bytes")).otherwise(F.col("response.payload_bytes")).cast("bigint").alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("response.digest", "^sha1:", "")).otherwise(F.col("response.payload_sha1")).alias("payload_digest"),
        F.col("response.warc_type").alias("record_type"),
        number("refers-to-page").cast("bigint").alias("refers_to"),
    )


OP3_SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), t AS (
  SELECT payload_digest, max(page_id) AS target FROM p WHERE payload_bytes >= {LEAST_REVISIT} GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes::BIGINT AS payload_bytes, p.payload_digest,
  CASE WHEN t.target IS NULL OR t.target = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN t.target <> p.page_id THEN t.target END AS refers_to
FROM p LEFT JOIN t ON p.payload_digest = t.payload_digest AND p.payload_bytes >= {LEAST_REVISIT}
"""
