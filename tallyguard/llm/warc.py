"""WARC bundles: records in independent Zstandard frames, a seek table at the end, an index into the frames."""

from __future__ import annotations

import base64
import hashlib
import struct
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.llm.base import ship, text_bytes
from tallyguard.session import scratch_path

#: A frame is closed once it holds so many bytes of records, a bundle once it holds so many compressed ones.
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 22
LEVEL = 3
#: Payloads from this size on are stored once.
LEAST_BYTES = 0
DATE = "1970-01-01T00:00:00Z"
#: Fixed values of the formats: skippable frame, end of a seek table, profile of a revisit record.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ENTRY = "struct<record_id: string, frame: int, place: bigint, length: bigint>"
BUNDLES = f"bundle string, data binary, records array<{ENTRY}>"
RECORDS = "record_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string"


def record_id(id_: str | None, row_no: int) -> str:
    """A record's identifier: the row's id, percent-encoded, and its number, since ids may repeat or be NULL."""
    return f"<urn:page:{'n' if id_ is None else 'v' + quote(id_, safe='')}:{row_no}>"


def id_of(record: str) -> str | None:
    known = record[1:-1].split(":")[2]
    return unquote(known[1:]) if known[0] == "v" else None


def record(name: str, url: str | None, payload: bytes, digest: bytes, refers: str | None, date: str) -> bytes:
    """A response record with its payload, or a revisit record with the HTTP headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: {name}"]
    head += [f"WARC-Target-URI: {quote(url or 'about:blank', safe=':/?#[]@!$&()*+,;=%~')}", f"WARC-Date: {date}"]
    head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}"]
    if refers is not None:
        head += [f"WARC-Refers-To: {refers}", f"WARC-Profile: {REVISIT}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parsed(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at ``at``, and where the next one begins."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    first, size = end + 4, int(head["Content-Length"])
    if data[first + size : first + size + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at {at} has another length than it says")
    return head, data[first : first + size], first + size + 4


class Bundle:
    """A bundle being written: records gather in a frame, full frames are compressed one by one."""

    def __init__(self, frame_bytes: int, level: int):
        self.frame_bytes, self.packer = frame_bytes, zstandard.ZstdCompressor(level=level)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.filled = self.packed = 0
        self.index: list[dict] = []

    def add(self, name: str, data: bytes) -> None:
        self.index.append({"record_id": name, "frame": len(self.frames), "place": self.filled, "length": len(data)})
        self.open.append(data)
        self.filled += len(data)
        if self.filled >= self.frame_bytes:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            self.frames.append(self.packer.compress(b"".join(self.open)))
            self.sizes.append((len(self.frames[-1]), self.filled))
            self.packed += len(self.frames[-1])
            self.open, self.filled = [], 0

    def bytes(self) -> bytes:
        self.close_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(table)) + table


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(place, compressed size, size) of every frame, read from the end of a bundle."""
    count, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE:
        raise ValueError("the bundle has no seek table")
    width = 12 if flags & 0x80 else 8
    first, at, out = len(data) - 9 - width * count, 0, []
    for i in range(count):
        packed, size = struct.unpack_from("<II", data, first + width * i)
        out.append((at, packed, size))
        at += packed
    if at != first - 8:
        raise ValueError("the seek table doesn't fit the frames")
    return out


def frame(data: bytes, entry: tuple[int, int, int]) -> bytes:
    at, packed, size = entry
    out = zstandard.ZstdDecompressor().decompress(data[at : at + packed], max_output_size=max(size, 1))
    if len(out) != size:
        raise ValueError(f"the frame at {at} has another size than its seek table says")
    return out


def write_bundles(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
    least_bytes: int = LEAST_BYTES,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    date: str = DATE,
) -> None:
    """Write one record per row into bundles, rows of ``folder`` (bundle, data, records).

    ``data`` is a whole WARC file in seekable Zstandard: independent frames of about ``frame_bytes``, then a
    seek table; ``records`` maps each record identifier to its frame, its place in the frame and its length.
    A payload is the text in UTF-8. Of rows with equal payloads of ``least_bytes`` or more, that with the
    largest id (NULL ids last, then the largest row number) is a response, the others are revisits that refer
    to it; equality is that of SHA-256 digests, so texts never meet in a group. Rows are numbered and written
    once, then join the groups of two or more by digest, which adaptive execution splits where copies abound.

    NULL text counts as empty, a NULL url is ``about:blank``, repeated rows get a record each, other columns
    are not read, an empty table gives no bundle. Spark's writer commits the bundles, so a lost executor only
    repeats its tasks; a bundle is bounded, but a longer payload has a frame and bundle of its own.
    """
    ship(pages.sparkSession)
    payload = text_bytes(text_col)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("row_no", F.monotonically_increasing_id())
    rows = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    path = scratch_path(pages.sparkSession, "payloads")
    rows.write.option("compression", "zstd").parquet(path)
    rows = pages.sparkSession.read.schema(rows.schema).parquet(path)
    best = F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", "row_no")).alias("best")
    copies = rows.where(F.octet_length("payload") >= least_bytes).groupBy("key").agg(best, F.count("*").alias("size"))
    copies = copies.where("size > 1").select("key", F.col("best.id").alias("first"), F.col("best.row_no").alias("first_no"))
    text_id, first = F.col("id").cast("string"), F.col("first").cast("string")
    dealt = rows.join(copies, "key", "left").select(
        "row_no", text_id.alias("id"), "url", "payload", first.alias("first"), "first_no"
    )

    def bundles(batches):
        part, number, bundle = TaskContext.get().partitionId(), 0, Bundle(frame_bytes, LEVEL)

        def out():
            row = {"bundle": f"{part:06d}-{number:06d}", "data": bundle.bytes(), "records": bundle.index}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            for i in range(batch.num_rows):
                row = {name: column[i].as_py() for name, column in columns.items()}
                refers = None
                if row["first_no"] is not None and row["first_no"] != row["row_no"]:
                    refers = record_id(row["first"], row["first_no"])
                name, body = record_id(row["id"], row["row_no"]), row["payload"]
                bundle.add(name, record(name, row["url"], body, hashlib.sha1(body).digest(), refers, date))
                if bundle.packed + bundle.filled >= bundle_bytes:
                    yield out()
                    number, bundle = number + 1, Bundle(frame_bytes, LEVEL)
        if bundle.index:
            yield out()

    schema = _arrow(pages.sparkSession, BUNDLES)
    written = dealt.mapInArrow(bundles, BUNDLES).write.option("compression", "uncompressed")
    written.option("parquet.block.size", 1 << 25).parquet(folder)


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def described(head: dict[str, str], block: bytes) -> dict:
    """What a record says of its payload; a response's payload is checked against its length and digest."""
    http, payload = block.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    size, digest = int(fields["Content-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
    if head["WARC-Type"] == "response":
        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (len(payload), own) != (size, digest):
            raise ValueError(f"the payload of {head['WARC-Record-ID']} is damaged")
    return {
        "record_id": head["WARC-Record-ID"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": head["WARC-Type"],
        "refers_to": head.get("WARC-Refers-To"),
        "payload": payload if head["WARC-Type"] == "response" else None,
    }


def read_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the bundles: record_id, payload_bytes, payload_digest, record_type, refers_to.

    Frames are found by the seek table and decompressed one at a time; payloads are checked and left out.
    """
    ship(spark)

    def records(batches):
        for batch in batches:
            for data in batch.column(0):
                data = data.as_py()
                for entry in seek_table(data):
                    body, at, out = frame(data, entry), 0, []
                    while at < len(body):
                        head, block, at = parsed(body, at)
                        out.append(described(head, block))
                    yield pa.RecordBatch.from_pylist(out, schema)

    schema = _arrow(spark, RECORDS)
    return spark.read.parquet(folder).select("data").mapInArrow(records, RECORDS)


def find_records(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """The records whose record_id is in ``wanted``, with their payload (NULL for a revisit).

    The index is joined without reading any data; a bundle that holds a wanted record is read, and only the
    frames with such records are decompressed.
    """
    ship(spark)
    bundles = spark.read.parquet(folder)
    index = bundles.select("bundle", F.explode("records").alias("at")).select("bundle", "at.*")
    hits = index.join(wanted.select("record_id").distinct(), "record_id")
    hits = hits.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("frame", "place", "length"))).alias("hits"))

    def records(batches):
        for batch in batches:
            for data, places in zip(batch.column(0), batch.column(1)):
                data, known, body = data.as_py(), None, b""
                table = seek_table(data)
                for hit in places.as_py():
                    if hit["frame"] != known:
                        known, body = hit["frame"], frame(data, table[hit["frame"]])
                    head, block, _ = parsed(body[hit["place"] : hit["place"] + hit["length"]], 0)
                    yield pa.RecordBatch.from_pylist([described(head, block)], schema)

    ddl = RECORDS + ", payload binary"
    schema = _arrow(spark, ddl)
    return bundles.select("bundle", "data").join(hits, "bundle").select("data", "hits").mapInArrow(records, ddl)


def round_trip(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """Write bundles into a fresh folder and read from them, a row per page: ``id_col``, payload_bytes,
    payload_digest, record_type, refers_to (the response's ``id_col``)."""
    folder = scratch_path(pages.sparkSession, "warc")
    write_bundles(pages, folder, id_col, **options)
    kind = pages.schema[id_col].dataType

    def known(name: str):
        mark = F.split_part(F.col(name), F.lit(":"), F.lit(3))
        return F.when(mark.startswith("v"), F.url_decode(F.replace(F.substr(mark, F.lit(2)), F.lit("+"), F.lit("%2B")))).cast(kind)

    out = read_bundles(pages.sparkSession, folder)
    return out.select(
        known("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", known("refers_to").alias("refers_to")
    )
