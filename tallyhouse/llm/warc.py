"""WARC archives as seekable Zstandard bundles.

A bundle is one file. Its records are grouped into independent Zstandard frames, each
readable alone; a skippable frame then maps every record identifier to its frame and the
offset inside it, and a seek table with the sizes of all frames ends the file. Any
Zstandard reader sees plain WARC text; a reader of single records needs the footer only.

Tasks build the bundles of their own rows, so memory is bounded by one bundle (or one
record, if that is larger) and no payload is shuffled, unless too many payloads repeat.
Files are written through Spark, as a text file whose only line is the bundle and whose
line end is the magic number that closes a seek table: this reaches every store Spark
reaches, and a task that is run again leaves one file.

Of records with equal payloads of at least ``LEAST`` bytes those of the smallest id hold
the payload, the others are revisits that name it. Equal means the same SHA-256.

Defined results: a null payload is empty. Rows without an id are never the smallest, but
among themselves. Rows that share id and payload are records of one identifier. Control
characters in a target address are written percent-encoded; a null address is left out.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import query
from tallyhouse.llm.common import Stages, scratch_path

LEAST = 100
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 25
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed values of the formats: skippable frames, seek table and its end.
INDEX_FRAME, SEEK_FRAME = 0x184D2A5D, 0x184D2A5E
SEEK_END = struct.pack("<I", 0x8F92EAB1)
#: At most so many repeated payloads are broadcast; each stands for 1 / MOST_HOT of all rows or more.
MOST_HOT, HOT_ROWS = 10_000, 50_000
MOST_LISTED = 1_000
RECORD = "record_id string, record_type string, page_id string, target_uri string, payload binary, payload_digest string, payload_bytes long, refers_to string"


def record_id(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.sha256(f'{page_id}|{digest}'.encode()).hexdigest()[:32])}>"


def warc_record(row: dict) -> tuple[str, bytes]:
    """Identifier and bytes of one record."""
    own = record_id(row["page_id"], row["digest"])
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    block = http if row["revisit"] else http + row["payload"]
    head = [("WARC-Type", "revisit" if row["revisit"] else "response"), ("WARC-Record-ID", own), ("WARC-Date", DATE)]
    if row["page_id"] is not None:
        head.append(("Page-ID", json.dumps(row["page_id"])))
    if row["uri"] is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x1f\x7f]", lambda c: f"%{ord(c[0]):02X}", row["uri"])))
    head.append(("WARC-Payload-Digest", f"sha256:{row['digest']}"))
    if row["revisit"]:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(row["first"], row["digest"])), ("Refers-To-Page-ID", json.dumps(row["first"]))]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return own, text.encode() + block + b"\r\n\r\n"


class Bundle:
    """Frames of one file, and where each record lies in them."""

    def __init__(self) -> None:
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []
        self.open, self.open_bytes, self.bytes = [], 0, 0

    def add(self, name: str, record: bytes) -> None:
        if self.open and self.open_bytes + len(record) > FRAME_BYTES:
            self.close_frame()
        self.index.append((name, len(self.frames), self.open_bytes, len(record)))
        self.open.append(record)
        self.open_bytes += len(record)

    def close_frame(self) -> None:
        if self.open:
            raw = b"".join(self.open)
            self.frames.append(zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(raw))
            self.sizes.append((len(self.frames[-1]), len(raw)))
            self.bytes += len(self.frames[-1])
            self.open, self.open_bytes = [], 0

    def finish(self) -> bytes:
        """The whole file but its last four bytes, which the writer's line end adds."""
        self.close_frame()
        places = zstandard.compress(json.dumps(self.index).encode())
        places = struct.pack("<II", INDEX_FRAME, len(places)) + places
        sizes = [*self.sizes, (len(places), 0)]
        table = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IB", len(sizes), 0) + SEEK_END
        return b"".join([*self.frames, places, struct.pack("<II", SEEK_FRAME, len(table)), table])[: -len(SEEK_END)]


def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one task to (bundle, content); numbers never meet those of other tasks."""
    number, current = TaskContext.get().partitionId() << 32, Bundle()

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"bundle": pa.array([number], pa.int64()), "content": pa.array([current.finish()], pa.binary())})

    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            for row in batch.slice(i, 64).to_pylist():
                current.add(*warc_record(row))
                if current.bytes >= BUNDLE_BYTES:
                    yield done()
                    number, current = number + 1, Bundle()
    if current.index:
        yield done()


def read_footer(content: memoryview) -> tuple[list[tuple[int, int]], list]:
    """(start, end) of every frame that holds records, and the record index, from the end of a file."""
    count, _, end = struct.unpack("<IB4s", content[-9:])
    if end != SEEK_END:
        raise ValueError("no seek table at the end of the file")
    at, places = 0, []
    for size, _ in struct.iter_unpack("<II", content[-9 - 8 * count : -9]):
        places.append((at, at + size))
        at += size
    first, last = places.pop()
    return places, json.loads(zstandard.decompress(content[first + 8 : last]))


def parse_record(raw: bytes) -> dict:
    """A record's columns; a payload that differs from its digest raises."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"{fields['WARC-Record-ID']}: payload and digest differ")
    return {
        "record_id": fields["WARC-Record-ID"],
        "record_type": fields["WARC-Type"],
        "page_id": json.loads(fields.get("Page-ID", "null")),
        "target_uri": fields.get("WARC-Target-URI"),
        "payload": None if revisit else payload,
        "payload_digest": digest,
        "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
        "refers_to": json.loads(fields.get("Refers-To-Page-ID", "null")),
    }


def table_of(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({f.name: pa.array([r[f.name] for r in rows], f.type) for f in schema}, schema)


RECORD_SCHEMA = pa.schema([(c.split()[0], {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}[c.split()[1]]) for c in RECORD.split(", ")])


def mark_revisits(rows: DataFrame, stages: Stages, least: int) -> DataFrame:
    """``rows`` (page, digest, size, ...) with first, the smallest page of an equal payload, null where it is the row's own.

    Repeated payloads of many rows, at most ``MOST_HOT`` by their row limit, are broadcast; the
    others are joined as Spark finds best for their size.
    """
    large = rows.where(F.col("size") >= least)
    repeated = large.groupBy("digest").agg(F.count("*").alias("n"), F.min("page").alias("first"))
    repeated = stages.write("repeated", repeated.where("n > 1"))
    total = repeated.agg(F.sum("n")).first()[0] or 0
    limit = max(HOT_ROWS, total // MOST_HOT)
    hot = repeated.where(F.col("n") > limit).select("digest", F.col("first").alias("hot_first"))
    rest = repeated.where(F.col("n") <= limit).select(F.col("digest").alias("key"), F.col("first").alias("rest_first"))
    joined = rows.join(F.broadcast(hot), "digest", "left")
    # rows that need no partner take keys of their own, so that they are dealt evenly
    alone = F.col("hot_first").isNotNull() | (F.col("size") < least)
    key = F.when(alone, F.concat(F.lit("-"), F.coalesce(F.col("page").cast("string"), F.lit("")))).otherwise(F.col("digest"))
    joined = joined.withColumn("key", key).join(rest, "key", "left")
    first = F.coalesce("hot_first", "rest_first")
    return joined.withColumn("first", F.when(~F.col("page").eqNullSafe(first), first)).drop("key", "hot_first", "rest_first")


def write_archives(pages: DataFrame, page_id: str, url: str, payload: str, path: str, least: int = LEAST) -> None:
    """Write a record per row of ``pages`` below ``path``, one folder and file per bundle."""
    stages = Stages(pages.sparkSession)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).alias("page"), F.col(url).cast("string").alias("uri"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    marked = mark_revisits(rows, stages, least)
    records = marked.select(
        F.col("page").cast("string").alias("page_id"),
        "uri",
        "digest",
        "size",
        F.col("first").cast("string").alias("first"),
        F.col("first").isNotNull().alias("revisit"),
        F.when(F.col("first").isNull(), F.col("payload")).alias("payload"),
    )
    packed = records.mapInArrow(bundles, "bundle long, content binary")
    (
        packed.select("bundle", F.col("content").cast("string").alias("value"))
        .write.partitionBy("bundle")
        .option("encoding", "ISO-8859-1")
        .option("lineSep", SEEK_END.decode("latin-1"))
        .text(path)
    )


def files(spark: SparkSession, path: str) -> DataFrame:
    """bundle and content of all files below ``path``."""
    read = spark.read.format("binaryFile").load(path)
    # without a single bundle there is no folder to name the column
    bundle = F.col("bundle") if "bundle" in read.columns else F.lit(None)
    return read.select(bundle.cast("long").alias("bundle"), "content")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``, frame by frame; revisits have no payload."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                content = memoryview(content.as_buffer())
                frames, index = read_footer(content)
                by_frame: dict[int, list] = {}
                for _, frame, offset, size in index:
                    by_frame.setdefault(frame, []).append((offset, size))
                for frame, places in by_frame.items():
                    start, end = frames[frame]
                    raw = zstandard.decompress(content[start:end])
                    yield table_of([parse_record(raw[o : o + n]) for o, n in places], RECORD_SCHEMA)

    return files(spark, path).select("content").mapInArrow(records, RECORD)


def index_archives(spark: SparkSession, path: str) -> DataFrame:
    """record_id, bundle, frame, offset in the frame and length of every record, from the footers alone."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, bundle in zip(batch.column("content"), batch.column("bundle").to_pylist(), strict=True):
                _, index = read_footer(memoryview(content.as_buffer()))
                name, frame, offset, size = zip(*index, strict=True)
                yield pa.RecordBatch.from_pydict({"record_id": name, "bundle": [bundle] * len(name), "frame": frame, "offset": offset, "length": size})

    return files(spark, path).select("content", "bundle").mapInArrow(entries, "record_id string, bundle long, frame long, offset long, length long")


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records of ``wanted`` (rows of the index): only their frames are opened.

    Up to ``MOST_LISTED`` bundles are named to the scan, which then reads no others; beyond that all are read and joined.
    """

    def cut(places: pa.Table, contents: pa.Table) -> pa.Table:
        rows = []
        if places.num_rows and contents.num_rows:
            content = memoryview(contents.column("content")[0].as_buffer())
            frames, _ = read_footer(content)
            places = places.sort_by([("frame", "ascending"), ("offset", "ascending")]).select(["frame", "offset", "length"])
            opened, raw = None, b""
            for place in places.to_pylist():
                if place["frame"] != opened:
                    opened = place["frame"]
                    raw = zstandard.decompress(content[slice(*frames[opened])])
                rows.append(parse_record(raw[place["offset"] : place["offset"] + place["length"]]))
        return pa.Table.from_batches([table_of(rows, RECORD_SCHEMA)])

    named = [r["bundle"] for r in wanted.select("bundle").distinct().limit(MOST_LISTED + 1).collect()]
    needed = files(spark, path)
    if len(named) <= MOST_LISTED:
        needed = needed.where(F.col("bundle").isin(named))
    else:
        needed = needed.join(wanted.select("bundle").distinct(), "bundle", "left_semi")
    return wanted.groupBy("bundle").cogroup(needed.groupBy("bundle")).applyInArrow(cut, RECORD)


SQL = f"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
), d AS (SELECT page_id, payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (
  SELECT *, CASE WHEN payload_bytes >= {LEAST} THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""


@query("op12_warc", SQL)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = scratch_path(spark, "warc")
    write_archives(pages, "page_id", "url", "html", path)
    kind = pages.schema["page_id"].dataType
    # a response counts what came back from its frame; a revisit has what its record says of the payload
    read = read_archives(spark, path)
    return read.select(
        F.col("page_id").cast(kind).alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha2("payload", 256), "payload_digest").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
