"""Web archives as seekable Zstandard bundles.

A bundle is one file. Its WARC records lie in frames, each compressed on its own, and a footer
(a skippable frame that plain decompressors pass over) lists the compressed and plain size of
every frame:

    frame 0 | frame 1 | ... | seek table

so the frame a record lies in is found by two reads at the end of the file and a running sum,
and nothing before it is decompressed. The index, a Parquet table sorted by record id, says for
each record its bundle, its frame, and its offset and length inside the plain bytes of the frame.

Bundles are written by the tasks that read the pages, under a name of their own for every
attempt; what a lost or doubled attempt leaves behind is never named by the index or manifest.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm.common import saved, small_batches, small_table, spread

#: Plain bytes after which a frame ends, and compressed bytes after which a bundle ends. A record
#: is never split, so a long one makes a long frame.
FRAME_BYTES, BUNDLE_BYTES = 256 * 1024, 256 * 1024 * 1024
#: Frames read by one task.
READ_FRAMES = 128
#: Shortest payload that is written once and revisited by its copies.
LEAST_SHARED = 1000
#: The table has no time of capture.
NO_DATE = "1970-01-01T00:00:00Z"

# Fixed values of the public seekable Zstandard format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
_HEADER, _ENTRY, _FOOTER = struct.Struct("<II"), struct.Struct("<II"), struct.Struct("<IBI")

# Fixed values of WARC 1.1.
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_ID = "X-Page-Id"

INDEX = "record_id string, page_id long, record_type string, bundle string, frame int, offset long, length long"
RECORDS = (
    "record_id string, page_id long, target_uri string, record_type string, refers_to_id string, "
    "payload_digest string, payload_bytes long, payload binary"
)


# --- bytes of records and frames


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer for frames of (compressed, plain) sizes."""
    body = b"".join(_ENTRY.pack(*sizes) for sizes in frames)
    body += _FOOTER.pack(len(frames), 0, SEEKABLE_MAGIC)
    return _HEADER.pack(SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(source) -> list[tuple[int, int, int]]:
    """Start, compressed size and plain size of every frame of an open bundle."""
    end = source.size()
    n_frames, descriptor, magic = _FOOTER.unpack(source.read_at(_FOOTER.size, end - _FOOTER.size))
    if magic != SEEKABLE_MAGIC or descriptor:
        raise ValueError("no seek table at the end of the bundle")
    size = n_frames * _ENTRY.size
    raw = source.read_at(size, end - _FOOTER.size - size)
    frames, start = [], 0
    for compressed, plain in _ENTRY.iter_unpack(raw):
        frames.append((start, compressed, plain))
        start += compressed
    return frames


def _fields(pairs: list[tuple[str, str | None]]) -> bytes:
    return b"".join(f"{name}: {value}\r\n".encode() for name, value in pairs if value is not None)


def record_bytes(row: dict) -> bytes:
    """One WARC record: of a response with its payload, of a revisit with HTTP headers only."""
    payload = row["payload"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (payload or b"")
    revisit = row["refers_to_id"] is not None
    url = row["url"]
    head = _fields(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", row["record_id"]),
            ("WARC-Date", NO_DATE),
            # Whatever may not stand in a header line is escaped; other signs stay.
            ("WARC-Target-URI", None if url is None else quote(url, safe="".join(map(chr, range(33, 127))))),
            ("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(row['sha1'])).decode()}"),
            ("WARC-Refers-To", row["refers_to_id"]),
            ("WARC-Profile", SAME_PAYLOAD if revisit else None),
            (PAGE_ID, None if row["page_id"] is None else str(row["page_id"])),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block))),
        ]
    )
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse_record(frame: bytes, at: int) -> tuple[dict, int]:
    """The record that begins at a place of a plain frame, and the place after it."""
    head_end = frame.index(b"\r\n\r\n", at)
    version, *lines = frame[at:head_end].split(b"\r\n")
    if version != VERSION:
        raise ValueError(f"no record at {at}: {version[:20]!r}")
    fields = dict(line.decode().split(": ", 1) for line in lines)
    start = head_end + 4
    end = start + int(fields["Content-Length"])
    record = {
        "record_id": fields["WARC-Record-ID"],
        "page_id": int(fields[PAGE_ID]) if PAGE_ID in fields else None,
        "target_uri": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to_id": fields.get("WARC-Refers-To"),
        "payload_digest": base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex(),
        "payload_bytes": None,
        "payload": None,
    }
    if record["record_type"] == "response":
        payload = frame[frame.index(b"\r\n\r\n", start) + 4 : end]
        if hashlib.sha1(payload).hexdigest() != record["payload_digest"]:
            raise ValueError(f"payload of {record['record_id']} does not have its digest")
        record |= {"payload_bytes": len(payload), "payload": payload}
    if frame[end : end + 4] != b"\r\n\r\n":
        raise ValueError(f"record {record['record_id']} does not end where its header says")
    return record, end + 4


def frame_records(frame: bytes) -> Iterator[dict]:
    at = 0
    while at < len(frame):
        record, at = parse_record(frame, at)
        yield record


class _Bundle:
    """A bundle being written: the open frame in memory, all before it on disk."""

    def __init__(self, fs, base: str):
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        # Frames are compressed here; the stream must not do it again because of the file's name.
        self.out = fs.open_output_stream(f"{base}/{self.name}", compression=None)
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.bytes = self.plain = 0
        self.open: list[bytes] = []

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset of the record."""
        place = (len(self.frames), self.plain)
        self.open.append(record)
        self.plain += len(record)
        if self.plain >= FRAME_BYTES:
            self.end_frame()
        return place

    def end_frame(self) -> None:
        if self.open:
            packed = self.compressor.compress(b"".join(self.open))
            self.out.write(packed)
            self.frames.append((len(packed), self.plain))
            self.bytes += len(packed)
            self.open, self.plain = [], 0

    def close(self) -> None:
        self.end_frame()
        self.out.write(seek_table(self.frames))
        self.out.close()


# --- Spark


def record_id(page_id: Column, sha256: Column) -> Column:
    """The name of a record follows from its page and payload, so that a revisit can name the
    record it revisits without looking it up."""
    name = F.sha2(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("-")), sha256), 256)
    part = lambda start, length: F.substr(name, F.lit(start), F.lit(length))
    return F.concat(
        F.lit("<urn:uuid:"),
        F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)),
        F.lit(">"),
    )


def with_roles(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """record_id, page_id, url, payload, sha1 and refers_to_id of every row.

    Of rows with equal payloads of at least `LEAST_SHARED` bytes those with the largest page_id
    are responses, the others are revisits (refers_to_id set, payload null). Groups are found by
    a digest, so payloads are not shuffled while the groups fit a broadcast.
    """
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("sha256", F.sha2("payload", 256))
    shared = saved(
        rows.where(F.length("payload") >= LEAST_SHARED)
        .groupBy(F.col("sha256").alias("same"))
        .agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 and target is not null")
        .select("same", "target"),
        "warc-copies",
    )
    revisits = F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target"))
    return rows.join(small_table(shared), F.col("sha256") == F.col("same"), "left").select(
        record_id(F.col("page_id"), F.col("sha256")).alias("record_id"),
        "page_id",
        "url",
        F.when(~revisits, F.col("payload")).alias("payload"),
        F.sha1("payload").alias("sha1"),
        F.when(revisits, record_id(F.col("target"), F.col("sha256"))).alias("refers_to_id"),
    )


def write(pages: DataFrame, folder: str, **columns: str) -> DataFrame:
    """Write a record for every row of `pages` into bundles under a folder; return the index.

    A null html is an empty payload, a null url leaves out its header line. Rows with a null
    page_id are written without one; they may revisit others, but a group of copies that all
    lack an id is written in full. Rows that repeat page_id and payload are written each, as
    records of one name. Long texts make long frames; a text must fit into a Spark string. An
    empty table gives an empty index and no bundle. Other columns are ignored.
    """
    spark = pages.sparkSession
    small_batches(spark)

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
             ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]
        )
        fs = out = None
        for batch in batches:
            if fs is None:
                fs, base = pafs.FileSystem.from_uri(folder)
                fs.create_dir(f"{base}/bundles", recursive=True)
            entries = []
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                if out is None:
                    out = _Bundle(fs, f"{base}/bundles")
                record = record_bytes(row)
                frame, offset = out.add(record)
                kind = "response" if row["refers_to_id"] is None else "revisit"
                entries.append(
                    (row["record_id"], row["page_id"], kind, out.name, frame, offset, len(record))
                )
                if out.bytes >= BUNDLE_BYTES:
                    out.close()
                    out = None
            columns = zip(*entries, strict=True) if entries else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )
        if out is not None:
            out.close()

    run = f"{folder}/index-{uuid.uuid4().hex}"
    written = with_roles(spread(pages), **columns).mapInArrow(bundle, INDEX)
    written.write.parquet(run)
    written = spark.read.schema(INDEX).parquet(run)
    written.groupBy("bundle").agg(
        (F.max("frame") + 1).alias("n_frames"), F.count(F.lit(1)).alias("n_records")
    ).write.parquet(f"{folder}/manifest")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    written.repartitionByRange(parts, "record_id").sortWithinPartitions("record_id").write.parquet(
        f"{folder}/index"
    )
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def _frames(folder: str, bundle: str, first: int, last: int) -> Iterator[bytes]:
    fs, base = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{base}/bundles/{bundle}") as source:
        table = read_seek_table(source)
        for start, compressed, plain in table[first:last]:
            packed = source.read_at(compressed, start)
            yield zstandard.ZstdDecompressor().decompress(packed, max_output_size=max(plain, 1))


def _record_batch(records: list[dict], payloads: bool) -> pa.RecordBatch:
    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    names = [part.split()[0] for part in RECORDS.split(", ")]
    names = names if payloads else names[:-1]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[name] for r in records], types.get(name, pa.string())) for name in names],
        names=names,
    )


def read_records(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """Every record of every bundle, read frame by frame and checked against its digest.

    A revisit has no payload and no payload_bytes of its own. Payloads are returned on demand.
    """
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = (
        spark.read.parquet(f"{folder}/manifest")
        .select("bundle", "n_frames", F.explode(F.expr(f"sequence(0, n_frames - 1, {READ_FRAMES})")).alias("first"))
        .repartition(parts, "bundle", "first")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in batch.to_pylist():
                for frame in _frames(folder, run["bundle"], run["first"], run["first"] + READ_FRAMES):
                    yield _record_batch(list(frame_records(frame)), payloads)

    schema = RECORDS if payloads else RECORDS.removesuffix(", payload binary")
    return runs.mapInArrow(read, schema)


def fetch(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """The records named by `wanted` (record_id), each read from its own frame alone."""
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = (
        read_index(spark, folder)
        .join(wanted.select("record_id").distinct(), "record_id", "left_semi")
        .repartition(parts, "bundle", "frame")
        .sortWithinPartitions("bundle", "frame", "offset")
        .select("bundle", "frame", "offset")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, frame = None, b""
        for batch in batches:
            for row in batch.to_pylist():
                if at != (row["bundle"], row["frame"]):
                    at = (row["bundle"], row["frame"])
                    (frame,) = _frames(folder, row["bundle"], row["frame"], row["frame"] + 1)
                yield _record_batch([parse_record(frame, row["offset"])[0]], True)

    return places.mapInArrow(read, RECORDS)


def resolved(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record.

    A revisit takes the size of its payload and the page it refers to from the response that it
    names. Any number of revisits may name one response: both sides of that join are written
    tables, so a hot response's rows can be split.
    """
    records = saved(records.drop("payload"), "warc-records")
    plain = records.where("record_type = 'response'")
    again = records.where("record_type = 'revisit'")
    named = saved(
        plain.select(
            F.col("record_id").alias("refers_to_id"),
            F.col("page_id").alias("refers_to"),
            F.col("payload_bytes").alias("bytes"),
        ).distinct(),
        "warc-responses",
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return plain.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(
        again.drop("payload_bytes")
        .join(named, "refers_to_id", "left")
        .withColumnRenamed("bytes", "payload_bytes")
        .select(*columns, "refers_to")
    )
