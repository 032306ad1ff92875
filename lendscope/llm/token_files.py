"""Token ids in flat binary files.

Layout of a folder, for each part of the ascending document order:

    <name>.ids   ids in a row, unsigned little-endian, 16 bits if all ids fit, else 32
    <name>.docs  document ids, signed 64-bit
    <name>.offs  n_docs + 1 offsets, unsigned 64-bit: ids of all documents before, in all parts
    manifest/    Parquet, one row for each part: names, counts and bases

Parts are written by the tasks that encode them, under a name of their own for every attempt,
so what a lost or doubled attempt leaves behind is never named by the manifest. Part totals
give the bases by prefix sums; a second, light pass writes the offsets. Readers map the files
into memory where the folder is a mounted one, and read the same bytes through the file
system's own client elsewhere.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm.common import running_bases, small_batches
from lendscope.llm.word_ids import encoder, slices

#: Ids written or documents read back at once.
READ_DOCS = 20_000


def _connect(folder: str):
    return pafs.FileSystem.from_uri(folder)


def _array(fs, path: str, dtype: str) -> np.ndarray:
    """A file as an array: mapped where it is a local or mounted file, else read."""
    info = fs.get_file_info(path)
    if info.size == 0:
        return np.zeros(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r")
    with fs.open_input_file(path) as source:
        return np.frombuffer(source.read(), dtype)


def write(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int | None = None,
    id_bits: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write all documents in ascending order of their id and return the manifest.

    A null text is empty and still gets the end id. Null ids come first; repeated ids are
    ordered by text. An empty table gives an empty manifest. Other columns are ignored.
    An id that needs more than `id_bits` stops the job.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_type = {16: "<u2", 32: "<u4"}[id_bits]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, fs = uuid.uuid4().hex, None
        n_docs = n_null = n_ids = 0
        for batch in batches:
            if fs is None:
                fs, base = _connect(folder)
                fs.create_dir(base, recursive=True)
                out_ids, out_docs, out_lengths = (
                    fs.open_output_stream(f"{base}/{name}.{kind}")
                    for kind in ("ids", "docs", "lens")
                )
            keys = batch.column(0)
            n_null += keys.null_count
            out_docs.write(np.asarray(keys.fill_null(0), "<i8").tobytes())
            for _, texts in slices(batch.column(1).to_pylist()):
                ids, counts = encoder(tokenizer_path).encode(texts)
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(counts), end_id)
                    counts = counts + 1
                if len(ids) and int(ids.max()) >> id_bits:
                    raise ValueError(f"id {int(ids.max())} needs more than {id_bits} bits")
                out_ids.write(ids.astype(id_type).tobytes())
                out_lengths.write(counts.astype("<i8").tobytes())
                n_ids += len(ids)
            n_docs += batch.num_rows
        if fs is None:
            return
        for out in (out_ids, out_docs, out_lengths):
            out.close()
        from pyspark import TaskContext

        row = {
            "part": [TaskContext.get().partitionId()],
            "name": [name],
            "n_docs": [n_docs],
            "n_null": [n_null],
            "n_ids": [n_ids],
        }
        yield pa.RecordBatch.from_pydict(row)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("words")
    )
    written = (
        rows.repartitionByRange(parts, "key")
        .sortWithinPartitions("key", "words")
        .mapInArrow(encode, "part long, name string, n_docs long, n_null long, n_ids long")
    )
    run = f"{folder}/parts-{uuid.uuid4().hex}"
    written.write.parquet(run)
    written = spark.read.schema(written.schema).parquet(run)

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fs, base = _connect(folder)
            for row in batch.to_pylist():
                lengths = _array(fs, f"{base}/{row['name']}.lens", "<i8")
                places = np.concatenate([[0], np.cumsum(lengths)]) + row["base_ids"]
                # The same bytes on every attempt, so repeating it does no harm.
                with fs.open_output_stream(f"{base}/{row['name']}.offs") as out:
                    out.write(places.astype("<u8").tobytes())
            yield batch

    # One row for each part.
    bases = running_bases(written, "part", {"base_docs": "n_docs", "base_ids": "n_ids"})
    manifest = written.join(F.broadcast(bases), "part").withColumn("id_bits", F.lit(id_bits))
    manifest.repartition(parts).mapInArrow(offsets, manifest.schema).write.parquet(
        f"{folder}/manifest"
    )
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest")


def _documents(folder: str, row: dict) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Runs of documents of one part: keys, absolute offsets, and the ids between them."""
    fs, base = _connect(folder)
    path = f"{base}/{row['name']}"
    keys = _array(fs, f"{path}.docs", "<i8")
    places = _array(fs, f"{path}.offs", "<u8").astype(np.int64)
    ids = _array(fs, f"{path}.ids", {16: "<u2", 32: "<u4"}[row["id_bits"]])
    for start in range(0, row["n_docs"], READ_DOCS):
        end = min(start + READ_DOCS, row["n_docs"])
        run = keys[start:end].tolist()
        nulls = min(max(0, row["n_null"] - start), len(run))
        run[:nulls] = [None] * nulls
        yield run, places[start : end + 1], ids[places[start] - places[0] : places[end] - places[0]]


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start and the ids of every document, read back from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for keys, places, ids in _documents(folder, row):
                    lists = pa.ListArray.from_arrays(
                        (places - places[0]).astype(np.int32), ids.astype(np.int32)
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array(places[:-1]), lists],
                        names=["doc_id", "start", "ids"],
                    )

    return _by_part(spark, folder).mapInArrow(read, "doc_id long, start long, ids array<int>")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and the checksum of the ids (as 32-bit integers) of every
    document, read back from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for keys, places, ids in _documents(folder, row):
                    raw = ids.astype("<u4").tobytes()
                    cuts = (4 * (places - places[0])).tolist()
                    sums = [zlib.crc32(raw[b:e]) for b, e in zip(cuts, cuts[1:], strict=False)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys, pa.int64()),
                            pa.array(places[:-1]),
                            pa.array(np.diff(places)),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return _by_part(spark, folder).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _by_part(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with its few rows dealt out, so that parts are read side by side."""
    return read_manifest(spark, folder).repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
