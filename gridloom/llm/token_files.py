"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

An id is replaced by its rank among all ids of the corpus by descending frequency, so that the most
frequent 256 ids take one byte. A block holds the control bytes (four 2-bit lengths each) apart
from the data bytes; the reader turns control bytes into lengths with one look-up in a table of 256
rows, lengths into offsets with one running sum, and gathers all ids of a block without a loop.

A file is a row of blocks, each followed by a line feed:

    magic `GLT1`, then little-endian unsigned 64-bit: file number, documents, ids, data bytes
    document keys (int64), key is null (uint8), ids per document (int64), control bytes, data bytes

Spark's text writer writes the blocks as they are, so files reach any file system that Spark can write,
under its commit protocol: a lost or repeated task leaves no half file. The table of ranks is a file of the
same kind beside them, bounded by the vocabulary.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import TEXT_AT_ONCE, sliced, written
from gridloom.llm.tokens import crc32, default_path, encoded, encoder
from gridloom.session import fresh_path

MAGIC = b"GLT1"
HEADER = struct.Struct("<4sQQQQ")
IDS_PER_BLOCK = 1 << 20
IDS_PER_FILE = 1 << 24
#: Row c: the four lengths that control byte c stands for.
LENGTHS = 1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values; the last control byte is filled up with zeros."""
    values = values.astype("<u4")
    length = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    used = np.arange(4) < length[:, None]
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = length - 1
    control = codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    return control.astype(np.uint8).tobytes(), values.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The `n` values that `pack` coded."""
    length = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    begin = np.cumsum(length) - length
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    values = raw[begin]
    for byte in (1, 2, 3):
        longer = np.flatnonzero(length > byte)
        values[longer] |= raw[begin[longer] + byte] << np.uint32(8 * byte)
    return values


def block(number: int, keys: list[int | None], sizes: list[int], ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    known = np.array([k or 0 for k in keys], "<i8").tobytes() + np.array([k is None for k in keys], np.uint8).tobytes()
    return HEADER.pack(MAGIC, number, len(keys), len(ranks), len(data)) + known + np.array(sizes, "<i8").tobytes() + control + data


def blocks(raw: bytes) -> Iterator[tuple[int, list[int | None], np.ndarray, np.ndarray]]:
    """(file number, keys, ids per document, ranks) of each block of a file."""
    at = 0
    while at < len(raw):
        magic, number, docs, ids, size = HEADER.unpack_from(raw, at)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at += HEADER.size
        keys = np.frombuffer(raw, "<i8", docs, at).tolist()
        nulls = np.frombuffer(raw, np.uint8, docs, at + 8 * docs)
        sizes = np.frombuffer(raw, "<i8", docs, at + 9 * docs)
        at += 17 * docs
        controls = -(-ids // 4)
        yield number, [None if x else k for k, x in zip(keys, nulls.tolist())], sizes, unpack(raw[at : at + controls], raw[at + controls : at + controls + size], ids)
        at += controls + size + 1


def token_table(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, n_ids): the ids of every row with the end id, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            ids = list(encoded(batch.column(1).to_pylist(), path))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64())], ["key", "ids", "n_ids"])

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, "key long, ids binary, n_ids long")


def id_counts(tokens: DataFrame, path: str) -> DataFrame:
    """(id, n) of all ids of the corpus; a task sends each id once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        total = np.zeros(tool.size, np.int64)
        for part in sliced(batches, 0, 8 * TEXT_AT_ONCE):
            total += np.bincount(np.frombuffer(b"".join(part.column(0).to_pylist()), tool.dtype), minlength=tool.size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def ranked_ids(tokens: DataFrame, path: str) -> np.ndarray:
    """Ids by descending frequency, ties by id; the vocabulary bounds them."""
    counts = [(row.id, row.n) for row in id_counts(tokens, path).collect()]
    return np.array([i for i, _ in sorted(counts, key=lambda x: (-x[1], x[0]))], np.int64)


def _write(frame: DataFrame, folder: str) -> None:
    frame.select(F.col("block").cast("string").alias("value")).write.option("lineSep", "\n").text(folder)


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, key: str = "doc_id", text: str = "text", ids_per_file: int = IDS_PER_FILE) -> None:
    """Encode every row of `docs` and write token files in ascending key order to `folder`.

    Null keys come first; rows with the same key stand in the order of their ids. A null text is empty and
    holds the end id alone. An empty table leaves a table of ranks and no documents.
    """
    path = path or default_path()
    spark = docs.sparkSession
    tokens = token_table(docs, path, key, text)
    stored = fresh_path(spark, "tokens")
    tokens.write.option("compression", "zstd").parquet(stored)
    tokens = spark.read.schema(tokens.schema).parquet(stored)
    order = ranked_ids(tokens, path)
    _write(spark.createDataFrame([(bytearray(block(0, [], [], order)),)], "block binary"), f"{folder}/ranks")
    total = tokens.agg(F.sum("n_ids")).first()[0] or 0
    rank_of = spark.sparkContext.broadcast(np.argsort(np.r_[order, np.setdiff1d(np.arange(encoder(path).size), order)]).astype(np.uint32))
    dtype = encoder(path).dtype

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ranks = TaskContext.get().partitionId(), rank_of.value
        keys, held, rows = [], [], 0
        for batch in batches:
            for one, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(raw.as_py(), dtype)
                keys.append(one)
                held.append(ids)
                rows += len(ids)
                if rows >= IDS_PER_BLOCK:
                    yield _block_row(number, keys, held, ranks)
                    keys, held, rows = [], [], 0
        if keys:
            yield _block_row(number, keys, held, ranks)

    files = max(1, -(-total // ids_per_file))
    _write(tokens.repartitionByRange(files, "key").sortWithinPartitions("key", "ids").select("key", "ids").mapInArrow(run, "block binary"), f"{folder}/ids")


def _block_row(number: int, keys: list, held: list[np.ndarray], ranks: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block(number, keys, [len(x) for x in held], ranks[np.concatenate(held)])], pa.binary())], ["block"])


def read_tokens(spark: SparkSession, folder: str, make, schema: str) -> DataFrame:
    """Rows that `make(file number, place in the file, key, ids)` gives for each document of the files in `folder`.

    Null and repeated keys come back as they were written; files without documents give no rows.
    """
    files = spark.read.format("binaryFile")
    order = next(ranks for _, _, _, ranks in blocks(files.load(f"{folder}/ranks/part-*").where("length > 0").first().content))
    ids_of = spark.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                place = 0
                for number, keys, sizes, ranks in blocks(raw.as_py()):
                    ids, rows = ids_of.value[ranks], []
                    for one, part in zip(keys, np.split(ids, np.cumsum(sizes)[:-1])):
                        rows.append(make(number, place, one, part))
                        place += 1
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    frame = spark.createDataFrame([], schema)
    arrow = to_arrow_schema(frame.schema)
    return files.load(f"{folder}/ids/part-*").where("length > 0").select("content").mapInArrow(run, frame.schema)


def document_digests(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document in the files, in the order of the files."""

    def make(number: int, place: int, one: int | None, ids: np.ndarray) -> dict:
        return {"number": number, "place": place, "key": one, "n_tokens": len(ids), "ids_crc32": crc32(ids)}

    read = written(read_tokens(spark, folder, make, "number long, place long, key long, n_tokens long, ids_crc32 long"), "digests")
    inside = F.sum("n_tokens").over(Window.partitionBy("number").orderBy("place")) - F.col("n_tokens")
    totals = read.groupBy("number").agg(F.sum("n_tokens").alias("total"))
    before = totals.select(F.col("number").alias("file"), (F.sum("total").over(Window.orderBy("number")) - F.col("total")).alias("before"))  # a row per file
    rows = read.withColumn("inside", inside).join(before, F.col("number") == F.col("file"))
    return rows.select(F.col("key").alias(key), (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write `docs` as token files in the shared folder, read them back, and return what the files hold."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "token-files")
    write_tokens(docs, folder, path, key, text)
    return document_digests(spark, folder, key)
