"""Token ids as length-delimited binary records with a separate offset index.

Record: length (u64, little-endian), masked crc32 of those 8 bytes (u32), the
payload, masked crc32 of the payload (u32).  The mask rotates the checksum by
15 bits and adds a constant, so a checksum stored over data that itself holds
checksums stays strong.  Payload: ids as u16 when the vocabulary allows it,
else u32.  One file per shard and attempt (``part-00000-<attempt>.rec``); shards and the records in
them follow the key.  The index (Parquet under ``index``) has one row per
record: key, shard, file, byte offset, payload length, ids before it in its shard;
any order of its rows is a shuffled read.  Spark commits the index of one attempt of each task, so
a file that a lost or repeated task left behind is never read; nothing is renamed.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimlake.llm import common
from claimlake.llm.encoding import encoder
from claimlake.session import arrow_bytes

MASK_DELTA = 0xA282EAD8  # fixed value of the masking rule
HEAD, TAIL = 12, 4
BATCH_BYTES = 4 << 20  # texts or ids that a task holds at once; a longer record is a batch of its own
INDEX = "doc_id bigint, shard int, file string, offset bigint, length bigint, first bigint, n_tokens bigint, width int"


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = len(payload).to_bytes(8, "little")
    return b"".join((head, masked_crc(head).to_bytes(4, "little"), payload, masked_crc(payload).to_bytes(4, "little")))


def unframe(record: bytes) -> bytes:
    """The payload of one framed record; raises if a checksum or the length is off."""
    n = int.from_bytes(record[:8], "little")
    if masked_crc(record[:8]) != int.from_bytes(record[8:12], "little"):
        raise ValueError("record length is damaged")
    payload = record[HEAD:HEAD + n]
    if len(payload) != n or masked_crc(payload) != int.from_bytes(record[HEAD + n:HEAD + n + TAIL], "little"):
        raise ValueError("record payload is damaged")
    return payload


def shard_name(shard: int) -> str:
    return f"part-{shard:05d}-{uuid.uuid4().hex}.rec"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store that Spark names so, as Arrow names it."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def _write(uri: str, tokenizer_path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard = encoder(tokenizer_path), TaskContext.get().partitionId()
        fs, root = file_system(uri)
        tail = np.array([end_id], dtype=enc.width).tobytes()
        name, offset, first, out = shard_name(shard), 0, 0, None
        names = [c.split()[0] for c in INDEX.split(", ")]
        kinds = (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
        try:
            for b in batches:
                rows = []
                for key, ids in zip(b.column("doc_id").to_pylist(), enc.encode(b.column("text"))):
                    payload = ids + tail
                    if out is None:
                        out = fs.open_output_stream(f"{root}/{name}")
                    out.write(frame(payload))
                    n = len(payload) // enc.width.itemsize
                    rows.append((key, shard, name, offset, len(payload), first, n, enc.width.itemsize))
                    offset += HEAD + len(payload) + TAIL
                    first += n
                cols = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
        finally:
            if out is not None:
                out.close()
    return run


def write_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0) -> None:
    """Encode ``doc_id, text`` and write records and index under ``path`` (a shared folder).

    Rows are dealt by ranges of doc_id and sorted, so shards are in ascending
    order; null doc_ids come first, equal ones follow their text (null and
    empty first), null texts hold the end id alone.  No rows: an empty index and no shard.
    """
    fs, root = file_system(path)
    fs.create_dir(root, recursive=True)
    n = common.shuffle_width(docs.sparkSession)
    # a batch of texts is held by the JVM and by Python several times over, so it is bounded by bytes
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    with arrow_bytes(docs.sparkSession, BATCH_BYTES):
        rows.mapInArrow(_write(path, tokenizer_path, end_id), INDEX).write.mode("overwrite").parquet(f"{path}/index")


def read_index(spark, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def _with_ids(rows: pa.RecordBatch, ids: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(ids, pa.binary())], [*rows.schema.names, "ids"])


def _read(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(uri)
        at, f = None, None
        for b in batches:
            ids, done, held = [], 0, 0
            for name, offset, length, width in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length", "width"))):
                if ids and held + length // width * 4 > BATCH_BYTES:
                    yield _with_ids(b.slice(done, len(ids)), ids)
                    ids, done, held = [], done + len(ids), 0
                if name != at:
                    if f is not None:
                        f.close()
                    at, f = name, fs.open_input_file(f"{root}/{name}")
                payload = unframe(f.read_at(HEAD + length + TAIL, offset))
                ids.append(np.frombuffer(payload, dtype=f"<u{width}").astype("<u4").tobytes())
                held += len(ids[-1])
            yield _with_ids(b.slice(done), ids)
        if f is not None:
            f.close()
    return run


def read_records(index: DataFrame, path: str) -> DataFrame:
    """The records that ``index`` lists, in its order, with ``ids`` (little-endian u32); checks both checksums."""
    return index.mapInArrow(_read(path), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in index.schema) + ", ids binary")


def with_start(index: DataFrame) -> DataFrame:
    """Adds ``start``: ids of all records before it. One row per shard is summed up, never the records."""
    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("__n"))
    before = shards.select("shard", (F.coalesce(F.sum("__n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("__before"))
    return index.join(before, "shard").withColumn("start", F.col("__before") + F.col("first")).drop("__before")
