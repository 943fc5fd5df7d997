"""Token ids as compressed binary blocks (operator 1).

Two passes over the ids: the first encodes each whole text and counts ids, the
second writes blocks in ascending doc_id order with one shared table of
frequencies (rans.py). The format is a table `blocks` (shard, block, n_docs,
n_tokens, doc_ids, lengths, payload) and a table `table` of one row. Spark's own
writer commits it, so a lost executor leaves no half of a file, and any store
that Spark can write to holds it. Shards are ranges of doc_id: shard, then
block, then place in the block is the order of the documents.

Cases: null text is encoded as the empty text (one end id); a null doc_id comes
before all others; rows of equal doc_id follow one another, the shorter first;
an empty table gives no block; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_table, materialize, partitions_for, scratch_root
from .rans import Block, Table, encode_block
from .wordbpe import encoder

#: ids of a block, and of a range of doc_id that one task writes
BLOCK, SHARD = 1 << 20, 1 << 23


def encode_ids(docs: DataFrame, tokenizer: str, end_id: int | None = None) -> DataFrame:
    """(doc_id, n, ids): the ids of each whole text, deflated little-endian unsigned integers of 16 bits if all ids fit, else 32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        enc = encoder(tokenizer)
        small = len(enc.tokens) <= 1 << 16
        press = zstandard.ZstdCompressor(level=1, write_content_size=True)
        end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        for b in batches:
            ids, n = [], []
            for raw in enc.encode_many([t or "" for t in b.column(1).to_pylist()]):
                x = np.frombuffer(raw + end, "<u4")
                n.append(len(x))
                ids.append(press.compress(x.astype("<u2").tobytes() if small else x.tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array([2 if small else 4] * len(n), pa.int32())], ["doc_id", "n", "ids", "width"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, ids binary, width int")


def unpack(raw: bytes, width: int) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), f"<u{width}").astype(np.uint32)


def count_ids(ids: DataFrame) -> dict[int, int]:
    """How often each id occurs in all documents; a row for each id of the vocabulary at most reaches the driver."""

    def run(batches):
        total = np.zeros(1, np.int64)
        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            for k in range(0, len(rows), 1000):  # a count over the vocabulary for many documents at once
                c = np.bincount(np.concatenate([unpack(*r) for r in rows[k : k + 1000]]))
                if len(c) > len(total):
                    total = np.concatenate([total, np.zeros(len(c) - len(total), np.int64)])
                total[: len(c)] += c
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])

    rows = ids.select("ids", "width").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    return {r.id: r.n for r in rows}


def write_blocks(ids: DataFrame, path: str, block: int = BLOCK, shard: int = SHARD) -> None:
    """Write the format described above at path."""
    spark = ids.sparkSession
    counts = count_ids(ids)
    flat = np.zeros(max(counts, default=0) + 1, np.int64)
    flat[list(counts)] = list(counts.values())
    raw = Table.of(flat).to_bytes()
    spark.createDataFrame([(bytearray(raw),)], "frequencies binary").coalesce(1).write.parquet(f"{path}/table")

    def run(batches):
        from pyspark import TaskContext

        table, place = Table.from_bytes(raw), TaskContext.get().partitionId()
        docs, lengths, parts, size, at = [], [], [], 0, 0

        def flush():
            null = np.array([d is None for d in docs], bool)
            keys = np.array([d or 0 for d in docs], "<i8")
            payload = encode_block(np.concatenate(parts), table)
            return pa.RecordBatch.from_pydict({"shard": pa.array([place], pa.int64()), "block": pa.array([at], pa.int64()), "n_docs": pa.array([len(docs)], pa.int64()), "n_tokens": pa.array([size], pa.int64()), "doc_ids": pa.array([null.tobytes() + keys.tobytes()], pa.binary()), "lengths": pa.array([np.array(lengths, "<i8").tobytes()], pa.binary()), "payload": pa.array([payload], pa.binary())})

        for b in batches:
            for d, n, x, w in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                docs.append(d)
                lengths.append(n)
                parts.append(unpack(x, w))
                size += n
                if size >= block:
                    yield flush()
                    docs, lengths, parts, size, at = [], [], [], 0, at + 1
        if docs:
            yield flush()

    n = partitions_for(sum(counts.values()), shard)
    (ids.select("doc_id", "n", "ids", "width").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "n")
     .mapInArrow(run, "shard long, block long, n_docs long, n_tokens long, doc_ids binary, lengths binary, payload binary")
     .write.option("compression", "none").parquet(f"{path}/blocks"))


def read_blocks(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of the files at path; start counts the ids of all documents before."""
    raw = bytes(spark.read.parquet(f"{path}/table").first()[0])
    blocks = spark.read.parquet(f"{path}/blocks")

    def run(batches):
        table = Table.from_bytes(raw)
        for b in batches:
            for shard, block, n, keys, lengths, payload in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                ids = Block(payload, table).ids().astype("<u4")
                null, keys, lengths = np.frombuffer(keys, bool, n), np.frombuffer(keys, "<i8", n, n), np.frombuffer(lengths, "<i8")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                cut = [ids[s:e].tobytes() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                cols = [pa.array([shard] * n, pa.int64()), pa.array([block] * n, pa.int64()), pa.array(keys, mask=null), pa.array(starts), pa.array(lengths), pa.array([zlib.crc32(c) for c in cut], pa.int64())]
                names = ["shard", "block", "doc_id", "within", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(cut, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    docs = blocks.select("shard", "block", "n_docs", "doc_ids", "lengths", "payload").mapInArrow(run, "shard long, block long, doc_id long, within long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("t"))
    shards = shards.select("shard", F.coalesce(F.sum("t").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    first = blocks.select("shard", "block", F.coalesce(F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("inner"))
    at = first.join(shards, "shard").select("shard", "block", (F.col("base") + F.col("inner")).alias("base"))
    return docs.join(at, ["shard", "block"]).select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def token_output(docs: DataFrame, tokenizer: str, end_id: int | None = 0, path: str | None = None) -> tuple[str, DataFrame]:
    """Write all ids of docs at path (a new folder in the shared one if None); the path, and the documents as read back from the files."""
    spark = docs.sparkSession
    path = path or f"{scratch_root(spark)}/strata-tokens-{uuid.uuid4().hex}"
    ids = materialize(encode_ids(docs, tokenizer, end_id), "ids")
    write_blocks(ids, path)
    drop_table(ids)
    return path, read_blocks(spark, path, with_ids=False)
