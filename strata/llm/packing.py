"""Packing of documents into sequences by large-item matching (operator 2).

Only how many pieces there are of each length matters to a packing, and there
are `capacity` lengths at most. So the lengths' counts are packed on the driver,
with multiplicities, and the pieces then find their places by their rank among
the pieces of their length:

* pieces above a third of the capacity share a sequence two at most: from the
  largest on, each is matched with the largest that still fits;
* the smaller ones, from the largest on, go where the least space is left that
  holds them (best fit); new sequences are opened only where none has room.

Cases: null text counts as empty (its end id alone); an empty table gives no
piece; equal rows are packed each; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions_for
from .wordbpe import SLOTS, encoder

CAPACITY = 2048
#: pieces of one length that one task ranks
RANKED = 20_000


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int | None = 0, with_ids: bool = False, memo: int = SLOTS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): documents longer than the capacity are cut, the others are one piece. memo: slots of a worker's table of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, memo)
        end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        for b in batches:
            rows: list[tuple] = []
            for d, raw in zip(b.column(0).to_pylist(), enc.encode_many([t or "" for t in b.column(1).to_pylist()]), strict=True):
                raw += end
                for k, s in enumerate(range(0, len(raw), 4 * capacity)):
                    x = raw[s : s + 4 * capacity]
                    rows.append((d, k, s // 4, len(x) // 4, zlib.crc32(x), x) if with_ids else (d, k, s // 4, len(x) // 4, zlib.crc32(x)))
            cols = list(zip(*rows, strict=True)) or [[]] * (5 + with_ids)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=False)], names[: len(cols)])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Placements (length, first rank, pieces, first sequence, pieces a sequence, offset): piece `first rank + i` of the length goes to sequence `first sequence + i // k` at `offset + (i % k) * length`."""
    left = {n: c for n, c in counts.items() if c and n}
    used: dict[int, int] = dict.fromkeys(left, 0)
    out: list[tuple[int, int, int, int, int, int]] = []
    bins = 0
    #: (first sequence, sequences) by the space left in each
    room: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []

    def leave(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in room:
                room[space] = []
                bisect.insort(spaces, space)
            room[space].append((first, n))

    def place(length: int, n: int, first: int, k: int, offset: int) -> None:
        out.append((length, used[length], n, first, k, offset))
        used[length] += n
        left[length] -= n

    large = sorted(n for n in left if 3 * n > capacity)
    for a in reversed(large):
        while left[a]:
            i = bisect.bisect_right(large, capacity - a) - 1
            while i >= 0 and (not left[large[i]] or (large[i] == a and left[a] < 2)):
                i -= 1
            if i < 0:
                n = left[a]
                place(a, n, bins, 1, 0)
                leave(capacity - a, bins, n)
                bins += n
                break
            b = large[i]
            if a == b:
                n = left[a] // 2
                place(a, 2 * n, bins, 2, 0)
            else:
                n = min(left[a], left[b])
                place(a, n, bins, 1, 0)
                place(b, n, bins, 1, a)
            leave(capacity - a - b, bins, n)
            bins += n

    for s in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[s]:
            i = bisect.bisect_left(spaces, s)
            if i < len(spaces):
                space = spaces[i]
                first, n = room[space].pop()
                if not room[space]:
                    del room[space], spaces[i]
            else:
                space, first, n = capacity, bins, -(-left[s] // (capacity // s))
                bins += n
            k = space // s
            full = min(n, left[s] // k)
            if full:
                place(s, full * k, first, k, capacity - space)
                leave(space - k * s, first, full)
            if full < n:
                part = left[s]  # fewer than k
                if part:
                    place(s, part, first + full, part, capacity - space)
                    leave(space - part * s, first + full, 1)
                leave(space, first + full + bool(part), n - full - bool(part))
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32, ...), which must be a written table: it is read twice."""
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    table = np.array(sorted(plan_bins(counts, capacity)), np.int64).reshape(-1, 6)
    parts = partitions_for(sum(counts.values()), RANKED)
    dealt = pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy("length", "_part").agg(F.count("*").alias("_n")).select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inner = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("_row", F.row_number().over(inner) - 1).join(first, ["length", "_part"]).withColumn("_rank", F.col("_first") + F.col("_row")).drop("_part", "_row", "_first")
    names = pieces.columns

    def run(batches):
        keys = (table[:, 0] << 44) + table[:, 1]
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "_rank"))
            row = table[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            i, k = rank - row[:, 1], np.maximum(1, row[:, 4])
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in names), pa.array(row[:, 3] + i // k, pa.int64()), pa.array(row[:, 5] + i % k * length, pa.int64())], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int | None = 0, with_ids: bool = False, memo: int = SLOTS) -> DataFrame:
    """All pieces of docs with their sequence and place; with_ids adds each piece's ids as bytes."""
    return pack(materialize(cut_pieces(docs, tokenizer, capacity, end_id, with_ids, memo), "pieces"), capacity)
