"""Sharding along a Hilbert curve over several metadata columns (operator 4).

Each column is quantised to 2**BITS cells of about equal depth (numbers by
approximate quantiles over all rows; whole strings by the number of rows with a
smaller value, counted over the distinct values). The cells are coordinates of a Hilbert curve; rows are sorted by their
place on it, ties by the text's checksum and doc_id, and the order is cut into
runs whose row counts differ by one at most. Near rows on the curve are near in
every column, so files of a shard have narrow ranges in all of them.

Only DataFrame functions are used. The sort is by range with doc_id last, so
rows with equal metadata, or equal texts, are spread over tasks.

Cases: null text has no bytes (size 8) and checksum 0; nulls in a metadata column
take the first cell; a null doc_id sorts first; equal rows take places one after
another; an empty table has no rows; other columns are
not read, save by write_shards, which writes them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_table, materialize, partitions_for, small

BITS = 6
#: rows that one task sorts
SORTED = 250_000


def cell_bounds(df: DataFrame, columns: list[str], bits: int = BITS) -> dict[str, list[int]]:
    """Cut points of each (long) column: 2**bits - 1 values a column at most."""
    at = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(c, at, 10_000).alias(c) for c in columns]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def cell(column: str, bounds: list[int]):
    """How many of the cut points lie below the value; null: none."""
    if not bounds:
        return F.lit(0)
    return F.when(F.col(column).isNull(), F.lit(0)).otherwise(F.size(F.filter(F.array(*[F.lit(v).cast("long") for v in bounds]), lambda v: v < F.col(column))))


def string_cells(df: DataFrame, column: str, name: str, bits: int = BITS) -> DataFrame | None:
    """(column, name): the cell of each distinct value, from the number of rows that have a smaller one; None where all are null."""
    counts = materialize(df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n")), "shard-counts")
    ranged = materialize(counts.repartitionByRange(partitions_for(counts.count(), SORTED), column).withColumn("_part", F.spark_partition_id()), "shard-values")
    earlier = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = ranged.agg(F.sum("_n")).first()[0]
    if n is None:
        return None
    # one row a task of the sort
    first = ranged.groupBy("_part").agg(F.sum("_n").alias("_n")).select("_part", earlier(Window.orderBy("_part")).alias("_first"))
    before = F.col("_first") + F.col("_within")
    values = ranged.withColumn("_within", earlier(Window.partitionBy("_part").orderBy(column))).join(F.broadcast(first), "_part")
    return materialize(values.withColumn("_before", before).select(column, F.expr(f"(_before * {1 << bits}L) div {n}L").alias(name)), "shard-cells")


def hilbert_index(df: DataFrame, coordinates: list[str], bits: int, name: str) -> DataFrame:
    """Adds the Hilbert index of integer coordinates in [0, 2**bits): the transposed form after Skilling, bit by bit."""
    x = [f"_x{i}" for i in range(len(coordinates))]
    df = df.withColumns({a: F.col(c).cast("long") for a, c in zip(x, coordinates, strict=True)})
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for a in x:
            on = F.col(a).bitwiseAND(F.lit(q)) != 0
            swap = F.col(x[0]).bitwiseXOR(F.col(a)).bitwiseAND(F.lit(low))
            first = F.when(on, F.col(x[0]).bitwiseXOR(F.lit(low))).otherwise(F.col(x[0]).bitwiseXOR(swap))
            df = df.withColumns({x[0]: first} if a == x[0] else {x[0]: first, a: F.when(on, F.col(a)).otherwise(F.col(a).bitwiseXOR(swap))})
    for a, before in zip(x[1:], x, strict=False):
        df = df.withColumn(a, F.col(a).bitwiseXOR(F.col(before)))
    turn = F.lit(0).cast("long")
    for b in range(bits - 1, 0, -1):
        turn = turn.bitwiseXOR(F.when(F.col(x[-1]).bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)))
    df = df.withColumn("_turn", turn)
    index = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for a in x:
            index = F.shiftleft(index, 1).bitwiseOR(F.shiftright(F.col(a).bitwiseXOR(F.col("_turn")), b).bitwiseAND(F.lit(1)))
    return df.withColumn(name, index).drop(*x, "_turn")


def shard(docs: DataFrame, shards: int = 24, dimensions: tuple[str, ...] = ("source", "lang", "size"), bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, hilbert) of every row."""
    return _placed(docs, shards, dimensions, bits, [])


def _placed(docs: DataFrame, shards: int, dimensions: tuple[str, ...], bits: int, keep: list[str]) -> DataFrame:
    """The rows of shard(), and the columns of keep."""
    text = F.col("text")
    base = docs.withColumn("size", F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8)
    keys, kinds = [f"_k{i}" for i in range(len(dimensions))], dict(base.dtypes)
    slim = materialize(base.select(F.col("doc_id").cast("long").alias("doc_id"), "size", F.coalesce(F.crc32(F.encode(text, "utf-8")), F.lit(0)).cast("long").alias("text_crc32"), *[(F.col(c) if kinds[c] == "string" else F.col(c).cast("long")).alias(k) for c, k in zip(dimensions, keys, strict=True)], *keep), "shard-rows")
    numbers = [k for c, k in zip(dimensions, keys, strict=True) if kinds[c] != "string"]
    bounds = cell_bounds(slim, numbers, bits) if numbers else {}
    cells = slim.withColumns({k: cell(k, bounds[k]) for k in numbers})
    for k in keys:
        if k not in numbers:
            of = string_cells(slim, k, "_cell", bits)
            cells = cells.withColumn(k, F.lit(0)) if of is None else cells.join(small(of, 16), k, "left").withColumn(k, F.coalesce("_cell", F.lit(0))).drop("_cell")
    # as a table: constant cells would be folded through all steps of the curve
    curve = hilbert_index(materialize(cells, "shard-coordinates"), keys, bits, "hilbert").drop(*keys)
    n = slim.count()
    order = ["hilbert", "text_crc32", "doc_id"]
    ranged = curve.repartitionByRange(partitions_for(n, SORTED), *order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "shard-order")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    rank = F.col("_first") + F.col("_row")
    # shard s holds the ranks from ceil(s * n / shards) on
    number = F.expr(f"((_first + _row) * {shards}L) div {max(n, 1)}L")
    start = F.expr(f"(_shard * {max(n, 1)}L + {shards - 1}L) div {shards}L")
    # one row a task of the sort: bounded by the number of tasks
    out = placed.join(F.broadcast(first), "_part").withColumn("_shard", number).withColumn("slot", rank - start)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "hilbert", *keep)


def write_shards(docs: DataFrame, path: str, shards: int = 24, dimensions: tuple[str, ...] = ("source", "lang", "size"), bits: int = BITS) -> None:
    """All columns of the documents with their places (columns of shard() take the place of equally named ones, save doc_id) as Parquet, a folder for each shard, in the order of the curve. As doc_ids may recur, rows are numbered and kept in a scratch table."""
    rows = materialize(docs.withColumn("_row_id", F.monotonically_increasing_id()), "shard-documents")
    placed = _placed(rows, shards, dimensions, bits, ["_row_id"]).drop("doc_id")
    whole = rows.drop(*[c for c in placed.columns if c != "_row_id"]).join(placed, "_row_id").drop("_row_id")
    whole.repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    drop_table(rows)
