"""Helpers that the operators share: scratch tables, schemas of batches, exact ids."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import drop_table, materialize, scratch_root

__all__ = ["SMALL_ROWS", "blank_if_null", "documents", "drop_table", "materialize", "partitions_for", "scratch_root", "small", "worker_memo"]


_MEMO: dict[str, Any] = {}


def worker_memo(name: str, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps over batches and tasks: of the operator at work only. The memo of another one is let go, so that a worker that serves many never holds more than one."""
    if name not in _MEMO:
        _MEMO.clear()
        _MEMO[name] = make()
    return _MEMO[name]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions_for(rows: int, per_partition: int) -> int:
    return max(1, -(-rows // per_partition))


def blank_if_null(column: str):
    return F.coalesce(F.col(column), F.lit(""))


#: rows of a few longs that may be broadcast (64 MB at most)
SMALL_ROWS = 2_000_000


def small(df: DataFrame, longs: int = 4) -> DataFrame:
    """df, rows of about that many longs, with a broadcast hint where its counted rows stay below a fixed bound; as it is beyond, where Spark shuffles."""
    return F.broadcast(df) if df.count() * max(longs, 4) <= 4 * SMALL_ROWS else df
