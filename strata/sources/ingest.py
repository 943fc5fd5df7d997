"""Batch ingest: report files to tables, with a quarantine for what cannot be read or loaded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.mining import table_counts
from ..operators.reports import CHILDREN, child_table, parse_reports
from .files import decode_reports, no_decoder, write_table
from .scratch import drop_table, materialize


def ingest(spark: SparkSession, files: DataFrame, target: str, decode: Callable[[bytes], list[str]] = no_decoder) -> DataFrame:
    """files (path, content) to target/reports, target/<child> and target/parse_errors, each replaced as a whole; (table_name, n) of what was written.

    A file that cannot be decoded is an error of stage parse, a path that was
    loaded already one of stage load; neither stops the run. Texts are decoded
    once and parsed once, into a scratch table that all tables are written from.
    """
    good, unread = decode_reports(files, decode)
    texts = materialize(good.withColumn("_again", F.row_number().over(Window.partitionBy("pdf_path").orderBy("text")) > 1), "texts")
    twice = texts.where("_again").select("pdf_path", F.lit("load").alias("stage"), F.concat(F.lit("ConstraintException: duplicate key pdf_path "), F.col("pdf_path")).alias("error_message"), F.current_timestamp().cast("timestamp_ntz").alias("occurred_at"))
    parsed = materialize(parse_reports(texts.where("not _again").select("pdf_path", "text")).drop("text"), "parsed")
    write_table(parsed.drop(*CHILDREN).withColumn("ingested_at", F.current_timestamp().cast("timestamp_ntz")), f"{target}/reports")
    for name in CHILDREN:
        write_table(child_table(parsed, name), f"{target}/{name}")
    write_table(unread.unionByName(twice), f"{target}/parse_errors")
    drop_table(texts)
    drop_table(parsed)
    return table_counts({n: spark.read.parquet(f"{target}/{n}") for n in ("reports", *CHILDREN, "parse_errors")})
