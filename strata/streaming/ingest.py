"""Incremental ingest: new report texts are parsed as they arrive and appended to the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.reports import CHILDREN, parse_reports


def stream_reports(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Parquet files (pdf_path, text: normalized) in source go to target/reports and target/<child>, once each: the parsed batch is written per epoch under its own folder, so a repeated epoch replaces itself."""

    def load(batch: DataFrame, epoch: int) -> None:
        parsed = parse_reports(batch).persist()
        parsed.drop("text", *CHILDREN).write.mode("overwrite").parquet(f"{target}/reports/epoch={epoch}")
        for name, (_, place, _) in CHILDREN.items():
            parsed.selectExpr("pdf_path", "well_family", f"posexplode({name}) as ({place}, r)").select("pdf_path", "well_family", place, "r.*").write.mode("overwrite").parquet(f"{target}/{name}/epoch={epoch}")
        parsed.unpersist()

    stream = spark.readStream.schema("pdf_path string, text string").parquet(source)
    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
