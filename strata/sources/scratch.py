"""Tables in the folder that the cluster shares: they cut lineage, and a lost executor costs no more than its own tasks."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir). Only a session in one process may go without it, as in tests: no folder of one machine stands in for a shared one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*)?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        root = f"file://{tempfile.gettempdir()}/strata-scratch"
    return root.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again."""
    path = f"{scratch_root(df.sparkSession)}/strata-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._strata_path = path
    return out


def drop_table(df: DataFrame) -> None:
    """Delete a table of materialize() that no plan reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._strata_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
