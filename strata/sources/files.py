"""Sources and sinks: report files, event sheets, index tables, deliverables."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import normalize_report


def report_files(spark: SparkSession, root: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, content) of the files of one folder; a sort on path gives the listing's order."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(root).select("path", "content")


def no_decoder(content: bytes) -> list[str]:
    raise RuntimeError("no document decoder is installed: give decode_reports() a function from bytes to the texts of the pages")


def plain_text(content: bytes) -> list[str]:
    """Files that hold text already, pages parted by a form feed."""
    return content.decode("utf-8", "replace").split("\f")


def decode_reports(files: DataFrame, decode: Callable[[bytes], list[str]] = no_decoder) -> tuple[DataFrame, DataFrame]:
    """Normalized texts (pdf_path, text), page texts joined by a blank line; and the quarantine (pdf_path, stage, error_message, occurred_at) of files that cannot be decoded. A bad file never stops the load."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    rows.append((path, "\n\n".join(decode(bytes(content))), None))
                except Exception as e:  # noqa: BLE001  whatever a decoder raises goes to the quarantine
                    rows.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["pdf_path", "raw", "error"])

    got = files.select("path", "content").mapInPandas(run, "pdf_path string, raw string, error string")
    good = got.where("error is null").select("pdf_path", normalize_report(F.col("raw")).alias("text"))
    bad = got.where("error is not null").select("pdf_path", F.lit("parse").alias("stage"), F.col("error").alias("error_message"), F.current_timestamp().cast("timestamp_ntz").alias("occurred_at"))
    return good, bad


def sheet_rows(content: bytes) -> list[list[str | None]]:
    """Cells of the first sheet of an xlsx file as text, rows from the top."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        sheet = ElementTree.fromstring(z.read(sorted(n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))[0]))
    out = []
    for row in sheet.iter(f"{{{ns['m']}}}row"):
        cells: list[str | None] = []
        for c in row.findall("m:c", ns):
            letters = re.match("[A-Z]+", c.get("r", "A"))[0]
            place = 0
            for ch in letters:
                place = place * 26 + ord(ch) - 64
            v = c.find("m:v", ns)
            text = "".join(t.text or "" for t in c.iter(f"{{{ns['m']}}}t")) if c.get("t") == "inlineStr" else None if v is None else shared[int(v.text)] if c.get("t") == "s" else v.text
            cells += [None] * (place - len(cells) - 1) + [text]
        out.append(cells)
    return out


def pick_columns(rows: list[list[str | None]], wanted: list[str]) -> list[tuple[int, ...]]:
    """(position, values) of the wanted columns, found by their titles without regard to case and padding; rows with a null are left out, positions count from 1 over the rows kept."""
    if not rows:
        return []
    titles = {str(t or "").strip().lower(): i for i, t in enumerate(rows[0])}
    missing = [w for w in wanted if w.lower() not in titles]
    if missing:
        raise ValueError(f"the sheet has no column {', '.join(missing)}")
    at = [titles[w.lower()] for w in wanted]
    values = [[r[i] if i < len(r) else None for i in at] for r in rows[1:]]
    return [(k, *v) for k, v in enumerate((v for v in values if None not in v), 1)]


def event_sheet(spark: SparkSession, path: str) -> DataFrame:
    """(event_id, well_raw, event_text) of an xlsx file in any store that Spark reads."""
    schema = "event_id int, well_raw string, event_text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                yield pd.DataFrame(pick_columns(sheet_rows(bytes(content)), ["Well", "Event"]), columns=["event_id", "well_raw", "event_text"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


class EventSheet(DataSource):
    """spark.read.format("event_sheet").load(path): the same, of a file that the executors reach by its path."""

    @classmethod
    def name(cls) -> str:
        return "event_sheet"

    def schema(self) -> str:
        return "event_id int, well_raw string, event_text string"

    def reader(self, schema) -> DataSourceReader:
        return _SheetReader(self.options["path"])


class _SheetReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path.removeprefix("file://")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.path)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(partition.value, "rb") as f:
            yield from pick_columns(sheet_rows(f.read()), ["Well", "Event"])


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """UTF-8 with a header, no index; single: one file, for deliverables of bounded size."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"')


def write_table(df: DataFrame, path: str, *partition: str) -> None:
    """Full reload of a table, as the schema reset asks."""
    df.write.mode("overwrite").partitionBy(*partition).parquet(path)


def fresh(spark: SparkSession, index: str, source: str) -> bool:
    """Whether the index table was written after the newest file of its source; read through Spark's file systems."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def newest(path: str) -> int:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        return max([s.getModificationTime() for s in fs.listStatus(p)], default=0) if fs.exists(p) else -1

    return newest(index) >= newest(source) > -1


def load_or_build(spark: SparkSession, index: str, source: str, build: Callable[[], DataFrame], rebuild: bool = False) -> DataFrame:
    """The index table, built where it is missing, stale or asked for again."""
    if rebuild or not fresh(spark, index, source):
        write_table(build(), index)
    return spark.read.parquet(index)
