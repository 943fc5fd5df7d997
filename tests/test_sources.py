import io
import zipfile

from pyspark.sql import functions as F

from strata.operators import reports
from strata.plans import registry
from strata.sources import files
from strata.sources.ingest import ingest
from strata.streaming.ingest import stream_reports


def sheet(rows):
    out = io.BytesIO()
    cells = "".join(f"<row>{''.join(f'<c r="{chr(65 + i)}{k}" t="inlineStr"><is><t>{v}</t></is></c>' for i, v in enumerate(r) if v is not None)}</row>" for k, r in enumerate(rows, 1))
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{cells}</sheetData></worksheet>')
    return out.getvalue()


def test_event_sheet(spark, tmp_path):
    (tmp_path / "e.xlsx").write_bytes(sheet([["n", " EVENT ", "well"], ["1", "stuck", "15/9-F-10"], ["2", None, "x"], ["3", "kick", "15/9-F-13"]]))
    spark.dataSource.register(files.EventSheet)
    got = spark.read.format("event_sheet").load(str(tmp_path / "e.xlsx")).collect()
    assert [tuple(r) for r in got] == [(1, "15/9-F-10", "stuck"), (2, "15/9-F-13", "kick")]


def test_event_sheet_of_any_store(spark, tmp_path):
    (tmp_path / "e.xlsx").write_bytes(sheet([["Well", "Event"], ["15/9-F-10", "stuck"], [None, "x"]]))
    assert [tuple(r) for r in files.event_sheet(spark, f"file://{tmp_path}/e.xlsx").collect()] == [(1, "15/9-F-10", "stuck")]


def test_batch_ingest(spark, tmp_path):
    """Files to tables: ids run on over reports, a file that cannot be read and one that comes twice go to the quarantine."""
    texts = registry.report_texts(spark, "/root/testdata/sf0.001").orderBy("pdf_path").limit(3).collect()
    for r in texts:
        (tmp_path / r.pdf_path).write_text(r.text)
    (tmp_path / "bad.pdf").write_bytes(b"\xff")
    found = files.report_files(spark, f"file://{tmp_path}")
    both = found.unionByName(found.where(F.col("path").endswith(texts[0].pdf_path)))
    for _ in range(2):  # a full reload
        counts = {r.table_name: r.n for r in ingest(spark, both, str(tmp_path / "out"), lambda c: [c.decode()]).collect()}
    assert counts["reports"] == 3 and counts["parse_errors"] == 2 and counts["survey_station"] == 6
    assert {(r.stage, r.error_message.split(":")[0]) for r in spark.read.parquet(str(tmp_path / "out/parse_errors")).collect()} == {("parse", "UnicodeDecodeError"), ("load", "ConstraintException")}
    ids = [r.op_id for r in spark.read.parquet(str(tmp_path / "out/operations")).orderBy("pdf_path", "op_index").collect()]
    assert ids == list(range(1, counts["operations"] + 1))
    assert {r.parse_quality for r in spark.read.parquet(str(tmp_path / "out/reports")).collect()} == {"full"}


def test_decode_and_quarantine(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"Start Start\fpage")
    (tmp_path / "b.txt").write_bytes(b"no")
    found = files.report_files(spark, str(tmp_path))
    good, bad = files.decode_reports(found, files.plain_text)
    assert [r.text for r in good.collect()] == ["Start\n\npage"] and bad.count() == 0
    good, bad = files.decode_reports(found)
    assert good.count() == 0 and bad.first().error_message.startswith("RuntimeError")


def test_csv_and_index(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"\nc'), (2, None)], "i int, t string")
    files.write_csv(df, str(tmp_path / "o"), single=True)
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "o"), "i int, t string").collect())) == [(1, 'a "b"\nc'), (2, None)]
    made = []
    for _ in range(2):
        files.load_or_build(spark, str(tmp_path / "index"), str(tmp_path / "o"), lambda: made.append(1) or df)
    assert len(made) == 1


def test_ids_follow_path_and_position(spark):
    parsed = registry._parsed(spark, "/root/testdata/sf0.001")
    got = reports.child_table(parsed, "operations").orderBy("pdf_path", "op_index").select("op_id").toPandas().op_id.tolist()
    assert got == list(range(1, len(got) + 1))


def test_stream(spark, tmp_path):
    texts = registry.report_texts(spark, "/root/testdata/sf0.001").select("pdf_path", "text").orderBy("pdf_path").limit(3)
    texts.write.parquet(str(tmp_path / "in"))
    stream_reports(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/reports")).count() == 3
    assert spark.read.parquet(str(tmp_path / "out/survey_station")).select(F.countDistinct("pdf_path")).first()[0] == 3
