"""Scalar functions on literal rows: nulls, blanks and the odd cases."""

import datetime

import pytest
from pyspark.sql import functions as F

from strata.functions import activity, convert, entities, text
from strata.operators import reports


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c")).alias("o")).first().o


@pytest.mark.parametrize(("value", "want"), [("-999.99", None), ("1.5 g/cm3", 1.5), ("1,234.5", 1.234), ("N/A", None), (None, None), ("\n7\t", 7.0)])
def test_double(spark, value, want):
    assert one(spark, convert.as_double, value) == want


def test_conversions(spark):
    assert one(spark, convert.as_int, "-2.7") == -2
    assert [one(spark, convert.as_bool, v) for v in ("Yes", "n", "x", "na")] == [True, False, None, None]
    assert one(spark, convert.as_timestamp, "2020-01-01 25:00") == datetime.datetime(2020, 1, 1)
    assert one(spark, convert.as_timestamp, "at 2020-01-01\n10:30 h") == datetime.datetime(2020, 1, 1, 10, 30)
    assert [one(spark, convert.compact, v, "double") for v in (13.375, 1661.0, 123456.5, 999999.999, 0.0)] == ["13.375", "1661", "123456", "1e+06", "0"]


@pytest.mark.parametrize(("value", "want"), [("WWeellllbboorree", "Wellbore"), ("PPeerriioodd", "Period"), ("Mississippi", "Mississippi"), ("letter", "letter"), ("Start Start time time", "Start time"), ("Wellbore: Wellbore:", "Wellbore:"), ("23:00 00:00", "23:00 00:00"), ("Sur\nvey of circ  ulating", "Survey of circulating")])
def test_normalize(spark, value, want):
    assert one(spark, text.normalize_report, value) == want


def test_texts(spark):
    assert one(spark, text.expand_abbreviations, "POOH with BHA") == "POOH (pull out of hole) with BHA (bottom hole assembly)"
    assert [one(spark, text.expand_abbreviations, v) for v in ("F/2208", "F/ 2208")] == ["F/2208", "F/ (from) 2208"]
    assert one(spark, text.clean_query, "Reduced inclination to to 0.16 deg") == "Reduced inclination to 0.16 deg"
    assert one(spark, text.clean_query, 'clay amount ccumulation 26""""') == 'clay amount accumulation 26"'
    assert one(spark, text.well_key, "15/9-F-10") == "15_9_F_10"
    r = one(spark, text.file_parts, "dir/15_9_F_15_A_2008_12_16.pdf")
    assert (r.prefix, r.family, r.report_date) == ("15_9_F_15_A", "15_9_F_15", datetime.date(2008, 12, 16))
    assert one(spark, text.file_parts, "report.pdf") is None


REMARKS = [
    ("POOH slowly, bit at 640 m, slight overpull seen", ["TRIP_OUT"], 3),
    ("Top drive out of service, repaired brake", ["EQUIPMENT_FAILURE", "REPAIR"], 5),
    ("Tight spot passed at 1420 m, swabbing observed", ["TIGHT_HOLE"], 5),
    ("Drilled a new section", ["DRILL"], 0),
    ("Leak off test below shoe", ["PRESSURE_TEST"], 0),
    ("Toolbox talk, then laid out jars", ["LAY_DOWN", "TOOLBOX_TALK"], 0),
    (None, ["OTHER"], 0),
    ("", ["OTHER"], 0),
]


def test_tags_and_severity(spark):
    df = spark.createDataFrame([(r, "ok") for r, _, _ in REMARKS], "r string, s string").withColumn("f", activity.all_labels(F.col("r")))
    got = df.select(activity.labels(F.col("f")).alias("l"), activity.severity(F.col("r"), F.col("f"), F.col("s"))["score"].alias("n")).collect()
    assert [(g.l, g.n) for g in got] == [(x, n) for _, x, n in REMARKS]
    blank = spark.createDataFrame([("", "fail"), ("x", "FAIL")], "r string, s string").select(activity.severity(F.col("r"), activity.all_labels(F.col("r")), F.col("s")).alias("v")).collect()
    assert [(b.v.score, b.v.contributors) for b in blank] == [(0, ""), (5, "state:fail(+5)")]


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("25 m/h", [("DEPTH", "25 m", "25", "m")]),
        ("-25 m/h", [("MEASUREMENT", "-25 m/h", "-25", "m/h"), ("DEPTH", "25 m", "25", "m")]),
        ("50% of", []),
        ("50%x", [("MEASUREMENT", "50%", "50", "%")]),
        ("3820M", [("DEPTH", "3820M", "3820", "m")]),
        ("0,5 m", []),
        ('9-5/8"', [("BIT_SIZE", '8"', "8", '"')]),
        ("at 03:45 BHA", [("TIME", "03:45", "03:45", None), ("EQUIPMENT", "BHA", "BHA", None)]),
        ("", None),
        (None, None),
    ],
)
def test_entities(spark, value, want):
    got = one(spark, entities.entities, value)
    assert (got if got is None else [(e.label, e.text, e.value, e.unit) for e in got]) == want
    for e in got or []:
        assert value[e.char_start : e.char_end] == e.text


OPERATIONS = """Operations
Start time End time End Depth mMD Main - Sub Activity State Remark
00:00 03:45 2447 drilling - drill ok Drilled and
oriented
03:45 04:00 2447 moving fail x
04:00 04:30 -999.99 interruption -- repair n/a waited
04:30 05:00 2450 drilling - trip ok
Drilling Fluid
Sample Time 03:30 11:30
Fluid Density (g/cm3) 1.43
"""


def test_operations(spark):
    rows = one(spark, reports.operations, OPERATIONS)
    assert [(r.start_time, r.end_depth_md, r.main_activity, r.sub_activity, r.state, r.remark) for r in rows] == [
        ("00:00", 2447.0, "drilling", "drill", "ok", "Drilled and oriented"),
        ("03:45", 2447.0, "moving", None, "fail", "x"),
        ("04:00", None, "interruption", "repair", "n/a", "waited"),
        ("04:30", 2450.0, None, None, None, "drilling - trip ok"),
    ]
    fluid = one(spark, reports.drilling_fluid, OPERATIONS)
    assert [(f.sample_time, f.fluid_density_gcm3) for f in fluid] == [("03:30", 1.43), ("11:30", None)]
    assert one(spark, reports.operations, "no such section") is None
