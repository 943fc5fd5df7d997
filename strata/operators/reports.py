"""Report text to records: header, summaries, and the six repeated sections.

All functions are Column expressions over the normalized text of one report, so
a scan of reports is parsed in one pass without Python; child tables are
posexplode()d from arrays of structs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.convert import as_bool, as_date, as_double, as_int, as_text, as_timestamp, cut_at, let, strip
from ..functions.text import _literal
from ..sources.scratch import materialize

# fixed values: section headings in the order of a report
HEADINGS = [
    "Summary report", "Summary of activities (24 Hours)", "Summary of planned activities (24 Hours)", "Operations",
    "Drilling Fluid", "Pore Pressure", "Survey Station", "Log Information", "Lithology Information",
    "Gas Reading Information",
]

# fixed values: header column, label, kind
HEADER = [
    ("wellbore_id", "Wellbore:", "text"), ("period", "Period:", "text"), ("status", "Status:", "text"),
    ("report_creation_time", "Report creation time:", "timestamp"), ("report_number", "Report number:", "int"),
    ("days_ahead_behind", "Days Ahead/Behind (+/-):", "double"), ("operator", "Operator:", "text"),
    ("rig_name", "Rig Name:", "text"), ("drilling_contractor", "Drilling contractor:", "text"),
    ("spud_date", "Spud Date:", "timestamp"), ("wellbore_type", "Wellbore type:", "text"),
    ("elevation_rkb_msl_m", "Elevation RKB-MSL (m):", "double"), ("elevation_rkb_msl_m", "Elevation RKB-MSL ():", "double"),
    ("water_depth_msl_m", "Water depth MSL (m):", "double"), ("tight_well", "Tight well:", "bool"), ("hpht", "HPHT:", "bool"),
    ("temperature", "Temperature ():", "double"), ("pressure", "Pressure ():", "double"),
    ("date_well_complete", "Date Well Complete:", "date"), ("dist_drilled_m", "Dist Drilled (m):", "double"),
    ("penetration_rate_mph", "Penetration rate (m/h):", "double"), ("hole_dia_in", "Hole Dia (in):", "double"),
    ("hole_dia_in", "Hole Dia ():", "double"), ("pressure_test_type", "Pressure Test Type:", "text"),
    ("formation_strength_gcm3", "Formation strength (g/cm3):", "double"),
    ("formation_strength_gcm3", "Formation strength ():", "double"), ("dia_last_casing", "Dia Last Casing ():", "double"),
    ("depth_kickoff_md", "Depth at Kick Off mMD:", "double"), ("depth_kickoff_tvd", "Depth at Kick Off mTVD:", "double"),
    ("depth_md", "Depth mMd:", "double"), ("depth_tvd", "Depth mTVD:", "double"),
    ("plug_back_depth_md", "Plug Back Depth mMD:", "double"),
    ("depth_formation_strength_md", "Depth at formation strength mMD:", "double"),
    ("depth_formation_strength_tvd", "Depth At Formation Strength mTVD:", "double"),
    ("depth_last_casing_md", "Depth At Last Casing mMD:", "double"),
    ("depth_last_casing_tvd", "Depth At Last Casing mTVD:", "double"),
]
_AS = {"text": as_text, "timestamp": as_timestamp, "int": as_int, "double": as_double, "bool": as_bool, "date": as_date}

# fixed values: fluid column, pattern of its line's label, numeric or not
FLUID = [
    ("sample_time", r"Sample Time", False), ("sample_point", r"Sample Point", False), ("sample_depth_md", r"Sample Depth mMD", True),
    ("fluid_type", r"Fluid Type", False), ("fluid_density_gcm3", r"Fluid Density \(g/cm3\)", True),
    ("funnel_visc_s", r"Funnel Visc \(s\)", True), ("plastic_visc_mpas", r"Plastic visc\. \(mPa\.s\)", True),
    ("yield_point_pa", r"Yield point \(Pa\)", True), ("test_temp_hpht_degc", r"Test Temp HPHT \(degC\)", True),
]
# fixed values: layouts of the sections' rows
NUMBER = r"\d+(?:\.\d+)?"
FOUR = rf"{NUMBER}\s+{NUMBER}\s+{NUMBER}\s+{NUMBER}"
OPERATION = r"(?s)(\d{2}:\d{2})\s+(\d{2}:\d{2})\s+(-?\d+(?:\.\d+)?)\s+(.+?)(?=\s+\d{2}:\d{2}\s+\d{2}:\d{2}\s+-?\d+(?:\.\d+)?\s+|\Z)"
PORE = r"(\d{2}:\d{2})\s+(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s+([a-zA-Z][a-zA-Z _]*)"
SURVEY = rf"({NUMBER})\s+({NUMBER})\s+({NUMBER})\s+({NUMBER})"
LITHOLOGY = rf"(?s)({NUMBER})\s+({NUMBER})\s+({NUMBER})\s+({NUMBER})\s+(.+?)(?=\s+{FOUR}|\Z)"
GAS = r"(?i)(\d{2}:\d{2})\s+((?:drilling\s+gas|connection\s+gas|trip\s+gas|background\s+gas)[a-z\s]*)"


def section(text: Column, heading: str) -> Column:
    """What lies between the first place of a heading and the nearest other heading after it; null without it."""
    nearest = lambda rest: F.least(*[F.nullif(F.locate(h, rest), F.lit(0)) for h in HEADINGS if h != heading])
    upto = lambda rest: let(nearest(rest), lambda end: F.when(end.isNull(), rest).otherwise(F.substring(rest, F.lit(1), end - 1)))
    after = lambda at: F.when(at > 0, strip(let(F.substring(text, at + len(heading), F.length(text)), upto)))
    return let(F.locate(heading, text), after)


def _group(s: Column, pattern: str, i: int) -> Column:
    return F.regexp_extract(s, pattern, i)


def header_values(text: Column) -> Column:
    """map(label -> first raw value): lines before the summary, cut at the longest labels; the last value of a line loses the start of a label that runs on."""
    block = F.regexp_extract(text, r"(?s)\A(.*?)(?=Summary of activities|\Z)", 1)
    names = "|".join(_literal(label) for label in sorted({h[1] for h in HEADER}, key=len, reverse=True))
    starts = sorted({" ".join(label.lower().split()[:n]) for _, label, _ in HEADER for n in (1, 2, 3) if len(label.split()) > n} | {label.lower()[:-1] for _, label, _ in HEADER})
    tails = F.array(*[F.lit(s) for s in starts])

    def tidy(raw: Column) -> Column:
        words = F.split(raw, r"\s+")
        cut = F.lit(None).cast("string")
        for n in (1, 2, 3):  # three words are tried first
            tail = F.lower(F.array_join(F.slice(words, F.greatest(F.lit(1), F.size(words) - n + 1), n), " "))
            cut = F.when((F.size(words) > n) & F.array_contains(tails, tail), F.array_join(F.slice(words, 1, F.greatest(F.lit(0), F.size(words) - n)), " ")).otherwise(cut)
        return F.coalesce(cut, raw)

    def line(x: Column) -> Column:
        """Labels are at the odd pieces, each value after its label; the last value may run on into a label."""
        value = lambda p, i: F.when(i == F.size(p) - 1, tidy(strip(F.get(p, i)))).otherwise(strip(F.get(p, i)))
        at = lambda p: F.filter(F.transform(p, lambda k, i: F.when(i % 2 == 1, F.struct(k.alias("k"), value(p, i + 1).alias("v")))), lambda v: v.isNotNull())
        return let(cut_at(x, names), at)

    return F.flatten(F.transform(F.split(block, r"\R"), lambda x: line(strip(x))))


def header(text: Column) -> list[Column]:
    """The header's columns; of several values the first that can be read wins."""
    return header_columns(header_values(text))


def header_columns(pairs: Column) -> list[Column]:
    out = []
    for column in dict.fromkeys(h[0] for h in HEADER):
        kinds = {label: kind for c, label, kind in HEADER if c == column}
        kind = next(iter(kinds.values()))
        mine = F.filter(pairs, _has(tuple(kinds)))
        first = F.get(F.filter(F.transform(mine, _read(kind)), lambda v: v.isNotNull()), F.lit(0))
        out.append(first.alias(column))
    return out


def _has(labels: tuple[str, ...]):
    return lambda p: p["k"].isin(*labels)


def _read(kind: str):
    return lambda p: _AS[kind](p["v"])


# fixed value: layout of a period
PERIOD = r"\A(\d{4}-\d{2}-\d{2}(?:\s+\d{2}:\d{2})?)\s*-\s*(\d{4}-\d{2}-\d{2}(?:\s+\d{2}:\d{2})?)"


def operations(text: Column) -> Column:
    rows = F.regexp_extract_all(section(text, "Operations"), F.lit(OPERATION), F.lit(0))
    state_at = r"(?is)\A(.*?)\s+(ok|fail|n/a)\s+(.*)\Z"

    blank = lambda c: F.nullif(strip(c), F.lit(""))

    def said(body: Column, start: Column, end: Column, depth: Column) -> Column:
        """One match tells activity, state and remark apart."""
        parts = F.when(body.rlike(state_at), F.split(F.regexp_replace(body, state_at, "$1\u0001$2\u0001$3"), "\u0001", 3))
        return let(parts, lambda p: named(body, p, F.split(strip(F.get(p, F.lit(0))), r"\s+-{1,2}\s+", 2), start, end, depth))

    def named(body, p, activity, start, end, depth):
        values = F.struct(blank(F.get(activity, F.lit(0))).alias("main"), blank(F.get(activity, F.lit(1))).alias("sub"), F.lower(F.get(p, F.lit(1))).alias("state"), blank(F.when(p.isNotNull(), F.get(p, F.lit(2))).otherwise(body)).alias("remark"))
        return let(values, lambda v: F.struct(start.alias("start_time"), end.alias("end_time"), depth.alias("end_depth_md"), v["main"].alias("main_activity"), v["sub"].alias("sub_activity"), v["state"].alias("state"), v["remark"].alias("remark"), F.concat_ws(" | ", v["main"], v["sub"], v["state"], v["remark"]).alias("op_text")))

    def row(s: Column) -> Column:
        # the row is a match of its own: its fields are told by white space alone, without the look ahead
        fields = F.split(s, r"\s+", 4)
        return let(fields, lambda f: let(strip(F.regexp_replace(F.get(f, F.lit(3)), r"\s+", " ")), lambda body: said(body, F.get(f, F.lit(0)), F.get(f, F.lit(1)), as_double(F.get(f, F.lit(2))))))

    return F.transform(rows, row)


def drilling_fluid(text: Column) -> Column:
    """The block has a line for each property and a column for each sample: turned over; short lines give nulls."""
    body = section(text, "Drilling Fluid")
    lists = {c: F.filter(F.split(F.regexp_extract(body, p + r"\s+([^\n]+)", 1), r"\s+"), lambda t: t != "") for c, p, _ in FLUID}
    n = lambda b: F.greatest(*[F.size(b[c]) for c in lists])
    cell = lambda b, c, numeric, i: (as_double if numeric else as_text)(F.get(b[c], i)).alias(c)
    rows = lambda b: F.transform(F.sequence(F.lit(0), n(b) - 1), lambda i: F.struct(*[cell(b, c, numeric, i) for c, _, numeric in FLUID]))
    return let(F.struct(*[v.alias(c) for c, v in lists.items()]), lambda b: F.when(n(b) > 0, rows(b)))


def _rows(body: Column, pattern: str, of) -> Column:
    return F.transform(F.regexp_extract_all(body, F.lit(pattern), F.lit(0)), of)


def pore_pressure(text: Column) -> Column:
    return _rows(section(text, "Pore Pressure"), PORE, lambda s: F.struct(_group(s, PORE, 1).alias("sample_time"), as_double(_group(s, PORE, 2)).alias("depth_md"), F.lit(None).cast("double").alias("depth_tvd"), as_double(_group(s, PORE, 3)).alias("equ_mud_weight_gcm3"), as_text(_group(s, PORE, 4)).alias("reading_type")))


def _from_first_four(body: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(body, rf"(?s){FOUR}.*\Z", 0), F.lit("")), body)


def survey_stations(text: Column) -> Column:
    names = ["depth_md", "depth_tvd", "inclination_deg", "azimuth_deg"]
    return _rows(_from_first_four(section(text, "Survey Station")), SURVEY, lambda s: F.struct(*[as_double(_group(s, SURVEY, i + 1)).alias(n) for i, n in enumerate(names)], F.lit(None).cast("string").alias("comment")))


def lithology(text: Column) -> Column:
    names = ["start_depth_md", "end_depth_md", "start_depth_tvd", "end_depth_tvd"]
    said = lambda s: F.nullif(strip(F.regexp_replace(_group(s, LITHOLOGY, 5), r"\s+", " ")), F.lit(""))
    return _rows(_from_first_four(section(text, "Lithology Information")), LITHOLOGY, lambda s: F.struct(*[as_double(_group(s, LITHOLOGY, i + 1)).alias(n) for i, n in enumerate(names)], F.lit(None).cast("string").alias("shows_description"), said(s).alias("lithology_description")))


GAS_EMPTY = ["depth_top_md", "depth_bottom_md", "depth_top_tvd", "depth_bottom_tvd", "c1_ppm", "c2_ppm", "c3_ppm", "ic4_ppm", "ic5_ppm", "highest_gas_pct", "lowest_gas_pct"]


def gas_readings(text: Column) -> Column:
    """Time and class; the numeric columns are not read and stay null."""
    return _rows(section(text, "Gas Reading Information"), GAS, lambda s: F.struct(_group(s, GAS, 1).alias("sample_time"), as_text(_group(s, GAS, 2)).alias("gas_class"), *[F.lit(None).cast("double").alias(c) for c in GAS_EMPTY]))


#: child table, its rows, the name of the position, the name of the surrogate id
CHILDREN = {
    "operations": (operations, "op_index", "op_id"), "drilling_fluid": (drilling_fluid, "sample_index", "fluid_id"),
    "pore_pressure": (pore_pressure, "reading_index", "pp_id"), "survey_station": (survey_stations, "station_index", "survey_id"),
    "lithology": (lithology, "interval_index", "litho_id"), "gas_reading": (gas_readings, "reading_index", "gas_id"),
}


def parse_reports(files: DataFrame) -> DataFrame:
    """files (pdf_path, text: normalized) with all header columns, file name parts, summaries, quality, and an array for each child table."""
    from ..functions.text import file_parts

    text = F.col("text")
    base = files.withColumns({"pdf_filename": F.element_at(F.split("pdf_path", "/"), -1), "_f": file_parts(F.col("pdf_path")), "_h": header_values(text)})
    base = base.select("*", *header_columns(F.col("_h")))
    base = base.withColumns({"period_start": as_timestamp(F.nullif(F.regexp_extract("period", PERIOD, 1), F.lit(""))), "period_end": as_timestamp(F.nullif(F.regexp_extract("period", PERIOD, 2), F.lit("")))}).drop("period", "_h")
    base = base.withColumns({"well_prefix": F.col("_f.prefix"), "well_family": F.col("_f.family"), "report_date": F.col("_f.report_date")}).drop("_f")
    base = base.withColumns({"summary_24h": as_text(section(text, "Summary of activities (24 Hours)")), "planned_24h": as_text(section(text, "Summary of planned activities (24 Hours)"))})
    base = base.withColumns({n: f(text) for n, (f, _, _) in CHILDREN.items()})
    some = F.coalesce(section(text, "Operations").rlike(OPERATION), F.lit(False))  # one match will do
    return base.withColumn("parse_quality", F.when(F.col("wellbore_id").isNotNull() & some, "full").when(F.col("wellbore_id").isNotNull(), "partial").otherwise("header_only"))


def child_table(parsed: DataFrame, name: str) -> DataFrame:
    """Rows of a child table with the report's path, family (and prefix and date for operations) and a surrogate id from 1 on in order of path and position. The parsed rows are written once and read twice: for the running count over reports, and for the rows."""
    _, place, key = CHILDREN[name]
    carried = ["pdf_path", "well_family"] + (["well_prefix", "report_date"] if name == "operations" else [])
    parsed = materialize(parsed.select(*carried, name), name.replace("_", "-"))
    counts = parsed.select("pdf_path", F.greatest(F.lit(0), F.coalesce(F.size(name), F.lit(0))).cast("long").alias("_n"))
    rows = parsed.select(*carried, F.posexplode(name).alias(place, "_r")).join(running_offsets(counts, "pdf_path"), "pdf_path")
    return rows.select((F.col("_offset") + F.col(place) + 1).cast("long").alias(key), *carried, place, "_r.*")


def running_offsets(counts: DataFrame, key: str) -> DataFrame:
    """(key, _offset): the sum of _n over all smaller keys. Keys are sorted by range, each range adds up its own, and one row a range is added up over all."""
    ranged = materialize(counts.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "ranges")
    earlier = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = ranged.groupBy("_part").agg(F.sum("_n").alias("_n")).select("_part", earlier(Window.orderBy("_part")).alias("_base"))
    within = ranged.select(key, "_part", earlier(Window.partitionBy("_part").orderBy(key)).alias("_in"))
    return within.join(F.broadcast(first), "_part").select(key, (F.col("_base") + F.col("_in")).alias("_offset"))
