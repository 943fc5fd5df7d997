"""Drilling relations made from the events table, as one SQL text that Spark and the oracle both run.

The tables at hand hold no report vocabulary, so operations, reports and report
texts are derived from events: deterministic, with null and empty remarks.
"""

from __future__ import annotations

PREFIXES = ["15_9_F_10", "15_9_F_11", "15_9_F_11_A", "15_9_F_12", "15_9_F_14", "15_9_F_15_A", "15_9_19_ST2", "15_9_19_B"]
FAMILIES = ["15_9_F_10", "15_9_F_11", "15_9_F_11", "15_9_F_12", "15_9_F_14", "15_9_F_15", "15_9_19", "15_9_19"]
#: written for this repository; @v is a number
REMARKS = [
    "Oriented and drilled 17 1/2 inch section down to @v m MD, 3400 lpm, 150 rpm",
    "POOH from @v m with 17 1/2 inch BHA, overpull of up to 15 MT",
    "Two pumps out of service at @v m, repaired liner of mud pump",
    "Tight spot at @v m MD while pulling stabilizer, reamed section, no swabbing",
    "RIH with 20 inch casing, differential stuck at @v m, jarred free",
    "Circulated bottoms up at @v m MD with 4200 lpm until shakers were clean",
    "Leak off test below shoe at @v m, 1.52 sg",
    "Tool box talk, then L/O of 26 inch BHA",
    "Waited on weather @v min, stand by with crew",
    "Influx observed, shut in well at @v m, kill operation started",
    "Fishing for lost cone, ran overshot to @v m, twist-off suspected",
    "Cemented liner, pumped spacer and @v bar squeeze",
    "M/U new bit and R/U casing running tool, changed seal",
    "Tested BOP and annular to 345 bar, flow check negative",
    "Took MWD survey at @v m, inclination 27.5 deg, azimuth 210",
    "Lost circulation at @v m, pumped LCM pill, emergency drill held",
    "Pack off at @v m MD, broken shaker, repaired",
    "Ran in hole, RIH with 12 1/4 inch assembly to @v m",
    "Rigged down wireline, laid out tools, R/D completed",
    "Cleaned rig floor and inspected equipment",
    "Drilling ahead 8.5 inch hole from @v m at 25 m/h with 32 kNm, 50% returns",
    "TDS failed at 03:45, leak in hydraulic hose, waited for parts",
    "Displaced well to @v m with OBM, mud weight 1.43 g/cm3",
    "Cut string at free point @v m, back off and POOH",
]


def _pick(index: str, values: list[str]) -> str:
    return "CASE " + index + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


_V = "CAST(CAST(floor(abs(value) * 37) AS BIGINT) % 3000 + 100 AS {text})"


def ops_sql(text: str, events: str = "events") -> str:
    """Operations (14 columns and ts). text: the engine's name of the string type."""
    v = _V.format(text=text)
    remark = f"replace({_pick(f'event_id % {len(REMARKS)}', REMARKS)}, '@v', {v})"
    pad = lambda c, n: f"lpad(CAST({c} AS {text}), {n}, '0')"
    return f"""
SELECT op_id, pdf_path, well_prefix, well_family, report_date, op_index, start_time, end_time, end_depth_md, main_activity, sub_activity, state, remark,
  concat_ws(' | ', main_activity, sub_activity, state, nullif(remark, '')) AS op_text
FROM (
  SELECT event_id AS op_id, concat(well_prefix, '_', {pad('year(ts)', 4)}, '_', {pad('month(ts)', 2)}, '_', {pad('day(ts)', 2)}, '.pdf') AS pdf_path, well_prefix, well_family,
    CAST(ts AS DATE) AS report_date,
    CAST(row_number() OVER (PARTITION BY well_prefix, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS INT) AS op_index,
    concat({pad('hour(ts)', 2)}, ':', {pad('minute(ts)', 2)}) AS start_time, concat({pad('(hour(ts) + 1) % 24', 2)}, ':', {pad('minute(ts)', 2)}) AS end_time,
    CAST(CAST(floor(abs(value) * 37) AS BIGINT) % 3000 + 100 AS DOUBLE) AS end_depth_md,
    {_pick('event_id % 3', ['drilling', 'moving', 'interruption'])} AS main_activity, CASE WHEN event_id % 5 > 0 THEN {_pick('event_id % 4', ['drill', 'trip', 'repair', 'circulating conditioning'])} END AS sub_activity,
    CASE WHEN event_type = 'error' OR event_id % 11 = 0 THEN 'fail' ELSE 'ok' END AS state,
    CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN '' ELSE {remark} END AS remark
  FROM (SELECT *, {_pick(f'user_id % {len(PREFIXES)}', PREFIXES)} AS well_prefix, {_pick(f'user_id % {len(FAMILIES)}', FAMILIES)} AS well_family FROM {events}) e
) o"""


def reports_sql(text: str, events: str = "events") -> str:
    """Reports, one a well prefix and day; a few without operations follow from the day after the last."""
    return f"""
SELECT pdf_path, well_prefix, well_family, report_date,
  concat('Summary of work on ', well_family, ': drilled ahead, tested barriers and prepared casing') AS summary_24h,
  CASE WHEN n_ops % 3 > 0 THEN concat('Continue tripping and drilling section of ', well_prefix) END AS planned_24h,
  CASE WHEN n_ops % 7 = 0 THEN 'partial' WHEN n_ops % 11 = 0 THEN 'header_only' ELSE 'full' END AS parse_quality, n_ops
FROM (SELECT pdf_path, well_prefix, well_family, report_date, count(*) AS n_ops FROM ({ops_sql(text, events)}) x GROUP BY pdf_path, well_prefix, well_family, report_date) r"""
