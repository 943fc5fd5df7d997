"""Analytics on tagged operations: patterns, severity, transitions, quality reports, keywords by well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.activity import FAILURES, all_labels, labels, severity


def tagged(ops: DataFrame) -> DataFrame:
    """ops with found: all labels of the remark. It comes out of a generator of one row, which no later step is folded into: the rules run once a row, however often found is used."""
    return ops.select("*", F.explode(F.array(all_labels(F.col("remark")))).alias("found"))


def activity_tags(ops: DataFrame, most: int = 3) -> DataFrame:
    few = labels(F.col("found"), most)
    return tagged(ops).select("op_id", "pdf_path", "well_family", "report_date", "main_activity", "sub_activity", "state", few[0].alias("primary_label"), F.array_join(few, "|").alias("all_labels"), F.substring("remark", 1, 200).alias("remark_preview"))


def failure_patterns(ops: DataFrame, top: int = 10, least: int = 2, samples: int = 3) -> DataFrame:
    """Failure labels by family with their counts and first sample remarks. Samples: the first by (path, index), found by a ranked window on few columns, never by collecting a family's remarks."""
    rows = tagged(ops).where("well_family is not null").select("well_family", "pdf_path", "op_index", "op_id", "remark", F.explode(labels(F.col("found"))).alias("failure_label")).where(F.col("failure_label").isin(FAILURES))
    counts = rows.groupBy("well_family", "failure_label").agg(F.count("*").alias("count")).where(F.col("count") >= least)
    ranked = counts.withColumn("_r", F.row_number().over(Window.partitionBy("well_family").orderBy(F.desc("count"), "failure_label"))).where(F.col("_r") <= top).drop("_r")
    first = rows.withColumn("_r", F.row_number().over(Window.partitionBy("well_family", "failure_label").orderBy("pdf_path", "op_index", "op_id"))).where(F.col("_r") <= samples)
    said = first.groupBy("well_family", "failure_label").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", F.substring("remark", 1, 160).alias("t")))), lambda x: x["t"]), " || ").alias("sample_remarks"))
    return ranked.join(said, ["well_family", "failure_label"]).select("well_family", "failure_label", "count", "sample_remarks").orderBy("well_family", F.desc("count"), "failure_label")


def severity_scores(ops: DataFrame, least: int = 5) -> DataFrame:
    of = severity(F.col("remark"), F.col("found"), F.col("state"))
    # the generator filters: a predicate on a column would be computed apart from it
    scored = tagged(ops).select("*", F.explode(F.filter(F.array(of), lambda s: s["score"] >= least)).alias("_s"))
    return scored.select("op_id", "well_family", "pdf_path", "report_date", "start_time", "end_depth_md", "main_activity", "sub_activity", "state", F.col("_s.score").alias("severity_score"), F.col("_s.contributors").alias("severity_contributors"), "remark").orderBy(F.desc("severity_score"), "op_id")


def transitions(ops: DataFrame) -> DataFrame:
    """Counts of consecutive primary labels within a report; operations without remark are left out, empty remarks are not."""
    rows = tagged(ops).where("pdf_path is not null and remark is not null").select("pdf_path", "op_index", "op_id", F.col("found")[0].alias("from_activity"))
    following = F.lead("from_activity").over(Window.partitionBy("pdf_path").orderBy("op_index", "op_id"))
    pairs = rows.withColumn("to_activity", following).where("to_activity is not null")
    return pairs.groupBy("from_activity", "to_activity").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "from_activity", "to_activity")


def top_transitions(counts: DataFrame, top: int = 12) -> DataFrame:
    """Transitions among the labels that most transitions start from."""
    often = counts.groupBy("from_activity").agg(F.sum("count").alias("t")).orderBy(F.desc("t"), "from_activity").limit(top).select(F.col("from_activity").alias("label"))
    return counts.join(often, counts.from_activity == often.label, "left_semi").join(often, counts.to_activity == often.label, "left_semi")


def label_distribution(ops: DataFrame) -> DataFrame:
    return tagged(ops).groupBy(F.col("found")[0].alias("primary_label")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "primary_label")


def activity_crosstab(ops: DataFrame) -> DataFrame:
    """Share of each primary label in a family, in percent."""
    n = tagged(ops).groupBy("well_family", F.col("found")[0].alias("primary_label")).agg(F.count("*").alias("n"))
    return n.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("well_family")), 4)).drop("n")


def ops_per_well(ops: DataFrame) -> DataFrame:
    return ops.groupBy("well_family").agg(F.count("*").alias("n_ops"), F.countDistinct("pdf_path").alias("n_pdfs"), F.count_if(F.col("state") == "fail").alias("n_fail")).orderBy(F.desc("n_ops"), "well_family")


def reports_per_well(reports: DataFrame) -> DataFrame:
    return reports.groupBy("well_family").agg(F.count("*").alias("n_reports"), F.min("report_date").alias("first_report"), F.max("report_date").alias("last_report")).orderBy(F.desc("n_reports"), "well_family")


def reports_per_well_year(reports: DataFrame) -> DataFrame:
    return reports.where("report_date is not null").groupBy("well_family", F.year("report_date").alias("year")).agg(F.count("*").alias("n_reports"))


def pivot_years(reports: DataFrame, years: list[int]) -> DataFrame:
    return reports_per_well_year(reports).groupBy("well_family").pivot("year", years).agg(F.sum("n_reports")).fillna(0)


def frequencies(df: DataFrame, *columns: str, top: int | None = None, present: bool = False) -> DataFrame:
    """Rows of each combination of columns, most frequent first; present: only where the first is not null."""
    df = df.where(F.col(columns[0]).isNotNull()) if present else df
    out = df.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *columns)
    return out.limit(top) if top else out


def table_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """Rows of each table; -1 for one that is missing."""
    some = next(t for t in tables.values() if t is not None).sparkSession
    out = None
    for name, t in tables.items():
        row = some.range(1).select(F.lit(name).alias("table_name"), F.lit(-1).cast("long").alias("n")) if t is None else t.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


def histogram(values: DataFrame, column: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Rows in equal bins from lo to hi, 1 to bins; the last holds hi too."""
    at = F.least(F.width_bucket(F.col(column), F.lit(float(lo)), F.lit(float(hi)), F.lit(bins)), F.lit(bins).cast("long"))
    return values.groupBy(at.cast("long").alias("bin")).agg(F.count("*").alias("n"))


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[F.countDistinct(c).alias(f"n_{c}") for c in columns])


def unknown_wells(events: DataFrame, known: DataFrame) -> DataFrame:
    return events.select("well_family").distinct().join(known.select("well_family").distinct(), "well_family", "left_anti")


def keywords_per_well(keywords: DataFrame, top: int = 20) -> DataFrame:
    """The keywords that most reports of a family have."""
    n = keywords.where("well_family is not null").groupBy("well_family", "keyword").agg(F.count("*").alias("n_reports"))
    return n.withColumn("_r", F.row_number().over(Window.partitionBy("well_family").orderBy(F.desc("n_reports"), "keyword"))).where(F.col("_r") <= top).drop("_r")


def entity_rows(ops: DataFrame, entities: Column) -> DataFrame:
    return ops.select("op_id", "pdf_path", "well_family", "report_date", F.explode(entities).alias("e")).select("op_id", "pdf_path", "well_family", "report_date", F.col("e.text").alias("entity_text"), F.col("e.label").alias("entity_label"), F.col("e.value").alias("entity_value"), F.col("e.unit").alias("entity_unit"), F.col("e.char_start").alias("char_start"), F.col("e.char_end").alias("char_end"))


def run_summary(tables: dict[str, DataFrame], counts: dict[str, int] | None = None) -> DataFrame:
    """One row: n_<name> for each table of a run, and the given figures."""
    some = next(iter(tables.values())).sparkSession
    out = some.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in (counts or {}).items()])
    for name, t in tables.items():
        out = out.join(t.agg(F.count("*").alias(f"n_{name}")))  # one row each
    return out


def matching_summary(events: DataFrame, matches: DataFrame, benchmark: DataFrame, methods: int = 4, top: int = 5) -> DataFrame:
    """One row on a matching run: events by scope, match rows, and how many events all methods agree on."""
    e = events.agg(F.count("*").alias("n_events"), F.count_if("has_pdf_corpus").alias("n_strict_events"), F.count_if(~F.col("has_pdf_corpus")).alias("n_fallback_events"))
    b = benchmark.agg(F.count("*").alias("n_benchmark_rows"), F.count_if("all_methods_agree").alias("all_methods_agree"))
    return e.join(matches.agg(F.count("*").alias("n_match_rows"))).join(b).select("*", F.lit(methods).alias("n_methods"), F.lit(top).alias("top_k"))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """All rows of n keys drawn at random (by a seeded hash, so that a run can be repeated), or the first n keys in order with seed None. Only the keys are sorted."""
    keys = df.select(key).distinct()
    order = [key] if seed is None else [F.xxhash64(F.lit(seed), key), key]
    return df.join(F.broadcast(keys.orderBy(*order).limit(n)), key, "left_semi")
