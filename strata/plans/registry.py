"""All registered queries of the engine and their SQL.

Each query derives its relations from the driver's tables (synth.py) and applies
operators of the engine to whole tables. SQL is written apart from the
operators: RE2 patterns, joins and windows of the oracle's own.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import activity, convert, entities, text
from ..operators import mining, reports, retrieval
from ..sources import files
from . import match_sql, synth


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(synth.ops_sql("STRING", "{e}"), e=table(spark, sf_dir, "events"))


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(synth.reports_sql("STRING", "{e}"), e=table(spark, sf_dir, "events"))


OPS = f"ops AS ({synth.ops_sql('VARCHAR')})"
REPORTS = f"reports AS ({synth.reports_sql('VARCHAR')})"

# four event descriptions, written for this repository; the last has no reports of its own
EVENTS = [
    (1, "15/9-F-10", "Reduced inclination to to 27.5 deg, azimuth 210 at 958 m"),
    (2, "15/9-F-11", 'Tight hole and overpull in 17 1/2" section, pack off ecountered'),
    (3, "15/9-F-12", "Clay accumulation on 26\"\"\"\" BHA after POOH, lost circulation"),
    (4, "15/9-F-13", "Stuck pipe while RIH with casing, fishing with overshot"),
]


def event_rows(spark: SparkSession) -> DataFrame:
    base = spark.createDataFrame(EVENTS, "event_id int, well_raw string, event_text string")
    family = text.well_key(F.col("well_raw"))
    return base.withColumn("well_family", family).withColumn("has_pdf_corpus", ~F.col("well_family").isin(text.WELLS_WITHOUT_REPORTS))


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@lru_cache
def _labels_sql() -> str:
    """A list of the labels that fire, in order, for the oracle (RE2: no look-ahead, so 'leak off' is taken out first)."""
    tests = []
    for label, p, _ in sorted(activity.RULES, key=lambda r: -r[2]):
        subject = "remark" if label != "EQUIPMENT_FAILURE" else "regexp_replace(remark, 'leak\\s*off', ' ', 'gi')"
        tests.append(f"CASE WHEN regexp_matches({subject}, {_quote(p.replace('(?!\\s*off)', ''))}, 'i') THEN '{label}' END")
    return "list_filter([" + ", ".join(tests) + "], lambda x: x IS NOT NULL)"


@lru_cache
def tagged_sql() -> str:
    return f"{OPS}, t0 AS (SELECT *, {_labels_sql()} AS hits FROM ops), tagged AS (SELECT * EXCLUDE (hits), CASE WHEN len(coalesce(hits, [])) = 0 THEN ['OTHER'] ELSE hits END AS found FROM t0)"


def _cte(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


# ---- tags and analytics -------------------------------------------------------------------------


def activity_tags(spark, d):
    return mining.activity_tags(ops(spark, d))


def failure_patterns(spark, d):
    return mining.failure_patterns(ops(spark, d))


def severity_scores(spark, d):
    return mining.severity_scores(ops(spark, d))


def activity_transitions(spark, d):
    return mining.transitions(ops(spark, d))


def transition_matrix_top(spark, d):
    return mining.top_transitions(mining.transitions(ops(spark, d)))


def label_distribution(spark, d):
    return mining.label_distribution(ops(spark, d))


def activity_crosstab(spark, d):
    return mining.activity_crosstab(ops(spark, d))


def role_transitions(spark, d):
    """Consecutive roles of conversations: the transition operator on a native table."""
    from pyspark.sql import Window

    c = table(spark, d, "conversations").select("conv_id", "turn", "role")
    nxt = F.lead("role").over(Window.partitionBy("conv_id").orderBy("turn", "role"))
    return c.withColumn("to_role", nxt).where("to_role is not null").groupBy(F.col("role").alias("from_role"), "to_role").agg(F.count("*").alias("n"))


def _severity_sql() -> str:
    weights = "CASE x " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in activity.WEIGHTS.items()) + " ELSE 0 END"
    by_label = f"list_transform(list_filter(found[1:5], lambda x: {weights} > 0), lambda x: {{'w': {weights}, 't': x || '(+' || CAST({weights} AS VARCHAR) || ')'}})"
    by_text = ", ".join(f"CASE WHEN regexp_matches(remark, {_quote(p)}, 'i') THEN {{'w': {w}, 't': 'text:{n}(+{w})'}} END" for p, w, n in activity.SIGNALS)
    return f"""{_cte(tagged_sql())}, p AS (SELECT *, list_filter(list_concat({by_label}, [{by_text}, CASE WHEN lower(state) = 'fail' THEN {{'w': 5, 't': 'state:fail(+5)'}} END]), lambda x: x IS NOT NULL) AS parts FROM tagged WHERE coalesce(remark, '') <> '')
SELECT op_id, well_family, pdf_path, report_date, start_time, end_depth_md, main_activity, sub_activity, state, CAST(list_sum(list_transform(parts, lambda x: x.w)) AS INT) AS severity_score, array_to_string(list_transform(parts, lambda x: x.t), '|') AS severity_contributors, remark
FROM p WHERE list_sum(list_transform(parts, lambda x: x.w)) >= 5"""


_TRANSITIONS = """tr AS (SELECT from_activity, to_activity, count(*) AS "count" FROM (SELECT found[1] AS from_activity, lead(found[1]) OVER (PARTITION BY pdf_path ORDER BY op_index, op_id) AS to_activity FROM tagged WHERE remark IS NOT NULL) WHERE to_activity IS NOT NULL GROUP BY 1, 2)"""


def _analytics_sql() -> dict[str, str]:
    t = _cte(tagged_sql())
    failures = ", ".join(f"'{x}'" for x in activity.FAILURES)
    return {
        "activity_tags": t + "SELECT op_id, pdf_path, well_family, report_date, main_activity, sub_activity, state, found[1] AS primary_label, array_to_string(found[1:3], '|') AS all_labels, substr(remark, 1, 200) AS remark_preview FROM tagged",
        "failure_patterns": t + f""", f AS (SELECT * FROM (SELECT well_family, pdf_path, op_index, op_id, remark, unnest(found[1:3]) AS failure_label FROM tagged) WHERE failure_label IN ({failures})),
c AS (SELECT well_family, failure_label, count(*) AS "count", row_number() OVER (PARTITION BY well_family ORDER BY count(*) DESC, failure_label) AS r FROM f GROUP BY 1, 2 HAVING count(*) >= 2),
s AS (SELECT well_family, failure_label, string_agg(substr(remark, 1, 160), ' || ' ORDER BY k) AS sample_remarks FROM (SELECT *, row_number() OVER (PARTITION BY well_family, failure_label ORDER BY pdf_path, op_index, op_id) AS k FROM f) WHERE k <= 3 GROUP BY 1, 2)
SELECT c.well_family, c.failure_label, c."count", s.sample_remarks FROM c JOIN s ON c.well_family = s.well_family AND c.failure_label = s.failure_label WHERE r <= 10""",
        "severity_scores": _severity_sql(),
        "activity_transitions": t + f", {_TRANSITIONS} SELECT * FROM tr",
        "transition_matrix_top": t + f", {_TRANSITIONS}, o AS (SELECT from_activity AS label FROM tr GROUP BY 1 ORDER BY sum(\"count\") DESC, 1 LIMIT 12) SELECT * FROM tr WHERE from_activity IN (SELECT label FROM o) AND to_activity IN (SELECT label FROM o)",
        "label_distribution": t + "SELECT found[1] AS primary_label, count(*) AS n FROM tagged GROUP BY 1",
        "activity_crosstab": t + "SELECT well_family, primary_label, round(CAST(100.0 AS DOUBLE) * n / sum(n) OVER (PARTITION BY well_family), 4) AS percent FROM (SELECT well_family, found[1] AS primary_label, count(*) AS n FROM tagged GROUP BY 1, 2)",
        "role_transitions": "SELECT from_role, to_role, count(*) AS n FROM (SELECT role AS from_role, lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role) AS to_role FROM conversations) WHERE to_role IS NOT NULL GROUP BY 1, 2",
    }


# ---- inspection -----------------------------------------------------------------------------------


def reports_per_well(spark, d):
    return mining.reports_per_well(report_rows(spark, d))


def ops_per_well(spark, d):
    return mining.ops_per_well(ops(spark, d))


def parse_quality(spark, d):
    return mining.frequencies(report_rows(spark, d), "parse_quality")


def top_activity_pairs(spark, d):
    return mining.frequencies(ops(spark, d), "main_activity", "sub_activity", top=20, present=True)


def reports_per_well_year(spark, d):
    return mining.reports_per_well_year(report_rows(spark, d))


def pivot_year(spark, d):
    return mining.pivot_years(report_rows(spark, d), [2023, 2024]).withColumnsRenamed({"2023": "y2023", "2024": "y2024"})


def table_counts(spark, d):
    names = ["documents", "pages", "benchmark", "conversations", "embeddings"]
    return mining.table_counts({n: table(spark, d, n) for n in names} | {"gas_reading": None})


def error_summary(spark, d):
    """What the decoder of a load could not read, by stage and message: pages as files, some of which are no text of a page."""
    pages = table(spark, d, "pages").select(F.concat("url", F.lit("#"), "page_id").alias("path"), F.encode("html", "utf-8").alias("content"))
    _, bad = files.decode_reports(pages, page_text)
    return mining.frequencies(bad, "stage", "error_message")


def page_text(content: bytes) -> list[str]:
    """The paragraphs of a page; a page without any cannot be read."""
    html = content.decode()
    if "<p>" not in html.lower():
        raise ValueError("no paragraph")
    if len(html) > 4000:
        raise MemoryError(f"{len(html) // 1000} thousand characters")
    return [html]


def distinct_counts(spark, d):
    return mining.distinct_counts(ops(spark, d), "pdf_path", "well_family", "main_activity", "state")


def score_histogram(spark, d):
    return mining.histogram(ops(spark, d), "end_depth_md", 0, 3200, 16)


def unknown_wells(spark, d):
    return mining.unknown_wells(event_rows(spark), ops(spark, d))


def containment(spark, d):
    """Remarks that name a word in any case, by family; a null remark does not."""
    hit = F.coalesce(F.col("remark").ilike("%casing%"), F.lit(False))
    return ops(spark, d).groupBy("well_family").agg(F.count_if(hit).alias("n_hits"), F.count_if(~hit).alias("n_rest"))


def _inspection_sql() -> dict[str, str]:
    o, r = _cte(OPS), _cte(REPORTS)
    year = "SELECT well_family, CAST(year(report_date) AS INT) AS year, count(*) AS n_reports FROM reports GROUP BY 1, 2"
    return {
        "reports_per_well": r + "SELECT well_family, count(*) AS n_reports, min(report_date) AS first_report, max(report_date) AS last_report FROM reports GROUP BY 1",
        "ops_per_well": o + "SELECT well_family, count(*) AS n_ops, count(DISTINCT pdf_path) AS n_pdfs, count(*) FILTER (WHERE state = 'fail') AS n_fail FROM ops GROUP BY 1",
        "parse_quality": r + "SELECT parse_quality, count(*) AS n FROM reports GROUP BY 1",
        "top_activity_pairs": o + "SELECT main_activity, sub_activity, count(*) AS n FROM ops WHERE main_activity IS NOT NULL GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 20",
        "reports_per_well_year": r + year,
        "pivot_year": r + f"SELECT well_family, CAST(coalesce(sum(n_reports) FILTER (WHERE year = 2023), 0) AS BIGINT) AS y2023, CAST(coalesce(sum(n_reports) FILTER (WHERE year = 2024), 0) AS BIGINT) AS y2024 FROM ({year}) GROUP BY 1",
        "table_counts": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in ("documents", "pages", "benchmark", "conversations", "embeddings")) + " UNION ALL SELECT 'gas_reading', -1",
        "error_summary": "SELECT 'parse' AS stage, CASE WHEN NOT contains(lower(html), '<p>') THEN 'ValueError: no paragraph' ELSE 'MemoryError: ' || CAST(length(html) // 1000 AS VARCHAR) || ' thousand characters' END AS error_message, count(*) AS n FROM pages WHERE NOT contains(lower(html), '<p>') OR length(html) > 4000 GROUP BY 1, 2",
        "distinct_counts": o + "SELECT count(DISTINCT pdf_path) AS n_pdf_path, count(DISTINCT well_family) AS n_well_family, count(DISTINCT main_activity) AS n_main_activity, count(DISTINCT state) AS n_state FROM ops",
        "score_histogram": o + "SELECT least(CAST(floor(end_depth_md / 200) AS BIGINT) + 1, 16) AS bin, count(*) AS n FROM ops GROUP BY 1",
        "unknown_wells": o + f"SELECT DISTINCT replace(replace(w, '/', '_'), '-', '_') AS well_family FROM (VALUES {', '.join(f"('{e[1]}')" for e in EVENTS)}) t(w) WHERE replace(replace(w, '/', '_'), '-', '_') NOT IN (SELECT well_family FROM ops)",
        "containment": o + "SELECT well_family, count(*) FILTER (WHERE coalesce(remark ILIKE '%casing%', false)) AS n_hits, count(*) FILTER (WHERE NOT coalesce(remark ILIKE '%casing%', false)) AS n_rest FROM ops GROUP BY 1",
    }


# ---- scalar functions ---------------------------------------------------------------------------


def convert_values(spark, d):
    """Values of many kinds, made from orders, converted."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey") % 8
    raw = F.when(k == 0, "-999.99").when(k == 1, F.concat(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit(" g/cm3"))).when(k == 2, " N/A ").when(k == 3, "1,5 m").when(k == 4, "Yes").when(k == 5, "no").when(k == 6, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 25:00"))).otherwise(F.concat(F.lit("on "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("  12:30")))
    return o.select("o_orderkey", raw.alias("raw")).select("o_orderkey", convert.as_text(F.col("raw")).alias("as_text"), convert.as_double(F.col("raw")).alias("as_double"), convert.as_int(F.col("raw")).alias("as_int"), convert.as_bool(F.col("raw")).alias("as_bool"), convert.as_timestamp(F.col("raw")).alias("as_timestamp"), convert.as_date(F.col("raw")).alias("as_date"))


def filename_parse(spark, d):
    r = report_rows(spark, d).select(F.when(F.col("n_ops") % 5 == 0, F.concat(F.lit("x"), F.col("pdf_path"))).when(F.col("n_ops") % 5 == 1, F.replace(F.col("pdf_path"), F.lit("_2024_01"), F.lit("_2024_13"))).otherwise(F.concat(F.lit("dir/"), F.col("pdf_path"))).alias("path"))
    p = text.file_parts(F.col("path"))
    return r.select("path", p["prefix"].alias("prefix"), p["family"].alias("family"), p["report_date"].alias("report_date"))


def abbrev_expand(spark, d):
    return ops(spark, d).where("remark is not null").select("op_id", text.index_text(F.col("remark")).alias("expanded"))


def query_clean(spark, d):
    b = table(spark, d, "benchmark").select("item_id", F.concat(F.lit('""'), F.col("text"), F.lit(' excesive  load at at 26"""" ')).alias("t"))
    return b.select("item_id", text.clean_query(F.col("t")).alias("cleaned"))


def compact_number(spark, d):
    return table(spark, d, "lineitem").select((F.col("l_quantity") * F.col("l_discount") * 100).cast("decimal(12,3)").cast("double").alias("x"), F.col("l_extendedprice").alias("y")).distinct().select("x", "y", convert.compact(F.col("x")).alias("x_text"), convert.compact(F.floor("y").cast("double")).alias("y_text"))


def well_keys(spark, d):
    o = table(spark, d, "customer").select("c_custkey", F.concat(F.lit(" 15/9-F "), (F.col("c_custkey") % 20).cast("string"), F.lit("/-")).alias("w"))
    return o.select("c_custkey", text.well_key(F.col("w")).alias("family"))


def text_normalize(spark, d):
    """Report text with the artifacts of page layout put right."""
    r = report_rows(spark, d)
    noisy = F.concat(F.lit("WWeellllbboorree::  "), F.col("well_family"), F.lit("\nStart Start time time Summar\ny of circ ulating at 23:00 00:00, letter\tok ok: ok: "), F.col("pdf_path"))
    return r.select("pdf_path", text.normalize_report(noisy).alias("normalized"))


def pages_scan(spark, d):
    """Raw pages as documents: markup off, white space squeezed, basename of the address."""
    p = table(spark, d, "pages")
    plain = convert.strip(F.regexp_replace(F.regexp_replace("html", "<[^>]*>", " "), r"\s+", " "))
    return p.select("page_id", F.element_at(F.split("url", "/"), -1).alias("basename"), F.length(plain).cast("long").alias("n_chars"), F.substring(plain, 1, 120).alias("start"))


def _case(items: list[tuple[str, str]], expr: str) -> str:
    for p, r in items:
        expr = f"regexp_replace({expr}, {_quote(p)}, {_quote(r)}, 'gi')"
    return expr


def _scalar_sql() -> dict[str, str]:
    o, r = _cte(OPS), _cte(REPORTS)
    day = "strftime(o_orderdate, '%Y-%m-%d')"
    price = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE)"
    short = [(rf"\b{a}\b" if a.isalnum() else "", f"{a} ({x})") for a, x in sorted(text.ABBREVIATIONS.items(), key=lambda kv: -len(kv[0])) if a.isalnum()]
    slashed = [(rf"(^|[^A-Za-z0-9]){a}($|[^A-Za-z0-9])", rf"\1{a} ({x})\2") for a, x in sorted(text.ABBREVIATIONS.items(), key=lambda kv: -len(kv[0])) if not a.isalnum()]
    return {
        "convert_values": f"""SELECT o_orderkey,
CASE o_orderkey % 8 WHEN 0 THEN '-999.99' WHEN 1 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || ' g/cm3' WHEN 2 THEN NULL WHEN 3 THEN '1,5 m' WHEN 4 THEN 'Yes' WHEN 5 THEN 'no' WHEN 6 THEN {day} || ' 25:00' ELSE 'on ' || {day} || '  12:30' END AS as_text,
CASE o_orderkey % 8 WHEN 1 THEN {price} WHEN 3 THEN 1.5 WHEN 6 THEN CAST(year(o_orderdate) AS DOUBLE) WHEN 7 THEN CAST(year(o_orderdate) AS DOUBLE) END AS as_double,
CAST(CASE o_orderkey % 8 WHEN 1 THEN trunc({price}) WHEN 3 THEN 1 WHEN 6 THEN year(o_orderdate) WHEN 7 THEN year(o_orderdate) END AS INT) AS as_int,
CASE o_orderkey % 8 WHEN 4 THEN true WHEN 5 THEN false END AS as_bool,
CASE o_orderkey % 8 WHEN 6 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) WHEN 7 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 750 MINUTE END AS as_timestamp,
CASE WHEN o_orderkey % 8 >= 6 THEN CAST(o_orderdate AS DATE) END AS as_date FROM orders""",
        "abbrev_expand": o + f"SELECT op_id, {_case(slashed + short, 'remark')} AS expanded FROM ops WHERE remark IS NOT NULL",
        "well_keys": "SELECT c_custkey, '15_9_F_' || CAST(c_custkey % 20 AS VARCHAR) AS family FROM customer",
        "compact_number": "SELECT x, y, format('{:g}', x) AS x_text, format('{:g}', floor(y)) AS y_text FROM (SELECT DISTINCT CAST(CAST(l_quantity * l_discount * 100 AS DECIMAL(12,3)) AS DOUBLE) AS x, l_extendedprice AS y FROM lineitem)",
        "text_normalize": r + "SELECT pdf_path, 'Wellbore: ' || well_family || chr(10) || 'Start time Summary of circulating at 23:00 00:00, letter ok: ' || pdf_path AS normalized FROM reports",
        "filename_parse": r + match_sql.filename_sql(),
        "query_clean": f"""SELECT item_id, {match_sql.clean("('\"\"' || text || ' excesive  load at at 26\"\"\"\" ')")} AS cleaned FROM benchmark""",
        "pages_scan": r"SELECT page_id, string_split(url, '/')[-1] AS basename, CAST(length(p) AS BIGINT) AS n_chars, substr(p, 1, 120) AS start FROM (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS p FROM pages)",
    }


# ---- entities -------------------------------------------------------------------------------------


def ner_entities(spark, d):
    return mining.entity_rows(ops(spark, d), entities.entities(F.col("remark")))


def ner_label_counts(spark, d):
    return mining.frequencies(ner_entities(spark, d), "entity_label")


def ner_times(spark, d):
    return ner_entities(spark, d).where("entity_label = 'TIME'").select("op_id", "entity_value", "char_start", "char_end")


def entity_sets(spark, d):
    s = entities.entity_sets(F.col("op_text"))
    return ops(spark, d).select("op_id", *[F.array_join(F.transform(s[n], lambda x: x.cast("string")), ",").alias(n) for n in entities.WEIGHTS])


def entity_overlap(spark, d):
    q = entities.entity_sets(F.lit('Tight hole at 500 m on 17.5" BHA, POOH'))
    return ops(spark, d).select("op_id", F.round(entities.overlap(entities.entity_sets(F.col("op_text")), q), 6).alias("overlap"))


def problem_counts(spark, d):
    s = entities.entity_sets(F.col("op_text"))
    return ops(spark, d).select(F.explode(s["problems"]).alias("problem")).groupBy("problem").agg(F.count("*").alias("n"))


def _entity_sql() -> dict[str, str]:
    o = _cte(OPS)
    words = "|".join(sorted(entities.PROBLEMS, key=len, reverse=True))
    found = o.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + ", " + match_sql.entity_ctes()
    four, asked = match_sql.sets("op_text"), match_sql.sets("q")
    listed = lambda of: ", ".join(f"{v} AS {k}" for k, v in of.items())
    return {
        "ner_entities": found + " SELECT f.op_id, o.pdf_path, o.well_family, o.report_date, m AS entity_text, label AS entity_label, value AS entity_value, unit AS entity_unit, CAST(s - 1 AS INT) AS char_start, CAST(e - 1 AS INT) AS char_end FROM found f JOIN ops o ON f.op_id = o.op_id",
        "ner_label_counts": found + " SELECT label AS entity_label, count(*) AS n FROM found GROUP BY 1",
        "entity_sets": o + f"SELECT op_id, {', '.join(f"coalesce(array_to_string({v}, ','), '') AS {k}" for k, v in four.items())} FROM ops",
        "entity_overlap": o.rstrip() + f", e AS (SELECT {listed(asked)} FROM (SELECT 'Tight hole at 500 m on 17.5\" BHA, POOH' AS q)), s AS (SELECT op_id, {listed(four)} FROM ops) SELECT op_id, round({match_sql.overlap('s', 'e')}, 6) AS overlap FROM s, e",
        "ner_times": o + r"SELECT op_id, m AS entity_value, CAST(instr(remark, m) - 1 AS INT) AS char_start, CAST(instr(remark, m) + 4 AS INT) AS char_end FROM (SELECT op_id, remark, unnest(regexp_extract_all(remark, '\b(?:[01]\d|2[0-3]):[0-5]\d\b')) AS m FROM ops WHERE remark <> '')",
        "problem_counts": o + f"SELECT problem, count(*) AS n FROM (SELECT DISTINCT op_id, lower(unnest(regexp_extract_all(op_text, '(?i)\\b({words})\\b', 1))) AS problem FROM ops) GROUP BY 1",
    }


# ---- retrieval --------------------------------------------------------------------------------------


def report_documents(spark, d):
    return retrieval.report_documents(report_rows(spark, d), ops(spark, d))


def tfidf_keywords(spark, d):
    docs = report_documents(spark, d)
    return retrieval.top_keywords(docs, "pdf_path", "doc_text", docs.count()).join(docs.select("pdf_path", "pdf_filename", "well_family"), "pdf_path")


def keywords_head(spark, d):
    """The keywords of the first three reports."""
    return mining.sample_rows(tfidf_keywords(spark, d), "pdf_filename", 3, seed=None)


def nlp_summary(spark, d):
    o = ops(spark, d)
    return mining.run_summary({"operations": o, "reports": report_rows(spark, d), "activity_rows": mining.activity_tags(o), "keyword_rows": tfidf_keywords(spark, d), "failure_rows": mining.failure_patterns(o), "severity_rows": mining.severity_scores(o), "transitions": mining.transitions(o)})


def document_keywords(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return retrieval.top_keywords(docs, "doc_id", "text", docs.count(), most=0.6)


def keywords_per_well(spark, d):
    return mining.keywords_per_well(tfidf_keywords(spark, d))


def tfidf_match(spark, d):
    o = ops(spark, d).where("length(trim(op_text)) > 0")
    return retrieval.sparse_top(event_rows(spark), o, 5, o.count()).select("event_id", "op_id", "rank", F.round("score", 6).alias("score"))


def _vectors(spark, d):
    """Unit vectors for operations and events: the embeddings table stands in for a sentence encoder."""
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    n = v.count()
    docs = ops(spark, d).select("op_id", (F.col("op_id") % n).alias("vec_id")).join(v, "vec_id").select("op_id", F.col("embedding").alias("vec"))
    return docs, v.where("vec_id between 1 and 4").select(F.col("vec_id").cast("int").alias("event_id"), F.col("embedding").alias("qvec"))


def dense_topk(spark, d):
    """Nearest vectors of the stated ones (every id divisible by 100), against all."""
    v = table(spark, d, "embeddings")
    q = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("event_id"), F.col("embedding").alias("qvec"))
    return retrieval.nearest(q, v.select(F.col("vec_id").alias("op_id"), F.col("embedding").alias("vec")), 10)


def matches(spark, d):
    docs, q = _vectors(spark, d)
    return retrieval.match(event_rows(spark), ops(spark, d), docs, q)


def match_benchmark(spark, d):
    return retrieval.benchmark(matches(spark, d))


def matching_summary(spark, d):
    m = matches(spark, d)
    return mining.matching_summary(event_rows(spark), m, retrieval.benchmark(m))


def _retrieval_sql() -> dict[str, str]:
    stop = ", ".join(_quote(w) for w in sorted({*retrieval.english_stop_words(), *retrieval.DOMAIN_STOP}))
    docs = """docs AS (SELECT r.pdf_path, string_split(r.pdf_path, '/')[-1] AS pdf_filename, r.well_family, regexp_replace(coalesce(summary_24h, '') || chr(10) || coalesce(planned_24h, '') || chr(10) || coalesce(t, ''), '^\\s+|\\s+$', '', 'g') AS doc_text, coalesce(n, 0) AS n_ops
FROM reports r LEFT JOIN (SELECT pdf_path, string_agg(remark, chr(10) ORDER BY op_index, op_id) AS t, count(*) AS n FROM ops WHERE remark IS NOT NULL GROUP BY 1) s ON r.pdf_path = s.pdf_path)"""

    def weights(src: str, key: str, txt: str, pattern: str, words: str, least: str, most: str, group: str) -> str:
        return f"""tok AS (SELECT {key}, list_filter(regexp_extract_all(lower({txt}), '{pattern}'), lambda w: {words}) AS ws FROM {src} WHERE length({txt}) > 0),
trm AS (SELECT {key}, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS term FROM tok),
cnt AS (SELECT {key}, term, count(*) AS tf FROM trm GROUP BY 1, 2),
idf AS (SELECT term, ln((1.0 + N.n) / (1.0 + count(*))) + 1.0 AS idf FROM cnt, (SELECT count(*) AS n FROM {src}) N GROUP BY term, N.n HAVING count(*) >= {least} AND count(*) <= CAST({most} AS DOUBLE) * N.n),
raw AS (SELECT {key}, cnt.term, (1.0 + ln(tf)) * idf AS w FROM cnt JOIN idf ON cnt.term = idf.term),
{group} AS (SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM raw)"""

    word = r"\b[a-zA-Z][a-zA-Z\-]{2,}\b"
    ranked = lambda key: f"SELECT {key}, rank, keyword, tfidf_score FROM (SELECT {key}, term AS keyword, round(weight, 6) AS tfidf_score, CAST(row_number() OVER (PARTITION BY {key} ORDER BY round(weight, 6) DESC, term) AS INT) AS rank FROM wt) WHERE rank <= 10 AND tfidf_score > 0"
    keywords = weights("docs", "pdf_path", "doc_text", word, f"w NOT IN ({stop})", "3", "0.6", "wt")
    named = f"SELECT k.*, r.pdf_filename, r.well_family FROM ({ranked('pdf_path')}) k JOIN docs r ON k.pdf_path = r.pdf_path"
    # letters beyond ASCII count as word characters that no keyword holds
    plain = r"plain AS (SELECT doc_id, regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{M}\p{Nd}\p{Pc}\x00-\x7F]', ' ', 'g'), '[^\x00-\x7F]', '_', 'g') AS t FROM documents)"
    matched = _cte(OPS, match_sql.match_ctes(EVENTS))
    known = _analytics_sql()
    counted = {"operations": _cte(OPS) + "SELECT * FROM ops", "reports": _cte(REPORTS) + "SELECT * FROM reports", "activity_rows": known["activity_tags"], "keyword_rows": _cte(OPS, REPORTS, docs, keywords) + ranked("pdf_path"), "failure_rows": known["failure_patterns"], "severity_rows": known["severity_scores"], "transitions": known["activity_transitions"]}
    dots = "round(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 6)"
    return {
        "report_documents": _cte(OPS, REPORTS, docs) + "SELECT * FROM docs",
        "tfidf_keywords": _cte(OPS, REPORTS, docs, keywords) + named,
        "keywords_head": _cte(OPS, REPORTS, docs, keywords) + f"SELECT * FROM ({named}) WHERE pdf_filename IN (SELECT DISTINCT pdf_filename FROM ({named}) ORDER BY 1 LIMIT 3)",
        "document_keywords": _cte(plain, weights("plain", "doc_id", "t", word, f"w NOT IN ({stop})", "3", "0.6", "wt")) + ranked("doc_id"),
        "tfidf_match": _cte(OPS, match_sql.sparse_ctes(EVENTS)) + "SELECT event_id, op_id, rank, round(score, 6) AS score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY event_id ORDER BY score DESC, op_id) AS INT) AS rank FROM sparse) WHERE rank <= 5",
        "matches": matched + "SELECT * FROM matches",
        "match_benchmark": matched + "SELECT * FROM bench",
        "matching_summary": matched + "SELECT * FROM (SELECT count(*) AS n_events, count(*) FILTER (WHERE has_pdf_corpus) AS n_strict_events, count(*) FILTER (WHERE NOT has_pdf_corpus) AS n_fallback_events FROM ev), (SELECT count(*) AS n_match_rows FROM matches), (SELECT count(*) AS n_benchmark_rows, count(*) FILTER (WHERE all_methods_agree) AS all_methods_agree FROM bench), (SELECT CAST(4 AS INT) AS n_methods, CAST(5 AS INT) AS top_k)",
        "nlp_summary": f"SELECT * FROM {', '.join(f'(SELECT count(*) AS n_{n} FROM ({q}))' for n, q in counted.items())}",
        "keywords_per_well": _cte(OPS, REPORTS, docs, keywords) + f"SELECT well_family, keyword, n_reports FROM (SELECT r.well_family, keyword, count(*) AS n_reports, row_number() OVER (PARTITION BY r.well_family ORDER BY count(*) DESC, keyword) AS k FROM ({ranked('pdf_path')}) x JOIN reports r ON x.pdf_path = r.pdf_path GROUP BY 1, 2) WHERE k <= 20",
        "dense_topk": f"SELECT event_id, op_id, score, CAST(rank AS INT) AS rank FROM (SELECT q.vec_id AS event_id, v.vec_id AS op_id, {dots} AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY {dots} DESC, v.vec_id) AS rank FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0) WHERE rank <= 10",
    }


# ---- report parsing ---------------------------------------------------------------------------------


def report_texts(spark, d):
    """A templated text for each report, in the layout that the parsers read."""
    n = F.col("n_ops").cast("string")
    line = F.concat("start_time", F.lit(" "), "end_time", F.lit(" "), F.col("end_depth_md").cast("int").cast("string"), F.lit(" "), "main_activity", F.coalesce(F.concat(F.lit(" - "), F.col("sub_activity")), F.lit("")), F.lit(" "), "state", F.lit(" "), F.coalesce(F.nullif(F.regexp_replace("remark", r"\d{2}:\d{2}", "noon"), F.lit("")), F.lit("none given")))
    rows = ops(spark, d).select("pdf_path", "op_index", line.alias("line")).groupBy("pdf_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("op_index", "line"))), lambda x: x["line"]), "\n").alias("lines"))
    r = report_rows(spark, d).join(rows, "pdf_path")
    return r.select("pdf_path", "n_ops", "summary_24h", "planned_24h", "well_family", F.concat(
        F.lit("Summary report\nWellbore: "), "well_family", F.lit(" Period: "), F.col("report_date").cast("string"), F.lit(" 00:00 - "), F.date_add("report_date", 1).cast("string"), F.lit(" 00:00\nReport number: "), n,
        F.lit(" Operator: North Sea Drilling Depth\nDepth mMd: 2"), n, F.lit(".5 Tight well: Y HPHT: N\nHole Dia (in): 17.5 Dist Drilled (m): -999.99\nSummary of activities (24 Hours)\n"), "summary_24h",
        F.lit("\nSummary of planned activities (24 Hours)\n"), F.coalesce("planned_24h", F.lit("")),
        F.lit("\nOperations\nStart time End time End Depth mMD Main - Sub Activity State Remark\n"), "lines",
        F.lit("\nDrilling Fluid\nSample Time 03:30 11:30\nSample Point Flowline Flowline\nSample Depth mMD 2445 2"), n, F.lit("\nFluid Type OBM-Standard OBM-Standard\nFluid Density (g/cm3) 1.43\nPore Pressure\nTime Depth mMD Equ Mud Weight (g/cm3) Reading\n00:00 2"), n,
        F.lit(" 1.2 estimated\nSurvey Station\nDepth mMD Depth mTVD Inclination (dega) Azimuth (dega) Comment\n2431.4 2304.8 27.16 209.96\n2472.5 2341.2 28.2 2"), n,
        F.lit("\nLithology Information\nStart Depth mMD End Depth mMD\n2474 2531 2345 2391 Shale, tuff\nand minor dolomite\n2531 2591 2391 2"), n, F.lit(" Shale\nGas Reading Information\nTime Class\n08:15 drilling gas peak\n")).alias("text"))


def _parsed(spark, d):
    return reports.parse_reports(report_texts(spark, d).select("pdf_path", "text"))


def parse_header(spark, d):
    return _parsed(spark, d).select("pdf_path", "well_prefix", "well_family", "report_date", "wellbore_id", "report_number", "operator", "depth_md", "tight_well", "hpht", "hole_dia_in", "dist_drilled_m", "period_start", "period_end", "summary_24h", "planned_24h", "parse_quality")


def parse_operations(spark, d):
    return reports.child_table(_parsed(spark, d).select("pdf_path", "well_family", "well_prefix", "report_date", "operations"), "operations").drop("op_id", "report_date", "well_prefix")


def parse_fluid(spark, d):
    return reports.child_table(_parsed(spark, d), "drilling_fluid").select("fluid_id", "pdf_path", "sample_index", "sample_time", "sample_point", "sample_depth_md", "fluid_type", "fluid_density_gcm3", "funnel_visc_s")


def parse_pore(spark, d):
    return reports.child_table(_parsed(spark, d), "pore_pressure").select("pp_id", "pdf_path", "reading_index", "sample_time", "depth_md", "equ_mud_weight_gcm3", "reading_type")


def parse_survey(spark, d):
    return reports.child_table(_parsed(spark, d), "survey_station").select("survey_id", "pdf_path", "station_index", "depth_md", "depth_tvd", "inclination_deg", "azimuth_deg")


def parse_lithology(spark, d):
    return reports.child_table(_parsed(spark, d), "lithology").select("litho_id", "pdf_path", "interval_index", "start_depth_md", "end_depth_md", "start_depth_tvd", "end_depth_tvd", "lithology_description")


def parse_gas(spark, d):
    return reports.child_table(_parsed(spark, d), "gas_reading").select("gas_id", "pdf_path", "reading_index", "sample_time", "gas_class", "c1_ppm")


def _parse_sql() -> dict[str, str]:
    r, o = _cte(REPORTS), _cte(OPS)
    ids = "CAST(row_number() OVER (ORDER BY pdf_path, {k}) AS BIGINT)"
    return {
        "parse_header": r + "SELECT pdf_path, well_prefix, well_family, report_date, well_family AS wellbore_id, CAST(n_ops AS INT) AS report_number, 'North Sea Drilling' AS operator, CAST('2' || CAST(n_ops AS VARCHAR) || '.5' AS DOUBLE) AS depth_md, true AS tight_well, false AS hpht, CAST(17.5 AS DOUBLE) AS hole_dia_in, CAST(NULL AS DOUBLE) AS dist_drilled_m, CAST(report_date AS TIMESTAMP) AS period_start, CAST(report_date AS TIMESTAMP) + INTERVAL 1 DAY AS period_end, summary_24h, planned_24h, 'full' AS parse_quality FROM reports",
        "parse_operations": o + r"SELECT pdf_path, well_family, op_index, start_time, end_time, end_depth_md, main_activity, sub_activity, state, rem AS remark, concat_ws(' | ', main_activity, sub_activity, state, rem) AS op_text FROM (SELECT *, coalesce(nullif(regexp_replace(remark, '\d{2}:\d{2}', 'noon', 'g'), ''), 'none given') AS rem FROM ops)",
        "parse_fluid": r + f"SELECT {ids.format(k='i')} AS fluid_id, pdf_path, CAST(i AS INT) AS sample_index, CASE i WHEN 0 THEN '03:30' ELSE '11:30' END AS sample_time, 'Flowline' AS sample_point, CASE i WHEN 0 THEN CAST(2445 AS DOUBLE) ELSE CAST('2' || CAST(n_ops AS VARCHAR) AS DOUBLE) END AS sample_depth_md, 'OBM-Standard' AS fluid_type, CASE i WHEN 0 THEN CAST(1.43 AS DOUBLE) END AS fluid_density_gcm3, CAST(NULL AS DOUBLE) AS funnel_visc_s FROM reports, range(2) t(i)",
        "parse_pore": r + f"SELECT {ids.format(k='1')} AS pp_id, pdf_path, CAST(0 AS INT) AS reading_index, '00:00' AS sample_time, CAST('2' || CAST(n_ops AS VARCHAR) AS DOUBLE) AS depth_md, CAST(1.2 AS DOUBLE) AS equ_mud_weight_gcm3, 'estimated' AS reading_type FROM reports",
        "parse_survey": r + f"SELECT {ids.format(k='i')} AS survey_id, pdf_path, CAST(i AS INT) AS station_index, CAST(CASE i WHEN 0 THEN 2431.4 ELSE 2472.5 END AS DOUBLE) AS depth_md, CAST(CASE i WHEN 0 THEN 2304.8 ELSE 2341.2 END AS DOUBLE) AS depth_tvd, CAST(CASE i WHEN 0 THEN 27.16 ELSE 28.2 END AS DOUBLE) AS inclination_deg, CASE i WHEN 0 THEN CAST(209.96 AS DOUBLE) ELSE CAST('2' || CAST(n_ops AS VARCHAR) AS DOUBLE) END AS azimuth_deg FROM reports, range(2) t(i)",
        "parse_lithology": r + f"SELECT {ids.format(k='i')} AS litho_id, pdf_path, CAST(i AS INT) AS interval_index, CAST(CASE i WHEN 0 THEN 2474 ELSE 2531 END AS DOUBLE) AS start_depth_md, CAST(CASE i WHEN 0 THEN 2531 ELSE 2591 END AS DOUBLE) AS end_depth_md, CAST(CASE i WHEN 0 THEN 2345 ELSE 2391 END AS DOUBLE) AS start_depth_tvd, CASE i WHEN 0 THEN CAST(2391 AS DOUBLE) ELSE CAST('2' || CAST(n_ops AS VARCHAR) AS DOUBLE) END AS end_depth_tvd, CASE i WHEN 0 THEN 'Shale, tuff and minor dolomite' ELSE 'Shale' END AS lithology_description FROM reports, range(2) t(i)",
        "parse_gas": r + f"SELECT {ids.format(k='1')} AS gas_id, pdf_path, CAST(0 AS INT) AS reading_index, '08:15' AS sample_time, 'drilling gas peak' AS gas_class, CAST(NULL AS DOUBLE) AS c1_ppm FROM reports",
    }


QUERIES = [
    activity_transitions, activity_tags, failure_patterns, severity_scores, transition_matrix_top, label_distribution, activity_crosstab, role_transitions,
    reports_per_well, ops_per_well, parse_quality, top_activity_pairs, reports_per_well_year, pivot_year, table_counts, error_summary, distinct_counts, score_histogram, unknown_wells, containment,
    convert_values, filename_parse, abbrev_expand, query_clean, compact_number, well_keys, text_normalize, pages_scan,
    ner_entities, ner_label_counts, ner_times, entity_sets, entity_overlap, problem_counts,
    report_documents, tfidf_keywords, document_keywords, keywords_per_well, keywords_head, nlp_summary, tfidf_match, dense_topk, matches, match_benchmark, matching_summary,
    parse_header, parse_operations, parse_fluid, parse_pore, parse_survey, parse_lithology, parse_gas,
]


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return _analytics_sql() | _inspection_sql() | _scalar_sql() | _entity_sql() | _retrieval_sql() | _parse_sql()
