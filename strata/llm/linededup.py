"""Line deduplication by site-relative frequency (operator 7).

Pages are grouped by host. For each line (white space at its ends aside) the
pages of the host that hold it are divided by all pages of the host; lines over
the ratio are boilerplate and are dropped from every page of that host. A line
needs MIN_PAGES pages as well, so that a host of few pages loses nothing by
chance.

Lines are counted by two 64-bit hashes, combined before the shuffle. The
boilerplate lines of a host are few whatever its size: at most the mean number
of distinct lines of its pages, divided by the ratio. They are written as one
short array a host. Where all hosts' lines together stay below a counted bound
they are broadcast, so texts are never exchanged; beyond it the pages of a host
are dealt over SALTS parts, each of which meets a copy of the host's lines.

Cases: null text stays null and is a page without lines; a null host is a host
of its own; blank lines are kept and never counted; a line that a page repeats
counts once for that page, and all its places are dropped; equal rows are pages
each; an empty table has no rows; other columns are kept, save for those that
share a name with an added one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SMALL_ROWS, materialize

RATIO, MIN_PAGES = 0.1, 5
#: parts of a host's pages, where its lines are not broadcast
SALTS = 64
SPACE = " \t\n\x0b\x0c\r"


def _key(line: Column) -> Column:
    line = F.btrim(line, F.lit(SPACE))
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit(7)).alias("b"))


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): the keys of the boilerplate lines of each host that has any."""
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    exploded = pages.select(F.col(host).alias("_host"), F.explode(F.array_distinct(F.transform(lines, _key))).alias("k"))
    seen = exploded.groupBy("_host", "k.a", "k.b").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = pages.groupBy(F.col(host).alias("_host")).agg(F.count("*").alias("pages"))
    often = seen.join(totals, seen["_host"].eqNullSafe(totals["_host"])).where(F.col("n") > F.lit(ratio) * F.col("pages"))
    return often.groupBy(totals["_host"].alias("_host")).agg(F.collect_list(F.struct("a", "b")).alias("_lines"))


def _with_lines(pages: DataFrame, found: DataFrame, host: str, text: str, keys: int) -> DataFrame:
    """pages with the _lines of their host, of `keys` keys in all."""
    same = pages[host].eqNullSafe(found["_host"])
    if keys <= SMALL_ROWS:  # two longs a key
        return pages.join(F.broadcast(found), same, "left")
    copies = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = pages.withColumn("_part", F.pmod(F.xxhash64(text), F.lit(SALTS)).cast("int"))
    return dealt.join(copies, dealt[host].eqNullSafe(copies["_host"]) & (F.col("_part") == F.col("_salt")), "left").drop("_part", "_salt")


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """pages with the boilerplate lines taken out of the text, and n_lines (lines that are not blank) and n_dropped."""
    pages = pages.drop("n_lines", "n_dropped")
    found = materialize(boilerplate(pages, host, text, ratio, min_pages), "boilerplate")
    joined = _with_lines(pages, found, host, text, found.agg(F.sum(F.size("_lines") + 1)).first()[0] or 0)
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda x: (F.btrim(x, F.lit(SPACE)) == "") | ~F.array_contains(F.col("_lines"), _key(x)))
    out = joined.withColumn("_kept", F.when(F.col("_lines").isNull(), lines).otherwise(kept))
    solid = lambda c: F.size(F.filter(c, lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    out = out.withColumns({"n_lines": F.when(F.col(text).isNull(), 0).otherwise(solid(lines)), "n_dropped": F.when(F.col(text).isNull(), 0).otherwise(F.size(lines) - F.size("_kept"))})
    return out.withColumn(text, F.when(F.col("n_dropped") > 0, F.array_join("_kept", "\n")).otherwise(F.col(text))).drop("_host", "_lines", "_kept")


ORACLE_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, pos, line, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL)),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
often AS (
  SELECT l.source, l.k FROM lines l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source WHERE l.k <> ''
  GROUP BY l.source, l.k, t.pages HAVING count(DISTINCT l.doc_id) >= {MIN_PAGES} AND count(DISTINCT l.doc_id) > CAST({RATIO} AS DOUBLE) * t.pages),
kept AS (
  SELECT l.doc_id, count(*) FILTER (WHERE l.k <> '') AS n_lines, count(*) FILTER (WHERE o.k IS NOT NULL) AS n_dropped,
    string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE o.k IS NULL) AS text
  FROM lines l LEFT JOIN often o ON l.source IS NOT DISTINCT FROM o.source AND l.k = o.k GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, CAST(coalesce(k.n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(k.n_dropped, 0) AS INTEGER) AS n_dropped
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
