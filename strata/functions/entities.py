"""Entities of remarks: spans with offsets for text mining, and sets for reranking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .convert import compact, cut_at, let
from .text import ABBREVIATIONS, _literal

# fixed values: equipment terms, measurement units, problem words
EQUIPMENT = [
    "spear BHA", "drillout BHA", "drilling BHA", "fishing BHA", "hole opener BHA", "FLX packer", "tie back connector",
    "casing running tool", "subsea well head", "blowout preventer", "top drive system", "drill pipe", "drill collar",
    "heavyweight drill pipe", "hole opener", "manual slips", "hydraulic spider", "guide lines", "tension ring",
    "centralizer deck", "stress jnt", "stress joint", "RA source", "power puls", "powerdrive", "manriding", "trip tank",
    "BHA", "BOP", "TDS", "PRS", "MWD", "LWD", "ARC", "ADN", "PDM", "RSS", "HWDP", "DP", "DC", "XO", "FAC", "TBC", "HPDR",
    "LCM", "OBM", "WBM", "HPWBM", "SOBM", "CART", "FIT", "LOT", "shaker", "shakers", "mud pump", "mud pumps", "manifold",
    "stabilizer", "centralizer", "scraper", "kelly", "swivel", "tugger", "flowline", "choke", "annular", "wellhead",
    "casing", "liner", "cement", "cmt head", "cmt hose",
]
UNITS = ["lpm", "rpm", "bar", "MT", "ton", "tons", "kNm", "kN", "psi", "kg/m3", "g/cm3", "sg", "ppg", "klbs", "deg", "degC", "ft", "ft/h", "m/h", "spm", "ppm", "%", "GPM"]
PROBLEMS = [
    "stuck", "stuck pipe", "differential stuck", "differential", "tight hole", "tight", "tight spot", "pack off",
    "pack-off", "packoff", "packed off", "kick", "influx", "loss", "losses", "lost circulation", "fluid loss",
    "lost returns", "twist off", "twist-off", "twistoff", "fishing", "fish", "cuttings", "swabbing", "swab", "surge",
    "leak", "leaking", "stall", "stalled", "wash out", "washout", "washed out", "key seat", "keyseat", "back off",
    "backed off", "ballooning", "overpull", "over pull", "over-pull", "accumulation", "accumulated", "clay", "shale",
    "wellbore instability", "instability",
]
WEIGHTS = {"bit_sizes": 0.40, "depths": 0.10, "problems": 0.30, "equipment": 0.20}


def _any(words: list[str]) -> str:
    return "|".join(_literal(w) for w in sorted(words, key=len, reverse=True))


# fixed values: layouts of sizes, depths, measurements and times
INCH = r"""(?i)(?<![A-Za-z0-9])(\d{1,3})(?:\s+(\d{1,3})\s*[/-]\s*(\d{1,3})|[.,](\d{1,3}))?\s*(?:"|''|\s*in(?:ch(?:es)?)?\b)"""
DEPTH = r"(?i)(?<![A-Za-z0-9])(\d{1,5}(?:[.,]\d{1,3})?)\s*(m\s*MD|mMD|m\s*TVD|mTVD|m)\b"
MEASUREMENT = rf"(?i)(?<![A-Za-z0-9.])(-?\d{{1,6}}(?:[.,]\d{{1,3}})?)\s*({_any(UNITS)})\b"
CLOCK = r"\b((?:[01]\d|2[0-3]):[0-5]\d)\b"
GEAR = rf"(?i)\b(?:{_any(EQUIPMENT)})\b"
RERANK_DEPTH = r"(?i)\b(\d{2,5}(?:[.,]\d{1,3})?)\s*(?:m\s*MD|mMD|m)\b"
RERANK_GEAR = rf"\b({_any([a for a in ABBREVIATIONS if a.isalnum()])})\b"
PROBLEM = rf"(?i)\b({_any(PROBLEMS)})\b"


def spans(text: Column, pattern: str) -> Column:
    """array of struct(s, a, b): every match and its place. The lengths of the pieces between the matches give the offsets."""
    # the empty array fixes the type
    start = F.struct(F.lit(0).alias("at"), F.slice(F.array(F.struct(F.lit("").alias("s"), F.lit(0).alias("a"), F.lit(0).alias("b"))), 1, 0).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"]
        b = a + F.length(x["p"])
        return F.struct(b.alias("at"), F.when(x["m"], F.concat(acc["out"], F.array(F.struct(x["p"].alias("s"), a.alias("a"), b.alias("b"))))).otherwise(acc["out"]).alias("out"))

    pieces = F.transform(cut_at(text, pattern), lambda p, i: F.struct(p.alias("p"), (i % 2 == 1).alias("m")))
    return F.aggregate(pieces, start, step, lambda acc: acc["out"])


def _number(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("double")


def _inches(s: Column) -> Column:
    """The size of a match of INCH; a whole part, and a fraction or decimals."""
    part = lambda i: F.nullif(F.regexp_extract(s, INCH, i), F.lit(""))
    whole, num, den = part(1).try_cast("double"), part(2).try_cast("double"), part(3).try_cast("double")
    return F.when(den > 0, whole + num / den).when(part(4).isNotNull(), F.concat_ws(".", part(1).try_cast("int").cast("string"), part(4)).try_cast("double")).otherwise(whole)


def _entity(x: Column, rank: int, label: str, value: Column, unit: Column) -> Column:
    return F.struct(x["a"].alias("char_start"), F.lit(rank).alias("rank"), (-x["b"]).alias("neg_end"), x["s"].alias("text"), F.lit(label).alias("label"), value.alias("value"), unit.alias("unit"))


def entities(text: Column) -> Column:
    """array of struct(text, label, value, unit, char_start, char_end) in order. A span that overlaps a kept one of the same or higher rank (DEPTH, BIT_SIZE, MEASUREMENT, TIME, EQUIPMENT) is dropped; a kept one is never taken back."""
    none = F.lit(None).cast("string")
    unit = lambda x: F.upper(F.replace(F.regexp_extract(x["s"], DEPTH, 2), F.lit(" "), F.lit("")))
    depth = F.transform(spans(text, DEPTH), lambda x: F.struct(x.alias("x"), _number(F.regexp_extract(x["s"], DEPTH, 1)).alias("v")))
    depth = F.transform(F.filter(depth, lambda y: y["v"].between(5, 9999)), lambda y: _entity(y["x"], 0, "DEPTH", compact(y["v"]), F.when(F.contains(unit(y["x"]), F.lit("TVD")), "mTVD").when(F.contains(unit(y["x"]), F.lit("MD")), "mMD").otherwise("m")))
    bit = F.transform(spans(text, INCH), lambda x: F.struct(x.alias("x"), _inches(x["s"]).alias("v")))
    bit = F.transform(F.filter(bit, lambda y: y["v"].between(3, 40)), lambda y: _entity(y["x"], 1, "BIT_SIZE", compact(y["v"]), F.lit('"')))
    said = lambda x: F.regexp_replace(x["s"], r"^-?[0-9.,]+\s*", "")  # noqa: E731  of the match alone: its right edge is gone
    measure = F.transform(spans(text, MEASUREMENT), lambda x: _entity(x, 2, "MEASUREMENT", compact(_number(F.regexp_extract(x["s"], r"^-?\d{1,6}(?:[.,]\d{1,3})?", 0))), F.when(F.lower(said(x)).isin("ton", "tons"), "MT").otherwise(said(x))))
    clock = F.transform(spans(text, CLOCK), lambda x: _entity(x, 3, "TIME", x["s"], none))
    gear = F.transform(spans(text, GEAR), lambda x: _entity(x, 4, "EQUIPMENT", F.upper(x["s"]), none))
    ordered = F.array_sort(F.concat(depth, bit, measure, clock, gear))
    clash = lambda k, e: (e["char_start"] < -k["neg_end"]) & (k["char_start"] < -e["neg_end"]) & (k["rank"] <= e["rank"])
    kept = let(ordered, lambda all_: F.aggregate(all_, F.slice(all_, 1, 0), lambda acc, e: F.when(F.exists(acc, lambda k: clash(k, e)), acc).otherwise(F.concat(acc, F.array(e)))))
    out = F.transform(F.array_sort(kept), lambda e: F.struct(e["text"].alias("text"), e["label"].alias("label"), e["value"].alias("value"), e["unit"].alias("unit"), e["char_start"].alias("char_start"), (-e["neg_end"]).alias("char_end")))
    return F.when(F.coalesce(text, F.lit("")) != "", out)


def entity_sets(text: Column) -> Column:
    """struct of the four sets that the reranker compares."""
    text = F.coalesce(text, F.lit(""))
    whole = F.regexp_extract_all(text, F.lit(INCH), F.lit(0))
    bits = F.transform(F.filter(F.transform(whole, _inches), lambda v: v.between(4, 40)), lambda v: F.concat(compact(v), F.lit('"')))
    depths = F.filter(F.transform(F.regexp_extract_all(text, F.lit(RERANK_DEPTH), F.lit(1)), lambda v: F.rint(_number(v)).cast("int")), lambda v: v.between(1, 10000))
    problems = F.transform(F.regexp_extract_all(text, F.lit(PROBLEM), F.lit(1)), lambda v: F.lower(v))
    gear = F.regexp_extract_all(text, F.lit(RERANK_GEAR), F.lit(1))
    return F.struct(*[F.array_sort(F.array_distinct(c)).alias(n) for c, n in ((bits, "bit_sizes"), (depths, "depths"), (problems, "problems"), (gear, "equipment"))])


def overlap(a: Column, b: Column) -> Column:
    """Weighted sum of the Jaccard similarities of the four sets; a pair with an empty side counts zero."""
    total = F.lit(0.0)
    for name, w in WEIGHTS.items():
        x, y = a[name], b[name]
        both = F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))
        total = total + F.when((F.size(x) > 0) & (F.size(y) > 0), F.lit(w) * both).otherwise(F.lit(0.0))
    return total
