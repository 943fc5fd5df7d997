"""Normalization of report text, queries, well names and file names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .convert import cut_at, let, strip

# fixed values: abbreviations and their long forms
ABBREVIATIONS = {
    "POOH": "pull out of hole", "RIH": "run in hole", "TIH": "trip in hole", "TOH": "trip out of hole",
    "M/U": "make up", "B/O": "break out", "L/O": "lay down", "P/U": "pick up", "L/D": "lay down",
    "R/U": "rig up", "R/D": "rig down", "F/": "from", "T/": "to",
    "BHA": "bottom hole assembly", "TDS": "top drive system", "BOP": "blowout preventer",
    "MWD": "measurement while drilling", "LWD": "logging while drilling", "ADN": "azimuthal density neutron",
    "ARC": "array resistivity compensated", "PRS": "pipe racking system", "CART": "casing running tool",
    "HPDR": "high pressure drilling riser", "FAC": "fishing assembly", "PDM": "positive displacement motor",
    "RSS": "rotary steerable system", "HO": "hole opener", "HWDP": "heavyweight drill pipe", "DP": "drill pipe",
    "DC": "drill collar", "RA": "radioactive", "TBC": "tie back connector", "FLX": "flex packer", "XO": "crossover",
    "LCM": "lost circulation material",
    "OBM": "oil based mud", "WBM": "water based mud", "HPWBM": "high performance water based mud",
    "SOBM": "synthetic oil based mud", "SBM": "synthetic based mud", "SW": "sea water",
    "WOB": "weight on bit", "ROP": "rate of penetration", "ECD": "equivalent circulating density",
    "EMW": "equivalent mud weight", "SPP": "stand pipe pressure", "MD": "measured depth", "TVD": "true vertical depth",
    "TD": "total depth", "RKB": "rotary kelly bushing", "MSL": "mean sea level",
    "HPHT": "high pressure high temperature", "FIT": "formation integrity test", "LOT": "leak off test",
    "DD": "directional drilling",
    "lpm": "litres per minute", "rpm": "revolutions per minute", "kNm": "kilonewton meter", "ppm": "parts per million",
    "MT": "metric ton", "sg": "specific gravity", "ppg": "pounds per gallon", "klbs": "kilopounds",
}

# fixed values: words that page layout has split
SPLIT_WORDS = [
    ("circ ulating", "circulating"), ("circ ulation", "circulation"), ("Sur vey", "Survey"), ("Summar y", "Summary"),
    ("POO H", "POOH"), ("RI H", "RIH"), ("integrity tes t", "integrity test"),
    ("formation integrity tes t", "formation integrity test"), ("pea k", "peak"), ("Co ntrolled", "Controlled"),
    ("recipro cating", "reciprocating"), ("rec iprocating", "reciprocating"), ("conditi oning", "conditioning"),
    ("k Nm", "kNm"), ("k N", "kN"), ("PR S", "PRS"), ("in specting", "inspecting"), ("activitie s", "activities"),
    ("plan ned", "planned"), ("oper ations", "operations"),
]

# fixed values: typing errors of event descriptions
TYPOS = [("ccumulation", "accumulation"), ("ecountered", "encountered"), ("encoutered", "encountered"), ("excesive", "excessive")]

# fixed values: well prefixes of file names and their families
WELL_FAMILIES = {
    "15_9_F_10": "15_9_F_10", "15_9_F_11": "15_9_F_11", "15_9_F_11_A": "15_9_F_11", "15_9_F_11_B": "15_9_F_11",
    "15_9_F_11_T2": "15_9_F_11", "15_9_F_12": "15_9_F_12", "15_9_F_13": "15_9_F_13", "15_9_F_14": "15_9_F_14",
    "15_9_F_15": "15_9_F_15", "15_9_F_15_A": "15_9_F_15", "15_9_19_S": "15_9_19", "15_9_19_A": "15_9_19",
    "15_9_19_B": "15_9_19", "15_9_19_BT2": "15_9_19", "15_9_19_ST2": "15_9_19",
}
EVENT_WELLS = ["15_9_F_10", "15_9_F_11", "15_9_F_12", "15_9_F_13"]
WELLS_WITHOUT_REPORTS = ["15_9_F_13"]


def _literal(s: str) -> str:
    """s as a Java pattern that matches it alone."""
    return "".join("\\" + c if c in "\\^$.|?*+()[]{}/-" else c for c in s)


def squeeze_blanks(c: Column) -> Column:
    return F.regexp_replace(c, "[ \t]+", " ")


def collapse_doubled_letters(c: Column) -> Column:
    """Words whose letters all come in pairs (four letters or more, case aside) lose one of each pair."""
    marked = F.regexp_replace(c, r"(?iu)\b((?:([A-Za-zÀ-ÿ])\2){2,})\b", "\u0001$1\u0001")
    halve = lambda w: F.array_join(F.transform(F.sequence(F.lit(1), F.length(w), F.lit(2)), lambda i: F.substring(w, i, F.lit(1))), "")
    return F.array_join(F.transform(F.split(marked, "\u0001"), lambda w, i: F.when((i % 2 == 1) & (F.length(w) > 0), halve(w)).otherwise(w)), "")


def collapse_doubled_words(c: Column) -> Column:
    """Runs of one word, or of one label with its colon, become one; three rounds, as one may make way for another."""
    for _ in range(3):
        c = F.regexp_replace(c, r"(?iu)\b([A-Za-zÀ-ÿ]\w*):(?:\s+\1:)+", "$1:")
        c = F.regexp_replace(c, r"(?iu)\b([A-Za-zÀ-ÿ]\w*)(?:\s+\1\b)+", "$1")
    return c


def join_split_words(c: Column) -> Column:
    return reduce(lambda x, w: F.regexp_replace(x, r"\s+".join(map(_literal, w[0].split(" "))), w[1]), SPLIT_WORDS, c)


def normalize_report(c: Column) -> Column:
    c = collapse_doubled_letters(squeeze_blanks(c))
    return join_split_words(collapse_doubled_words(F.regexp_replace(c, "::+", ":")))


def _abbreviation_pattern() -> str:
    words = "|".join(_literal(a) for a in sorted(ABBREVIATIONS, key=len, reverse=True) if a.isalnum())
    signs = "|".join(_literal(a) for a in sorted(ABBREVIATIONS, key=len, reverse=True) if not a.isalnum())
    return rf"(?i)\b(?:{words})\b|(?<![A-Za-z0-9])(?:{signs})(?![A-Za-z0-9])"


def expand_abbreviations(c: Column) -> Column:
    """Each abbreviation, any case, becomes its usual form with the long form in parentheses. One scan: no abbreviation is a part of another's match, and no long form holds one."""
    pattern = _abbreviation_pattern()
    long = F.create_map(*[F.lit(x) for short, form in ABBREVIATIONS.items() for x in (short.lower(), f"{short} ({form})")])
    return let(c, lambda t: F.array_join(F.transform(cut_at(t, pattern), lambda w, i: F.when(i % 2 == 1, F.coalesce(long[F.lower(w)], w)).otherwise(w)), ""))


def clean_query(c: Column) -> Column:
    c = F.regexp_replace(c, '"{2,}', '"')
    for bad, good in TYPOS:
        c = F.regexp_replace(c, rf"(?i)\b{bad}\b", good)
    c = F.regexp_replace(c, r"(?iU)\b(\w+)(\s+\1)+\b", "$1")
    return strip(F.regexp_replace(c, r"\s+", " "))


def index_text(c: Column) -> Column:
    return expand_abbreviations(F.coalesce(c, F.lit("")))


def query_text(c: Column) -> Column:
    return expand_abbreviations(clean_query(F.coalesce(c, F.lit(""))))


def well_key(c: Column) -> Column:
    """A well's name as a family key: 15/9-F-10 is 15_9_F_10."""
    return F.btrim(F.regexp_replace(F.translate(strip(c), "/- ", "___"), "_+", "_"), F.lit("_"))


def family_of(prefix: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in WELL_FAMILIES.items() for x in kv])[prefix], prefix)


# fixed value: layout of a report's file name
FILENAME = r"(?i)^(15_9_(?:F_)?\d+(?:_[A-Z]+\d*)?)_(\d{4})_(\d{2})_(\d{2})\.pdf$"


def file_parts(name: Column) -> Column:
    """struct(prefix, family, report_date) of a file name; null where it does not match or its date is invalid."""
    base = F.element_at(F.split(name, "/"), -1)
    part = lambda i: F.regexp_extract(base, FILENAME, i)
    day = F.try_to_timestamp(F.nullif(F.concat(part(2), part(3), part(4)), F.lit("")), F.lit("yyyyMMdd")).cast("date")
    return F.when(day.isNotNull(), F.struct(part(1).alias("prefix"), family_of(part(1)).alias("family"), day.alias("report_date")))
