"""Activity tags of remarks by prioritized patterns, and severity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .convert import let

# fixed values: label, pattern between word boundaries (any case), priority
RULES = [
    ("WELL_CONTROL", r"\b(?:kick|influx|well\s*control|shut\s*in|kill\s*operation|gas\s*alarm)\b", 90),
    ("STUCK_PIPE", r"\b(?:stuck\s+pipe|differential\s+stuck|pack\s*off|packed\s*off|pack[- ]off)\b", 70),
    ("TIGHT_HOLE", r"\btight(?:\s+hole|\s+spot)?\b", 70),
    ("EQUIPMENT_FAILURE", r"\b(?:fail(?:ure|ed)?|out\s+of\s+service|broken|broke|leak(?!\s*off)(?:age|ing)?|malfunction|stalled|tripped\s+(?:offline|out))\b", 70),
    ("FISHING", r"\b(?:fish(?:ing)?|spear|overshot|wash[- ]over|junk\s+sub|impression\s+block)\b", 70),
    ("TRIP_OUT", r"\b(?:POOH|pull\s+out\s+of\s+hole|tripping\s+out|trip\s+out|TOH)\b", 50),
    ("TRIP_IN", r"\b(?:RIH|run\s+in\s+hole|tripping\s+in|trip\s+in|TIH)\b", 50),
    ("CIRCULATE", r"\b(?:circulat(?:e|ed|es|ing|ion)|bottoms[- ]up)\b", 50),
    ("DRILL", r"\b(?:drill(?:ing|ed)?|drilled|new\s+formation|reaming|reamed|orient(?:ed|ing)?)\b", 50),
    ("CASING", r"\b(?:casing|liner|run\s+(?:13\s*3/8|9\s*5/8|7|20|26|30)\s*(?:\"|in)?\s*casing|landing\s+string)\b", 50),
    ("CEMENT", r"\b(?:cement(?:ing|ed)?|cmt(?:\s|$)|cement\s+head|spacer|squeeze)\b", 50),
    ("PRESSURE_TEST", r"\b(?:pressure\s+test|leak[- ]off\s+test|formation\s+integrity\s+test|FIT|LOT\b)\b", 30),
    ("BOP_OPERATION", r"\b(?:BOP|blowout\s+preventer|annular|wellhead|riser|HPDR)\b", 30),
    ("SURVEY", r"\b(?:survey|inclination|azimuth|MWD\s+survey|gyro)\b", 30),
    ("RIG_UP", r"\b(?:R/U\b|rig(?:ged|ging)?\s+up)\b", 30),
    ("RIG_DOWN", r"\b(?:R/D\b|rig(?:ged|ging)?\s+down)\b", 30),
    ("MAKE_UP", r"\b(?:M/U\b|making?\s+up|made\s+up)\b", 30),
    ("LAY_DOWN", r"\b(?:L/O\b|L/D\b|lay(?:ing|ed)?\s+down|laid\s+out)\b", 30),
    ("CUT", r"\b(?:cut\s+(?:string|drill\s+pipe|pipe)|free\s+point|back[- ]off)\b", 30),
    ("REPAIR", r"\b(?:repair(?:ed|ing)?|replace(?:d|ment)?|maint(?:enance|ained?)|service\b|change(?:d)?\s+(?:bit|tool|seal))\b", 10),
    ("WAIT", r"\b(?:wait(?:ing)?|stand[- ]?by|hold\s+up|delay(?:ed)?|WOO|WOC)\b", 10),
    ("FLOW_CHECK", r"\b(?:flow[- ]?check(?:ed|ing)?|trip\s+tank)\b", 10),
    ("TOOLBOX_TALK", r"\b(?:tool\s*box\s+(?:talk|meeting)|safety\s+meeting|pre[- ]?job\s+(?:safety\s+)?meeting|TBT)\b", 10),
]

# fixed values: failure labels, and weights of labels and of further signals of the text
FAILURES = ["WELL_CONTROL", "STUCK_PIPE", "TIGHT_HOLE", "EQUIPMENT_FAILURE", "FISHING"]
WEIGHTS = {"WELL_CONTROL": 10, "STUCK_PIPE": 8, "FISHING": 6, "EQUIPMENT_FAILURE": 4, "TIGHT_HOLE": 3, "REPAIR": 1, "WAIT": 1}
SIGNALS = [
    (r"\bover\s*pull\b|\boverpull\b", 3, "overpull"),
    (r"\b(?:loss|lost)\s*(?:of\s*)?circulation", 4, "lost circulation"),
    (r"\bemergency\b", 5, "emergency"),
    (r"\btwist[- ]?off\b", 6, "twist-off"),
    (r"\bback[- ]?off\b", 5, "back-off"),
    (r"\bswab(?:bing)?\b", 2, "swabbing"),
    (r"\bfishing\b", 4, "fishing"),
]
FAIL_STATE = 5
OTHER = "OTHER"


def all_labels(remark: Column) -> Column:
    """Every label that fires, highest priority first, in the rules' order within one; [OTHER] if none does or the remark is null or empty."""
    ordered = sorted(RULES, key=lambda r: -r[2])
    found = let(remark, lambda r: F.array_compact(F.array(*[F.when(r.rlike("(?i)" + p), F.lit(label)) for label, p, _ in ordered])))
    return let(found, lambda f: F.when(F.size(f) > 0, f).otherwise(F.array(F.lit(OTHER))))


def labels(found: Column, most: int = 3) -> Column:
    return F.slice(found, 1, most)


def severity(remark: Column, found: Column, state: Column) -> Column:
    """struct(score, contributors): weights of the first five labels, signals, and a failed state; zero without a remark."""
    weights = F.create_map(*[F.lit(x) for kv in WEIGHTS.items() for x in kv])
    by_label = F.transform(F.filter(labels(found, 5), lambda x: x.isin(list(WEIGHTS))), lambda x: F.struct(weights[x].alias("w"), F.concat(x, F.lit("(+"), weights[x].cast("string"), F.lit(")")).alias("t")))
    by_text = F.array_compact(F.array(*[F.when(remark.rlike("(?i)" + p), F.struct(F.lit(w).alias("w"), F.lit(f"text:{name}(+{w})").alias("t"))) for p, w, name in SIGNALS]))
    by_state = F.array_compact(F.array(F.when(F.lower(state) == "fail", F.struct(F.lit(FAIL_STATE).alias("w"), F.lit(f"state:fail(+{FAIL_STATE})").alias("t")))))
    scored = let(F.concat(by_label, by_text, by_state), lambda parts: F.struct(F.aggregate(parts, F.lit(0), lambda a, x: a + x["w"]).alias("score"), F.array_join(F.transform(parts, lambda x: x["t"]), "|").alias("contributors")))
    return F.when(F.coalesce(remark, F.lit("")) != "", scored).otherwise(F.struct(F.lit(0).alias("score"), F.lit("").alias("contributors")))
