"""Conversions of report text to typed values; anything unreadable is null, never an error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: what counts as blank, and numbers that mean "missing"
BLANK = ["", "none", "n/a", "na", "null", "()", "(unknown)", "unknown"]
MISSING = [-999.99, -999.0]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, computed once: what a lambda takes from outside is otherwise computed for every element."""
    return F.transform(F.array(value), body)[0]


#: a character that stands at the edges of matches; no character of any script
EDGE = "\uffff"


def cut_at(text: Column, pattern: str) -> Column:
    """The text in pieces: before the first match, the match, before the second, and so on; matches are at odd places. One replacement marks the matches and the cut is at one character, as a split by a pattern compiles it for every row; only a text that holds the mark itself is split so."""
    marked = F.split(F.regexp_replace(text, pattern, f"{EDGE}$0{EDGE}"), EDGE, -1)
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    woven = F.flatten(F.transform(between, lambda b, i: F.when(i < F.size(found), F.array(b, F.get(found, i))).otherwise(F.array(b))))
    return F.when(F.contains(text, F.lit(EDGE)), woven).otherwise(marked)


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends (trim() takes blanks only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def as_text(c: Column) -> Column:
    s = strip(c)
    return F.when(~F.lower(s).isin(BLANK), s)


def as_double(c: Column) -> Column:
    """The first number; a comma is read as a decimal point."""
    token = F.regexp_extract(F.replace(as_text(c), F.lit(","), F.lit(".")), r"-?\d+(?:\.\d+)?", 0)
    x = F.nullif(token, F.lit("")).try_cast("double")
    return F.when(~x.isin(MISSING), x)


def as_int(c: Column) -> Column:
    return as_double(c).try_cast("int")


def as_bool(c: Column) -> Column:
    s = F.upper(as_text(c))
    return F.when(s.startswith("Y"), True).when(s.startswith("N"), False)


def as_timestamp(c: Column) -> Column:
    """Searched anywhere, longest form first; an invalid time falls back to the shorter form."""
    s = F.regexp_replace(as_text(c), r"\s+", " ")
    at = lambda p, f: F.try_to_timestamp(F.nullif(F.regexp_extract(s, p, 0), F.lit("")), F.lit(f))
    day = r"\d{4}-\d{2}-\d{2}"
    return F.coalesce(at(day + r" \d{2}:\d{2}:\d{2}", "yyyy-MM-dd HH:mm:ss"), at(day + r" \d{2}:\d{2}", "yyyy-MM-dd HH:mm"), at(day, "yyyy-MM-dd")).cast("timestamp_ntz")


def as_date(c: Column) -> Column:
    return as_timestamp(c).cast("date")


def compact(x: Column) -> Column:
    """Six significant digits without trailing zeros; an exponent from 1e6 on and below 1e-4."""
    s = F.when(x.isNotNull(), F.format_string("%.5e", x))
    exponent = F.get(F.split(s, "e"), F.lit(1)).try_cast("int")
    exact = x.cast("decimal(38,18)")
    plain = F.lit(None).cast("decimal(38,12)")
    for e in range(-4, 6):  # ties go to the even digit
        plain = F.when(exponent == e, F.bround(exact, 5 - e).cast("decimal(38,12)")).otherwise(plain)
    plain = F.regexp_replace(F.regexp_replace(plain.cast("string"), "0+$", ""), r"\.$", "")
    mantissa = F.regexp_replace(F.regexp_replace(F.get(F.split(s, "e"), F.lit(0)), "0+$", ""), r"\.$", "")
    return F.when(x == 0, "0").when(exponent.between(-4, 5), plain).otherwise(F.concat(mantissa, F.lit("e"), F.get(F.split(s, "e"), F.lit(1))))
