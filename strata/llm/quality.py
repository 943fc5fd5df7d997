"""Quality rules with distribution divergence (operator 5).

Base rules: too few words, or too many words in repeated windows. The method's
verdict compares two histograms of a document with those of its language, which
are summed over all documents: classes of characters, and how often each of the
language's common words occurs against all other words. The measure is the
Jensen-Shannon distance (root of the divergence in bits, 0 to 1). A histogram of
a short text is noise, so each comparison has a minimum length, and the limit of
the word distance widens with the noise of few words.

Only DataFrame functions are used. The references are a table of one row for each
value of lang and are joined back by it.

Cases: null or empty text has no words and fails the base rules; a language
without a word list is compared by characters only, with its own documents; a
null or blank language, or one of fewer than MIN_SEEN documents that are long
enough to be compared, is left to the base rules; equal rows are judged each; texts are judged whole; columns besides text and lang are
kept as they are (added columns take the place of equally named ones).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, small

#: Common words by language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als".split(),
    "en": "the of and to a in is that it for was on with as be by this are at from".split(),
    "es": "de la que el en y los se las del un por con no su una para es al lo".split(),
    "fr": "de la le et les des en un du une que pour est par dans qui avec pas sur au".split(),
}
SPACE = " \t\n\x0b\x0c\r"
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
SENTENCE, SYMBOLS = ".,;:!?'\"()-", "#*$%&|<>"
OTHER = "+/=@[\\]^_`{}~"
CLASSES = [LOWER, SPACE, UPPER, DIGITS, SENTENCE, SYMBOLS, OTHER]
MIN_WORDS, MAX_REPEATED, WINDOW = 20, 30, 8
#: minimum lengths of the comparisons and limits of the distances
MIN_CHARS, CHAR_LIMIT, CHAR_NOISE = 150, 0.25, 1.0
MIN_COUNTED, WORD_LIMIT, WORD_NOISE = 20, 0.35, 0.6
#: documents of MIN_CHARS or more that make a reference of a language
MIN_SEEN = 10
ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance", "base_failed", "kept"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")


def class_counts(text: Column) -> Column:
    """Characters of each of CLASSES, then of all the rest. Blanks and small letters, nearly all of a text, are taken out in runs; the few characters left are then sorted by class."""

    def step(rest: Column, k: int, counts: list[Column]) -> Column:
        if k == len(CLASSES):
            return F.array(*counts, F.char_length(rest).cast("long"))
        return let(F.translate(rest, CLASSES[k], ""), lambda left: step(left, k + 1, [*counts, (F.char_length(rest) - F.char_length(left)).cast("long")]))

    def runs(t: Column, solid: Column) -> Column:
        spaces = F.char_length(t) - F.char_length(solid)
        return let(F.regexp_replace(solid, "[a-z]+", ""), lambda few: let(F.translate(few, SPACE, ""), lambda rest: step(rest, 2, [(F.char_length(solid) - F.char_length(few)).cast("long"), (spaces + F.char_length(few) - F.char_length(rest)).cast("long")])))

    return let(text, lambda t: let(F.replace(t, F.lit(" "), F.lit("")), lambda solid: runs(t, solid)))


def common_counts(words: Column, lang: Column) -> Column:
    """How often each common word of the language occurs, then the number of all other words; null without a list."""
    lists = F.when(F.lit(False), F.array(F.lit("")))
    for k, listed in COMMON_WORDS.items():
        lists = lists.when(lang == k, F.array(*[F.lit(w) for w in listed]))
    listed = sorted({v for ws in COMMON_WORDS.values() for w in ws for v in (w, w.capitalize(), w.upper())})
    few = F.filter(words, lambda w: w.isin(*listed))
    spaced = F.concat(F.lit(" "), F.lower(F.array_join(few, "  ")), F.lit(" "))
    each = let(spaced, lambda t: F.transform(lists, lambda w: ((F.octet_length(t) - F.octet_length(F.replace(t, F.concat(F.lit(" "), w, F.lit(" ")), F.lit("")))) / (F.octet_length(w) + 2)).cast("long")))
    return let(each, lambda c: F.concat(c, F.array(F.size(words).cast("long") - F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x))))


def repeat_words(words: Column) -> Column:
    """Words in windows of WINDOW words that the text holds twice or more, the first included. Windows are told apart by 64-bit hashes; only texts that hold an equal pair are sorted."""

    def covered(hashes: Column) -> Column:
        rows = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(rows, lambda s: F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | (F.get(s, i + 1)["h"] == x["h"])))
        places = F.array_sort(F.transform(twice, lambda x: x["i"]))
        return let(places, lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x))

    def of(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
        return F.when(F.size(w) < WINDOW, F.lit(0)).otherwise(let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of a histogram of counts and a reference of shares; null for an empty one and without a reference."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    term = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))
    parts = lambda n: F.zip_with(F.transform(counts, lambda c: c / n), reference, lambda p, q: (term(p, (p + q) / 2) + term(q, (p + q) / 2)) / 2)
    return let(total, lambda n: F.when((n > 0) & reference.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts(n), F.lit(0.0), lambda a, x: a + x)))))


def measured(docs: DataFrame) -> DataFrame:
    """Adds _lang, _m (what is read of the words), _chars and n_dup_lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lang = F.when(F.btrim("lang") != "", F.col("lang"))
    of_words = let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).cast("long").alias("r"), common_counts(w, lang).alias("c")))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    dup = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return docs.withColumns({"_lang": lang, "_m": of_words, "_chars": class_counts(text), "n_dup_lines": dup})


def references(measures: DataFrame) -> DataFrame:
    """(_lang, _ref_chars, _ref_words): shares of the character classes and of the common words, over all documents of each language that is seen MIN_SEEN times."""
    k = 1 + max(map(len, COMMON_WORDS.values()))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    share = lambda c: let(total(c), lambda n: F.transform(c, lambda x: x / F.greatest(F.lit(1).cast("long"), n)))
    sums = lambda c, n: F.array(*[F.sum(F.get(c, F.lit(i))) for i in range(n)])
    rows = measures.where("_lang is not null").groupBy("_lang").agg(F.count_if(total(F.col("_chars")) >= MIN_CHARS).alias("_seen"), sums("_chars", len(CLASSES) + 1).alias("_c"), sums("_m.c", k).alias("_w"))
    listed = F.filter("_w", lambda x: x.isNotNull())  # lists may be of unequal length
    return rows.where(F.col("_seen") >= MIN_SEEN).select("_lang", share(F.col("_c")).alias("_ref_chars"), F.when(F.size(listed) > 0, share(listed)).alias("_ref_words"))


def judged(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, char_distance, word_distance, base_failed and kept, and drops the text. Texts are read once: the measures are written, summed for the references and judged."""
    m = materialize(measured(docs.drop(*ADDED)).drop("text"), "measures")
    total = F.aggregate("_chars", F.lit(0).cast("long"), lambda a, x: a + x)
    shares = materialize(references(m), "references")
    m = m.join(small(shares, len(CLASSES) + 1 + max(map(len, COMMON_WORDS.values()))), "_lang", "left")
    chars, words = distance(F.col("_chars"), F.col("_ref_chars")), distance(F.col("_m.c"), F.col("_ref_words"))
    m = m.withColumns({"n_words": F.col("_m.n"), "n_repeat_words": F.col("_m.r"), "n_symbols": F.get("_chars", F.lit(CLASSES.index(SYMBOLS)))})
    m = m.withColumns({"word_chars": total - F.get("_chars", F.lit(CLASSES.index(SPACE))), "_total": total, "char_distance": chars, "word_distance": words})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    strange = F.coalesce((F.col("_total") >= MIN_CHARS) & (F.col("char_distance") > CHAR_LIMIT + CHAR_NOISE / F.sqrt("_total")), F.lit(False)) | F.coalesce((F.col("n_words") >= MIN_COUNTED) & (F.col("word_distance") > WORD_LIMIT + WORD_NOISE / F.sqrt("n_words")), F.lit(False))
    return m.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~strange).drop("_lang", "_m", "_chars", "_total", "_ref_chars", "_ref_words")


def text_keys(docs: DataFrame) -> DataFrame:
    """Adds _h1 and _h2, 128 bits that stand for the text and the language: all that a verdict depends on."""
    return docs.withColumns({"_h1": F.xxhash64("text", "lang"), "_h2": F.xxhash64(F.lit(7), "text", "lang")})


def quality_rules(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """docs with the columns of judged(). With the text, each distinct text and language is judged once and its verdict joined back."""
    if not keep_text:
        return judged(docs)
    docs = docs.drop(*ADDED)
    verdicts = materialize(judged(text_keys(docs).select("_h1", "_h2", "text", "lang")).drop("lang").dropDuplicates(["_h1", "_h2"]), "verdicts")
    return text_keys(docs).join(small(verdicts, 12), ["_h1", "_h2"]).drop("_h1", "_h2").select(*docs.columns, *ADDED)


def passing(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, as they are. Only the keys of rejected texts are joined."""
    found = judged(text_keys(docs).select("_h1", "_h2", "text", "lang"))
    gone = materialize(found.where(~F.col("kept")).select("_h1", "_h2").distinct(), "rejected")
    return text_keys(docs).join(small(gone), ["_h1", "_h2"], "left_anti").select(*docs.columns)
