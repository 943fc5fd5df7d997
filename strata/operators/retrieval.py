"""Retrieval: TF-IDF in long form, dense scores, pooled and blended rankings, entity rerank."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.convert import let
from ..functions.entities import entity_sets, overlap
from ..functions.text import index_text, query_text
from ..sources.scratch import materialize

POOL, BLEND, RERANK = 100, (0.5, 0.5), (0.7, 0.3)
#: events (a few longs each) that are broadcast; of more, the events of a block
EVENT_BLOCK = 10_000
WORD = r"(?U)\b\w\w+\b"
KEYWORD = r"(?U)\b[a-zA-Z][a-zA-Z\-]{2,}\b"

# fixed values: domain words that are no keywords
DOMAIN_STOP = """drilling drilled operations operation well hole bha ok fail rpm lpm bar psi mt kn knm ppg deg degc kg ml ft
spm ppm md tvd mmd mtvd depth depths m mm cm km made make set pull pulled pulls ran run running pump pumps pumped pumping
use used using above below after prior while during performed continued started finished complete completed""".split()


ENGLISH_STOP = """a about above after again against all am an and any are as at be because been before being below between
both but by can could did do does doing down during each few for from further had has have having he her here hers herself
him himself his how i if in into is it its itself just me more most my myself no nor not now of off on once only or other
our ours ourselves out over own same she should so some such than that the their theirs them themselves then there these
they this those through to too under until up very was we were what when where which while who whom why will with would
you your yours yourself yourselves""".split()


def english_stop_words() -> list[str]:
    return ENGLISH_STOP


def terms(text: Column, pattern: str = WORD, stop: list[str] | None = None) -> Column:
    """Words and pairs of neighbouring words, in lower case; stop words go before pairs are made."""
    words = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    if stop:
        words = F.filter(words, lambda w: ~w.isin(stop))
    pairs = lambda ws: F.transform(F.slice(ws, 2, F.greatest(F.lit(0), F.size(ws) - 1)), lambda w, i: F.concat(F.get(ws, i), F.lit(" "), w))
    return let(words, lambda ws: F.concat(ws, pairs(ws)))


def term_counts(docs: DataFrame, key: str, text: Column, pattern: str = WORD, stop: list[str] | None = None) -> DataFrame:
    """(key, term, tf): counted in two steps, combined before the shuffle."""
    return docs.select(key, F.explode(terms(text, pattern, stop)).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def fit_idf(counts: DataFrame, n: int, least: float, most: float) -> DataFrame:
    """(term, idf) of the terms that at least `least` and at most `most` * n documents hold."""
    df = counts.groupBy("term").agg(F.count("*").alias("df")).where((F.col("df") >= least) & (F.col("df") <= F.lit(float(most)) * n))
    return df.select("term", (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def weigh(counts: DataFrame, key: str, idf: DataFrame) -> DataFrame:
    """(key, term, weight): (1 + ln tf) * idf, each document of unit length over the kept terms."""
    raw = counts.join(idf, "term").select(key, "term", ((1.0 + F.log("tf")) * F.col("idf")).alias("w"))
    return raw.withColumn("weight", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))).drop("w")


def top_keywords(docs: DataFrame, key: str, text: str, n: int, top: int = 10, least: int = 3, most: float = 0.6) -> DataFrame:
    """(key, rank, keyword, tfidf_score): the highest weights of each document, ties by keyword. Texts are cut into terms once."""
    counts = materialize(term_counts(docs.where(F.length(F.col(text)) > 0), key, F.col(text), KEYWORD, sorted({*english_stop_words(), *DOMAIN_STOP})), "terms")
    w = weigh(counts, key, fit_idf(counts, n, least, most)).withColumn("tfidf_score", F.round("weight", 6))
    ranked = w.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("tfidf_score"), "term")))
    return ranked.where((F.col("rank") <= top) & (F.col("tfidf_score") > 0)).select(key, "rank", F.col("term").alias("keyword"), "tfidf_score")


def scopes(events: DataFrame, ops: DataFrame, fallback_on_empty: bool = False) -> tuple[DataFrame, DataFrame]:
    """Events that are held to their own well's operations, and events that may match any: those whose well has no reports and, if asked for, those whose well has reports but no operations."""
    own, free = events.where("has_pdf_corpus"), events.where("not has_pdf_corpus")
    if fallback_on_empty:
        families = ops.select("well_family").distinct()
        free = free.unionByName(own.join(families, "well_family", "left_anti").select(*events.columns))
        own = own.join(families, "well_family", "left_semi").select(*events.columns)
    return own, free


def scope(events: DataFrame, ops: DataFrame, fallback_on_empty: bool = False) -> DataFrame:
    """(event_id, op_id) candidates: a well's own operations, or all for an event whose well has no reports."""
    own, free = scopes(events, ops, fallback_on_empty)
    held = own.select("event_id", "well_family").join(ops.select("op_id", "well_family"), "well_family").select("event_id", "op_id")
    return held.unionByName(every_pair(free.select("event_id"), ops.select("op_id")))


def every_pair(events: DataFrame, ops: DataFrame) -> DataFrame:
    """(event_id, op_id) of all events with all operations: a counted short list is broadcast, a longer one is dealt into blocks that meet parts of the operations."""
    n = events.count()
    if n <= EVENT_BLOCK:  # an equi-join on a constant key dealt by the operations' own partitions
        return ops.withColumn("_one", F.lit(1)).join(F.broadcast(events.withColumn("_one", F.lit(1))), "_one").select("event_id", "op_id")
    blocks, parts = -(-n // EVENT_BLOCK), int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda c, k: F.pmod(F.xxhash64(c), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = events.select("event_id", dealt("event_id", blocks).alias("_block"), every(parts).alias("_part"))
    right = ops.select("op_id", dealt("op_id", parts).alias("_part"), every(blocks).alias("_block"))
    return right.join(left, ["_block", "_part"]).select("event_id", "op_id")


def positive_scores(events: DataFrame, ops: DataFrame, n: int) -> DataFrame:
    """(event_id, op_id, score): cosine of TF-IDF vectors of all pairs that share a term. Texts are cut into terms once; rounded, so that no order of addition decides a tie."""
    counts = materialize(term_counts(ops, "op_id", index_text(F.col("op_text"))), "terms")
    idf = fit_idf(counts, n, 2, 0.95)
    queries = weigh(term_counts(events, "event_id", query_text(F.col("event_text"))), "event_id", idf)
    dots = weigh(counts, "op_id", idf).join(queries.withColumnRenamed("weight", "q"), "term").groupBy("event_id", "op_id").agg(F.sum(F.col("weight") * F.col("q")).alias("s"))
    return dots.select("event_id", "op_id", F.round("s", 12).alias("score"))


def sparse_scores(events: DataFrame, ops: DataFrame, candidates: DataFrame, n: int) -> DataFrame:
    """(event_id, op_id, score) of every candidate, zero where no term is shared."""
    return candidates.join(positive_scores(events, ops, n), ["event_id", "op_id"], "left").select("event_id", "op_id", F.coalesce("score", F.lit(0.0)).alias("score"))


def sparse_top(events: DataFrame, ops: DataFrame, k: int, n: int, fallback_on_empty: bool = False) -> DataFrame:
    """(event_id, op_id, score, rank): the k best candidates of each event. Pairs that share no term score zero and are needed only where fewer than k share one; then the first by op_id follow, so the first 2 k operations of a scope are enough of them."""
    own, free = scopes(events, ops, fallback_on_empty)
    positive = positive_scores(events, ops, n).join(ops.select("op_id", F.col("well_family").alias("_of")), "op_id")
    both = own.select("event_id", F.col("well_family").alias("_only")).unionByName(free.select("event_id", F.lit(None).cast("string").alias("_only")))
    inside = positive.join(both, "event_id").where(F.col("_only").isNull() | (F.col("_only") == F.col("_of"))).select("event_id", "op_id", "score")
    first = ops.select("op_id", "well_family").withColumn("_r", F.row_number().over(Window.partitionBy("well_family").orderBy("op_id"))).where(F.col("_r") <= 2 * k)
    zeros = own.join(first, "well_family").select("event_id", "op_id").unionByName(every_pair(free.select("event_id"), ops.select("op_id").orderBy("op_id").limit(2 * k)))
    zeros = zeros.join(inside, ["event_id", "op_id"], "left_anti").withColumn("score", F.lit(0.0))
    return ranked(inside.unionByName(zeros), k)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def dense_scores(queries: DataFrame, docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """(event_id, op_id, score): dot products of unit vectors; queries (event_id, qvec), docs (op_id, vec)."""
    return candidates.join(docs, "op_id").join(queries, "event_id").select("event_id", "op_id", F.round(dot(F.col("qvec"), F.col("vec")), 12).alias("score"))


def nearest(queries: DataFrame, vectors: DataFrame, k: int, places: int = 6) -> DataFrame:
    """(event_id, op_id, score, rank): the k vectors nearest to each query by dot product. All vectors are scanned, the queries go to them in counted blocks; Spark keeps k of each query before anything is shuffled."""
    blocks = max(1, -(-queries.count() // EVENT_BLOCK))
    dealt = queries.select("event_id", "qvec", F.pmod(F.xxhash64("event_id"), F.lit(blocks)).alias("_block"))
    scores = None
    for b in range(blocks):
        met = vectors.select("op_id", "vec", F.lit(b).cast("long").alias("_block")).join(F.broadcast(dealt.where(F.col("_block") == b)), "_block")
        part = met.select("event_id", "op_id", F.round(dot(F.col("qvec"), F.col("vec")), places).alias("score"))
        scores = part if scores is None else scores.unionByName(part)
    return ranked(scores, k)


Encoder = Callable[[list[str]], np.ndarray]


def no_encoder(texts: list[str]):
    raise RuntimeError("no sentence encoder is installed: give encode_texts() a function from texts to vectors")


def encode_texts(df: DataFrame, key: str, text: Column, encode: Encoder = no_encoder, batch: int = 256, name: str = "vec") -> DataFrame:
    """(key, name): a unit vector of each text by a function of the caller, which gets `batch` texts at a time. A text whose vector is zero stays zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, rows = b.column(1).to_pylist(), []
            for i in range(0, len(texts), batch):
                x = np.asarray(encode(texts[i : i + batch]), np.float32)
                rows += (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).tolist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float32()))], [key, name])

    return df.select(key, text.alias("_text")).mapInArrow(run, f"`{key}` {dict(df.dtypes)[key]}, {name} array<float>")


def dense_index(ops: DataFrame, encode: Encoder) -> DataFrame:
    """(op_id, vec): vectors of the operations' texts, normalized as for the sparse index."""
    return encode_texts(ops, "op_id", index_text(F.col("op_text")), encode)


def dense_queries(events: DataFrame, encode: Encoder) -> DataFrame:
    """(event_id, qvec): vectors of the events' texts, cleaned and normalized."""
    return encode_texts(events, "event_id", query_text(F.col("event_text")), encode, name="qvec")


def ranked(scores: DataFrame, k: int, score: str = "score") -> DataFrame:
    """The k best of each event with their rank from 1; ties by op_id. Spark limits groups before the shuffle."""
    r = F.row_number().over(Window.partitionBy("event_id").orderBy(F.desc(score), "op_id"))
    return scores.withColumn("rank", r).where(F.col("rank") <= k)


def _spread(c: str) -> Column:
    w = Window.partitionBy("event_id")
    lo, hi = F.min(c).over(w), F.max(c).over(w)
    return F.when(hi - lo < 1e-12, F.lit(0.5)).otherwise((F.col(c) - lo) / (hi - lo))


def fuse(sparse: DataFrame, dense: DataFrame, pool: int = POOL) -> DataFrame:
    """The union of both pools. A score from outside a method's own pool counts zero, before both are spread to [0, 1] and blended."""
    a = ranked(sparse, pool).select("event_id", "op_id", F.col("score").alias("tfidf"))
    b = ranked(dense, pool).select("event_id", "op_id", F.col("score").alias("sbert"))
    both = a.join(b, ["event_id", "op_id"], "full_outer").fillna(0.0, ["tfidf", "sbert"])
    return both.withColumns({"_a": _spread("tfidf"), "_b": _spread("sbert")}).withColumn("hybrid", F.round(BLEND[0] * F.col("_a") + BLEND[1] * F.col("_b"), 12)).drop("_a", "_b")


def rerank(fused: DataFrame, events: DataFrame, ops: DataFrame) -> DataFrame:
    """Adds entity_overlap and reranked. The event's text is cleaned and expanded before extraction, the corpus text is not."""
    q = events.select("event_id", entity_sets(query_text(F.col("event_text"))).alias("_q"))
    d = ops.select("op_id", "op_text")
    out = fused.join(d, "op_id").join(q, "event_id").withColumn("entity_overlap", overlap(F.col("_q"), entity_sets(F.col("op_text"))))
    return out.withColumn("reranked", F.round(RERANK[0] * F.col("hybrid") + RERANK[1] * F.col("entity_overlap"), 12)).drop("_q", "op_text")


METHODS = ["tfidf", "sbert", "hybrid", "reranked"]
# fixed values: columns of the matched operation, and of a match in order
MATCHED = ["well_family", "well_prefix", "report_date", "start_time", "end_time", "end_depth_md", "main_activity", "sub_activity", "state", "remark", "op_text"]
MATCH_COLUMNS = ["event_id", "nds_well", "nds_event_text", "match_type", "match_method", "rank", "similarity_score", "tfidf_score", "sbert_score", "entity_overlap", "matched_op_id", "matched_pdf", *[f"matched_{c}" for c in MATCHED]]


def match(events: DataFrame, ops: DataFrame, vectors: DataFrame, queries: DataFrame, top: int = 5, fallback_on_empty: bool = False, n: int | None = None) -> DataFrame:
    """The best operations of each event by four methods, in long form with the matched operation's columns."""
    pool = max(POOL, top)
    ops = ops.where(F.length(F.trim("op_text")) > 0)
    sparse = materialize(sparse_top(events, ops, pool, ops.count() if n is None else n, fallback_on_empty).drop("rank"), "sparse")
    dense = materialize(ranked(dense_scores(queries, vectors, scope(events, ops, fallback_on_empty)), pool).drop("rank"), "dense")
    full = materialize(rerank(fuse(sparse, dense, pool), events, ops), "pool")  # 2 * pool rows an event at most
    out = None
    for m in METHODS:
        if m in ("tfidf", "sbert"):  # ranked by the raw score within the method's own pool
            own = ranked(sparse if m == "tfidf" else dense, pool).select("event_id", "op_id")
            rows = full.join(own, ["event_id", "op_id"], "left_semi")
        else:
            rows = full
        rows = ranked(rows, top, m).select("event_id", "op_id", F.lit(m).alias("match_method"), "rank", F.round(m, 6).alias("similarity_score"), F.round("tfidf", 6).alias("tfidf_score"), F.round("sbert", 6).alias("sbert_score"), F.round("entity_overlap", 6).alias("entity_overlap"))
        out = rows if out is None else out.unionByName(rows)
    families = ops.select("well_family").distinct().withColumn("_own", F.lit(True))
    kind = F.when(F.col("has_pdf_corpus") & F.col("_own").isNotNull(), "strict_same_well").otherwise("cross_well_fallback")
    named = events.join(families, "well_family", "left").select("event_id", F.col("well_raw").alias("nds_well"), F.col("event_text").alias("nds_event_text"), kind.alias("match_type"))
    matched = ops.select("op_id", F.col("pdf_path").alias("matched_pdf"), *[F.col(c).alias(f"matched_{c}") for c in MATCHED])
    return out.join(named, "event_id").join(matched, "op_id").withColumnRenamed("op_id", "matched_op_id").select(*MATCH_COLUMNS)


def benchmark(matches: DataFrame) -> DataFrame:
    """One row an event: the best operation of each method side by side, and how far they agree."""
    best = matches.where("rank = 1").withColumn("_pdf", F.element_at(F.split("matched_pdf", "/"), -1))
    columns = [F.max(F.when(F.col("match_method") == m, F.col(c))).alias(f"{m}_{n}") for m in METHODS for c, n in (("similarity_score", "score"), ("_pdf", "pdf"), ("matched_well_family", "well"))]
    agree = [F.countDistinct("matched_pdf").alias("n_unique_pdfs"), F.countDistinct("matched_op_id").alias("n_unique_ops")]
    return best.groupBy("event_id", "nds_well", F.substring("nds_event_text", 1, 120).alias("nds_event_text"), "match_type").agg(*columns, *agree).withColumn("all_methods_agree", F.col("n_unique_ops") == 1)


def report_documents(reports: DataFrame, ops: DataFrame) -> DataFrame:
    """(pdf_path, pdf_filename, well_family, doc_text, n_ops): summary, plan and remarks in order, a line each, stripped. A report's remarks are one document by definition."""
    from ..functions.convert import strip

    said = ops.where("remark is not null").groupBy("pdf_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("op_index", "op_id", "remark"))), lambda x: x["remark"]), "\n").alias("remarks"), F.count("*").alias("n_ops"))
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    joined = reports.select("pdf_path", "well_family", "summary_24h", "planned_24h").join(said, "pdf_path", "left")
    return joined.select("pdf_path", F.element_at(F.split("pdf_path", "/"), -1).alias("pdf_filename"), "well_family", strip(F.concat_ws("\n", blank("summary_24h"), blank("planned_24h"), blank("remarks"))).alias("doc_text"), F.coalesce("n_ops", F.lit(0)).cast("long").alias("n_ops"))
