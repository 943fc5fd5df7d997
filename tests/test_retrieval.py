"""Candidates and searches of the retrieval operators against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import mining, retrieval


@pytest.mark.parametrize(("n", "block"), [(10_060, None), (60, 7), (60, 60)])
def test_scope_keeps_all_events(spark, monkeypatch, n, block):
    if block:
        monkeypatch.setattr(retrieval, "EVENT_BLOCK", block, raising=False)
    families = ["a", "b", "c"]  # a: own operations; b: none by rule; c: should have some and has none
    events = spark.createDataFrame([(i, families[i % 3]) for i in range(n)] + [(n, "b")] * 60, "event_id int, well_family string").dropDuplicates()
    events = events.withColumn("has_pdf_corpus", F.col("well_family") != "b").coalesce(1)
    ops = spark.createDataFrame([(i, "a" if i < 4 else "d") for i in range(6)], "op_id long, well_family string")
    for fallback in (False, True):
        got = sorted(map(tuple, retrieval.scope(events, ops, fallback).collect()))
        own = {"a": range(4), "b": range(6), "c": range(6) if fallback else ()}
        assert got == sorted((e, o) for e, f, _ in events.collect() for o in own[f])


def test_scope_beyond_the_bound(spark):
    events = spark.range(10_060).select(F.col("id").cast("int").alias("event_id"), F.lit("b").alias("well_family"), F.lit(False).alias("has_pdf_corpus"))
    ops = spark.createDataFrame([(1, "a"), (2, "a")], "op_id long, well_family string")
    out = retrieval.scope(events, ops)
    assert out.count() == out.distinct().count() == 20_120


def _encoder():
    def letters(texts):
        return np.array([[t.lower().count(c) for c in "abcdefghijklmnopqrstuvwxyz"] for t in texts], np.float32)

    return letters  # of no module that workers would have to find


#: letters as a vector; stands in for a model
toy_encoder = _encoder()


def test_encoder(spark):
    ops = spark.createDataFrame([(i, f"POOH with {'x' * i} BHA") for i in range(600)], "op_id long, op_text string")
    got = {r.op_id: np.array(r.vec) for r in retrieval.dense_index(ops, toy_encoder).collect()}
    want = toy_encoder(["POOH (pull out of hole) with xx BHA (bottom hole assembly)"])[0]
    assert len(got) == 600 and np.allclose(got[2], want / np.linalg.norm(want), atol=1e-6)
    events = spark.createDataFrame([(1, "load load on BHA"), (2, "")], "event_id int, event_text string")
    q = {r.event_id: np.array(r.qvec) for r in retrieval.dense_queries(events, toy_encoder).collect()}
    assert abs(np.linalg.norm(q[1]) - 1) < 1e-6 and not q[2].any()
    with pytest.raises(Exception, match="no sentence encoder"):
        retrieval.dense_index(ops, retrieval.no_encoder).collect()


@pytest.mark.parametrize("block", [3, 10_000])
def test_nearest(spark, monkeypatch, block):
    monkeypatch.setattr(retrieval, "EVENT_BLOCK", block)
    v = np.random.default_rng(1).standard_normal((200, 8)).round(3)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "op_id long, vec array<double>")
    q = df.where("op_id % 20 = 0").selectExpr("op_id event_id", "vec qvec")
    got = sorted((r.event_id, r["rank"], r.op_id) for r in retrieval.nearest(q, df, 4).collect())
    want = [(i, k + 1, int(j)) for i in range(0, 200, 20) for k, j in enumerate(np.lexsort((np.arange(200), -(v @ v[i]).round(6)))[:4])]
    assert got == sorted(want)


def test_sparse_top_fills_with_the_first_operations(spark):
    ops = spark.createDataFrame([(i, "a" if i % 2 else "b", "pump stuck here" if i in (3, 8, 9) else f"calm and quiet day {i % 3}") for i in range(40)], "op_id long, well_family string, op_text string")
    events = spark.createDataFrame([(1, "a", True, "pump stuck"), (2, "z", False, "pump stuck"), (3, "y", True, "pump stuck")], "event_id int, well_family string, has_pdf_corpus boolean, event_text string")
    for fallback in (False, True):
        scores = retrieval.ranked(retrieval.sparse_scores(events, ops, retrieval.scope(events, ops, fallback), 40), 6)
        want = sorted(map(tuple, scores.select("event_id", "op_id", "rank", "score").collect()))
        got = sorted(map(tuple, retrieval.sparse_top(events, ops, 6, 40, fallback).select("event_id", "op_id", "rank", "score").collect()))
        assert got == want and len({e for e, *_ in got}) == 2 + fallback


def test_match_without_own_operations(spark):
    """An event whose well should have reports and has none gets no match, or, if asked for, one across wells."""
    ops = spark.createDataFrame([(i, f"d/p{i}.pdf", "a", "a", None, "", "", 1.0, "m", None, "ok", "r", f"pump {i} stuck at 500 m") for i in range(5)], "op_id long, pdf_path string, well_family string, well_prefix string, report_date date, start_time string, end_time string, end_depth_md double, main_activity string, sub_activity string, state string, remark string, op_text string")
    events = spark.createDataFrame([(1, "A", "a", True, "pump stuck"), (2, "Z", "z", True, "pump stuck"), (3, "Y", "y", False, "pump stuck")], "event_id int, well_raw string, well_family string, has_pdf_corpus boolean, event_text string")
    vectors, queries = retrieval.dense_index(ops, toy_encoder), retrieval.dense_queries(events, toy_encoder)
    for fallback, kinds in ((False, {1: "strict_same_well", 3: "cross_well_fallback"}), (True, {1: "strict_same_well", 2: "cross_well_fallback", 3: "cross_well_fallback"})):
        m = retrieval.match(events, ops, vectors, queries, fallback_on_empty=fallback)
        assert m.columns == retrieval.MATCH_COLUMNS and {r.event_id: r.match_type for r in m.collect()} == kinds
        b = retrieval.benchmark(m)
        assert b.first().tfidf_pdf == "p0.pdf" and {r.tfidf_well for r in b.collect()} == {"a"} and len(b.columns) == 19


def test_samples(spark):
    df = spark.range(300).selectExpr("id % 30 as k", "id")
    assert [sorted({r.k for r in mining.sample_rows(df, "k", 3, seed=s).collect()}) for s in (None, 5, 5)][0] == [0, 1, 2]
    one, two, other = (sorted(map(tuple, mining.sample_rows(df, "k", 3, seed=s).collect())) for s in (5, 5, 6))
    assert one == two != other and len(one) == 30
