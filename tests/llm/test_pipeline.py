"""The pipeline against the same stages by brute force."""

import importlib.util
import zlib
from collections import Counter

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
if importlib.util.find_spec("corpus_pipeline") is None:
    pytest.skip("no corpus_pipeline", allow_module_level=True)
import corpus_pipeline  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from strata.llm import linededup, pii  # noqa: E402
from strata.llm.queries import pii_key  # noqa: E402

from .test_operators import SF, brute_jaccard  # noqa: E402


def drop_lines(rows):
    """rows: doc_id -> (text, source)"""
    pages, seen = Counter(s for _, s in rows.values()), Counter()
    for t, s in rows.values():
        seen.update({(s, x.strip(linededup.SPACE)) for x in t.split("\n") if x.strip(linededup.SPACE)})
    bad = {k for k, n in seen.items() if n >= linededup.MIN_PAGES and n > linededup.RATIO * pages[k[0]]}
    return {d: "\n".join(x for x in t.split("\n") if (s, x.strip(linededup.SPACE)) not in bad) for d, (t, s) in rows.items()}


def test_run(spark):
    docs = {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = [r.doc_id for r in corpus_pipeline.quality_stage(spark, corpus_pipeline.documents(spark, SF), SF).collect()]
    texts = drop_lines({d: docs[d] for d in kept})
    texts = {d: texts[d] for d, (_, c) in brute_jaccard(list(texts.items()), 5, 80, 100).items() if c == d}
    f, t, want = pii.Feistel(pii_key(spark)), Tokenizer.from_file(P.path("word_bpe_49k.json")), Counter()
    for d, text in texts.items():
        x = np.append(np.array(t.encode(pii.replace(text, f)[0], add_special_tokens=False).ids, "<u4"), 0).astype("<u4")
        want.update((d, k // 2048, len(x[k : k + 2048]), zlib.crc32(x[k : k + 2048].tobytes())) for k in range(0, len(x), 2048))
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows) == want
    assert max(sum(r.length for r in rows if r.sequence_id == s) for s in {r.sequence_id for r in rows}) <= 2048


def test_stages_keep_columns(spark):
    docs = corpus_pipeline.documents(spark, SF)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == corpus_pipeline.COLUMNS


ODD = [(1, "The cat sat on the mat and the dog lay by the door of the old house in the town near the sea.", "en", "a", 1), (2, None, None, None, None), (3, "", "xx", "a", 0), (5, "a  b\n\n c\td", "de", "", 1), (5, "a  b\n\n c\td", "de", "", 1), (None, "no id 4801146876264569", "fr", "b", 5), (7, "###\n \n***", "en", None, 1), (8, "the quick brown fox, jumps over a lazy dog. " * 3000, "en", "a", 1)]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_of_odd_and_empty_tables(spark, name):
    """Nulls in any column, empty and very long texts, repeated rows, no rows, and columns whose names the stage adds itself."""
    stage = dict(corpus_pipeline.STAGES)[name]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept int, n int, n_dropped string, n_pii int, piece string, _h1 int"
    odd = spark.createDataFrame([(*r, 1, 2, "3", 4, "5", 6) for r in ODD], schema)
    rows = stage(spark, odd, SF).collect()
    left = Counter(r.doc_id for r in rows)
    assert stage(spark, odd.limit(0), SF).count() == 0
    if name == "quality rules":  # fewer than 20 words, or repeated windows
        assert left == {1: 1}
    elif name == "n-gram jaccard join":  # equal rows of one doc_id are one node, which stays
        assert left == Counter(r[0] for r in ODD)
    elif name == "best-fit packing":
        assert set(left) == {r[0] for r in ODD} and left[8] > 1 and sum(r.start == 0 for r in rows) == len(ODD)
    else:
        assert left == Counter(r[0] for r in ODD)
        by = {r.doc_id: r for r in rows}
        assert by[2].text is None and by[3].text == "" and by[8].n_chars == len(ODD[-1][1])
        assert (by[None].text == "no id 4801146876264569") == (name != "pii")


def test_near_duplicates_leave_one(spark):
    base = " ".join(f"word{i}" for i in range(100))
    rows = [(9, base, "en", "a", 1), (4, base + " end", "en", "b", 1), (6, base, None, None, None), (2, "quite another text of some words here", "en", "a", 1), (None, base, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert Counter(r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()) == {4: 1, 2: 1, None: 1}
