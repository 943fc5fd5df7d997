"""A corpus pipeline of five stages: quality rules, line dedup, n-gram Jaccard join, PII, best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it
as Parquet in the shared folder and reads it again as the next stage's docs. All
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import linededup, ngramjoin, packing, pii, quality
from strata.llm.common import documents, materialize
from strata.llm.queries import pii_key

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _measured(docs: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars of the text as it now is."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.passing(docs.select(*COLUMNS))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go; the documents stay."""
    return _measured(linededup.drop_boilerplate(docs.select(*COLUMNS)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (five words, 0.8 or more) stays: the one of the smallest doc_id. Rows of a null doc_id stay."""
    docs = docs.select(*COLUMNS)
    gone = ngramjoin.jaccard_components(docs, 5, 80, 100).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by pseudonyms."""
    return _measured(pii.pseudonymize(docs.select(*COLUMNS), pii_key(spark)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place."""
    import public_tokenizers

    # workers that serve all stages keep less than those of one
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, end_id=0, memo=1 << 20)


STAGES = [("quality rules", quality_stage), ("line dedup", line_stage), ("n-gram jaccard join", near_duplicate_stage), ("pii", pii_stage), ("best-fit packing", packing_stage)]

#: token ids and the permutation of values are beyond SQL; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
