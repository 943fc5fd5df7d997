"""The registered queries of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunkbpe, classifier, collisions, hilbert, linededup, ngramjoin, packing, pii, quality, token_output
from .common import documents


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_output(documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"), end_id=0)[1]


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"), 2048, end_id=0)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunkbpe.encode_decode(documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"), with_ids=False)


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard(documents(spark, sf_dir), 24)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(documents(spark, sf_dir), keep_text=False)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")


def op6_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 0.95)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_boilerplate(documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_dropped")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.jaccard_components(documents(spark, sf_dir), 3, 90, 100)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return classifier.score(docs, classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality"), 0.7)


def pii_key(spark: SparkSession) -> bytes:
    """The key of the session (spark.strata.pii.key); the registered queries, on synthetic tables, have one of their own."""
    return spark.conf.get("spark.strata.pii.key", "synthetic tables only").encode()


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(documents(spark, sf_dir), pii_key(spark)).select("doc_id", "text", "n_pii", "pii_kinds", "pii_spans")


def queries() -> dict:
    of = (op1_token_output, op2_pack, op3_bpe, op4_hilbert_shards, op5_quality_rules, op6_collisions, op7_line_dedup, op8_ngram_join, op9_quality_classifier, op10_pii)
    return {f.__name__: f for f in of}


def oracle_sql() -> dict[str, str]:
    return {"op7_line_dedup": linededup.ORACLE_SQL}
