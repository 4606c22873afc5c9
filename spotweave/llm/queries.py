"""The registered queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm import decontam, langid, linededup, medians, ngram_join, packing, pii, quality, secrets, substrings, toxicity, vectors, warc
from spotweave.runtime import read


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_language(read(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive_records(read(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(read(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(read(spark, sf_dir, "documents")).withColumn("posterior", F.round("posterior", 6))


def op11_rolling_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medians.rolling_median(read(spark, sf_dir, "clicks"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.compress(read(spark, sf_dir, "embeddings"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_packing, op3_language, op4_warc, op5_decontamination, op6_line_dedup, op7_pii, op8_ngram_join, op9_secrets, op10_quality, op11_rolling_median, op12_vector_codes, op13_substring_dedup)}
