"""The corpus pipeline: toxicity, line dedup, n-gram join, decontamination, packing, each a stage that reads
what the one before has written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm import decontam, linededup, ngram_join, packing, toxicity
from spotweave.llm.queries import tokenizer_path
from spotweave.runtime import delete, read, release, shared_dir, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half; the others go."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxicity_score(model, F.col("text")) < 0.5)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that an earlier place holds already."""
    return linededup.deduplicated(docs)


def join_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return ngram_join.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of equal capacity."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("ngram_join", join_ngrams), ("decontamination", decontaminate), ("packing", pack)]

#: No SQL expresses the classifier and the tokenizer; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has read and staged is deleted as soon as its own output is written."""
    docs, before = read(spark, sf_dir, "documents"), None
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out, held = f"{base}/{name}", staged()
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        release(spark, held)
        if before:
            delete(spark, before)
        before = out
    return docs
