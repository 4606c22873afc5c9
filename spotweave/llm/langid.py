"""Language identification by compression (op 3).

Each language has a zstandard raw-content dictionary made from a bounded draw of labelled text. A text is
cut into blocks, every block is compressed once with each dictionary, and the language with the smallest
total wins. Where the best and second totals lie within `margin` of each other the row is marked
`rejected`; lang_pred still names the best language, and score falls towards 1 / 2.

Null texts and texts without a letter are `und` with score 0; repeated rows are treated alike; ties go to
the language first in order; without labelled text every row is `und`; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.llm.toxicity import fold
from spotweave.runtime import limit_batches

BLOCK = 4096


def learn_dictionaries(docs: DataFrame, *, docs_per_language: int = 400, excerpt: int = 1000, dictionary_bytes: int = 96_000, folds: int = 4, held_fold: int = 2) -> dict[str, bytes]:
    """Raw dictionary content by language, from about docs_per_language excerpts of the training fold."""
    limit_batches(docs.sparkSession)
    train = docs.select("doc_id", "text", "lang").where((fold(F.col("doc_id"), folds) != held_fold) & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r.lang: r.n for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    # a row for each language, made on the driver
    rates = docs.sparkSession.createDataFrame([(k, min(1.0, docs_per_language / n)) for k, n in counts.items()], "lang string, rate double")
    draw = F.xxhash64("doc_id", "text", F.lit("langid")).bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    start = F.greatest(F.lit(0), F.pmod(F.xxhash64("doc_id", "text", F.lit("start")), F.greatest(F.lit(1), F.length("text") - excerpt))).cast("int")
    drawn = train.join(F.broadcast(rates), "lang").where(draw < F.col("rate")).select("lang", F.xxhash64("doc_id", F.lit("order")).alias("o"), F.substring(F.col("text"), start + 1, F.lit(excerpt)).alias("t"))
    rows = drawn.groupBy("lang", "t").agg(F.min("o").alias("o")).collect()  # rows that are alike in id and text are drawn together, and count once
    out: dict[str, bytes] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.o, r.t)):
        if len(out.get(r.lang, b"")) < dictionary_bytes:
            out[r.lang] = out.get(r.lang, b"") + normal(r.t) + b"\n"
    return {k: v[:dictionary_bytes] for k, v in out.items()}


def normal(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


class CompressionClassifier:
    """The dictionaries, ready to compress; one per Python worker."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 5, margin: float = 0.01):
        self.margin = margin
        self.compressors = [
            (k, zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(v, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False))
            for k, v in sorted(dictionaries.items())
        ]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.compressors or not any(map(str.isalpha, text)):
            return "und", 0.0, True
        raw = normal(text)
        if len(raw) < 256:  # short texts: repeats would hide nothing, and words at both ends count alike
            raw = b" " + raw + b" "
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), k) for k, c in self.compressors)
        if len(sizes) == 1:
            return sizes[0][1], 1.0, False
        (best, lang), (second, _) = sizes[:2]
        gap = (second - best) / max(1, second)
        return lang, 1 / (1 + math.exp(-40 * gap)), gap < self.margin


def predicted_language(dictionaries: dict[str, bytes], text: Column, *, level: int = 5, margin: float = 0.01) -> Column:
    """struct<lang_pred, score, rejected> of a text column."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = CompressionClassifier(dictionaries, level, margin)
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score", "rejected"]).astype({"lang_pred": object, "score": "float64", "rejected": bool})

    return predict(text)


def identify_language(docs: DataFrame, **how) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of docs."""
    found = predicted_language(learn_dictionaries(docs, **how), F.col("text"))
    return docs.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), found.alias("p")).select("doc_id", "held_out", "p.*")
