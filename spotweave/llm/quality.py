r"""Quality rules by weak supervision (op 10, native).

Each rule votes good (1), bad (-1) or abstains (0) on a document. Expectation-maximisation over the counts of
vote patterns estimates, for each rule, how it votes on good and on bad documents, and the share of good
ones; the posterior that a document is good replaces the usual demand that every rule passes. A document is
kept when it passes the base rule and its posterior is at least one half.

Features, votes and posteriors are DataFrame expressions; the vote patterns of r rules are at most 3 ** r
rows, whatever the size of the corpus, and only those reach the driver.

Words are runs of other characters than space and \x09-\x0D. Null texts have no words and, like empty ones,
fail the base rule. Repeated rows are judged alike; ties cannot arise; an empty table gives an empty result;
only doc_id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.llm.columns import indices, let
from spotweave.runtime import stage

SPACE = r"[\x20\x09-\x0D]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def repeated_words(words: Column) -> Column:
    """Words covered by a 3-word window that occurs twice or more in the array."""

    def covered(windows: Column) -> Column:
        marked = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = lambda m: F.transform(
            F.filter(m, lambda x, k: (x["h"] == F.get(m, k + 1)["h"]) | (x["h"] == F.get(m, F.greatest(k, F.lit(1)) - 1)["h"]) & (k > 0) | F.lit(False)), lambda x: x["i"]
        )
        spans = lambda p: F.aggregate(indices(F.size(p)), F.lit(0), lambda a, k: a + F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - F.get(p, k), F.lit(3))))
        return let(marked, lambda m: let(F.array_sort(again(m)), spans))

    def counted(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered(windows))

    hashed = lambda h: F.transform(indices(F.size(h) - 2), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(hashed(h), counted))


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(
        word_array(text),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).cast("long").alias("n_repeat_words")),
    )
    others = F.struct(
        (F.size(F.split(text, r"[#*$%&|<>]", -1)) - 1).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    return docs.select("doc_id", counts.alias("c"), others.alias("o")).select("doc_id", "c.n_words", "c.word_chars", "o.n_symbols", "o.n_dup_lines", "c.n_repeat_words")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def votes() -> list[Column]:
    """The rules: each 1, -1 or 0 from the counts."""
    mean = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    symbols, repeats = F.col("n_symbols") / F.greatest(F.col("n_words"), F.lit(1)), F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1))

    def rule(good: Column, bad: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    dense = F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))
    return [
        rule(F.lit(False), F.col("n_words") < 50),
        rule(mean.between(3, 9), (mean < 2) | (mean > 12)),
        rule(symbols <= 0.02, symbols > 0.1),
        rule(dense <= 0.005, dense > 0.02),
        rule(F.col("n_dup_lines") == 0, F.col("n_dup_lines") >= 5),
        rule(repeats <= 0.1, repeats > 0.3),
    ]


def fit_votes(patterns: list[tuple[tuple[int, ...], int]], *, steps: int = 100, prior: float = 0.8, smooth: float = 1.0, bad_if_good: float = 0.02, bad_if_bad: float = 0.3) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Share of good documents and, for each rule and vote, (probability if good, probability if bad).

    At first a rule is taken to vote bad on few good documents and on a fair share of bad ones; that also fixes
    which of the two classes is called good."""
    if not patterns:
        return prior, []
    rules, total = len(patterns[0][0]), sum(n for _, n in patterns)
    table = []
    for r in range(rules):
        up, none = (max(1e-6, sum(n for p, n in patterns if p[r] == v) / total) for v in (1, 0))
        rest = lambda bad, up=up, none=none: {-1: bad, 1: (1 - bad) * up / (up + none), 0: (1 - bad) * none / (up + none)}
        good, bad = rest(bad_if_good), rest(bad_if_bad)
        table.append({v: (good[v], bad[v]) for v in (-1, 0, 1)})
    for _ in range(steps):
        weights = [(p, n, posterior(p, prior, table)) for p, n in patterns]
        good = sum(n * g for _, n, g in weights)
        prior = min(0.999, max(0.001, good / total))
        table = [
            {v: ((sum(n * g for p, n, g in weights if p[r] == v) + smooth) / (good + 3 * smooth), (sum(n * (1 - g) for p, n, g in weights if p[r] == v) + smooth) / (total - good + 3 * smooth)) for v in (-1, 0, 1)}
            for r in range(rules)
        ]
    return prior, table


def posterior(pattern: tuple[int, ...], prior: float, table: list[dict[int, tuple[float, float]]]) -> float:
    z = math.log(prior / (1 - prior)) + sum(math.log(t[v][0] / t[v][1]) for v, t in zip(pattern, table, strict=True))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def posterior_column(cols: list[str], prior: float, table: list[dict[int, tuple[float, float]]]) -> Column:
    z = F.lit(math.log(prior / (1 - prior)))
    for c, t in zip(cols, table, strict=True):
        weight = {v: math.log(t[v][0] / t[v][1]) for v in (-1, 0, 1)}
        z = z + F.when(F.col(c) == 1, weight[1]).when(F.col(c) == -1, weight[-1]).otherwise(weight[0])
    return 1 / (1 + F.exp(-z))


def judge_quality(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS, base_failed, kept and posterior for every row of docs."""
    names = [f"v{i}" for i in range(len(votes()))]
    counted = stage(text_counts(docs).select("*", *[v.cast("byte").alias(n) for v, n in zip(votes(), names, strict=True)]), "quality-counts")
    found = counted.groupBy(*names).agg(F.count("*").alias("n")).collect()
    patterns = sorted((tuple(r[n] for n in names), r.n) for r in found)
    prior, table = fit_votes(patterns)
    good = posterior_column(names, prior, table) if table else F.lit(0.0)
    return counted.withColumn("base_failed", base_failed()).select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (good >= 0.5)).alias("kept"), good.alias("posterior"))
