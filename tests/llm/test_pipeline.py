"""Every stage judged on its own input against brute force, odd input, and the whole run."""

import collections

import pytest
from pyspark.sql import functions as F
from test_operators import EMPTY, ODD, brute_components, brute_hits, dedup_by_brute_force

import corpus_pipeline
from spotweave.llm import ngram_join, packing, queries, toxicity
from spotweave.runtime import read

STAGES = dict(corpus_pipeline.STAGES)


def rows(df):
    return collections.Counter(tuple(r[c] for c in ("doc_id", "text", "lang", "source")) for r in df.collect())


def test_stages(spark, sf):
    """The chain on the smallest table: what each stage keeps is what brute force keeps of the same input."""
    assert list(STAGES) == ["toxicity", "line_dedup", "ngram_join", "decontamination", "packing"]
    docs = read(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars").cache()
    clean = STAGES["toxicity"](spark, docs, sf).cache()
    scores = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, read(spark, sf, "labels")).collect()}
    assert {r.doc_id for r in clean.collect()} == {d for d, p in scores.items() if not p}

    lined = STAGES["line_dedup"](spark, clean, sf).cache()
    want = dedup_by_brute_force({r.doc_id: r.text for r in clean.collect()})
    old = {r.doc_id: r.text for r in clean.collect()}
    assert {r.doc_id: r.text for r in lined.collect()} == {d: t if n else old[d] for d, (t, _, n) in want.items() if not n or t.strip(" \n\r\t")}
    assert lined.where(F.length("text") != F.col("n_chars")).count() == 0 or clean.where(F.length("text") != F.col("n_chars")).count() > 0

    joined = STAGES["ngram_join"](spark, lined, sf).cache()
    groups = brute_components([(r.doc_id, r.text) for r in lined.collect()])
    assert {r.doc_id for r in joined.collect()} == {d for d, _, first in groups if d == first}

    free = STAGES["decontamination"](spark, joined, sf).cache()
    items = [(str(r.item_id), r.text) for r in read(spark, sf, "benchmark").collect()]
    hits = brute_hits([(r.doc_id, r.text) for r in joined.collect()], items)
    assert {r.doc_id for r in free.collect()} == {k[0] for k in hits if not k[5]}
    for df in (clean, lined, joined, free):
        assert df.columns == docs.columns

    encode = packing.load_encoder(queries.tokenizer_path())
    packed = {r.doc_id: r.n for r in STAGES["packing"](spark, free, sf).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert packed == {r.doc_id: len(encode(r.text) if r.text else []) + 1 for r in free.collect()}


@pytest.mark.parametrize("name", ["toxicity", "line_dedup", "ngram_join", "decontamination", "packing"])
def test_stages_on_odd_input(spark, sf, name):
    """Nulls, empty and very long texts, repeated rows, clashing columns, and no rows at all."""
    base = [(10_000 + i, t, "en", "s", len(t or "")) for i, t in enumerate(ODD)] + [(10_001, "", "en", "s", 0)] * 3 + [(None, None, None, None, None), (None, "a text of no document", None, None, None)]
    odd = spark.createDataFrame(base, EMPTY).withColumns({c: F.lit(1) for c in ("edit", "edit_id", "gone_id", "score", "sig", "key", "is_positive", "drawn", "contaminated")})
    for df in (odd, odd.limit(0)):
        out = STAGES[name](spark, df, sf)
        if name != "packing":
            assert out.columns == df.columns
            assert set(rows(out.select("doc_id", F.lit(1).alias("text"), "lang", "source"))) <= set(rows(df.select("doc_id", F.lit(1).alias("text"), "lang", "source")))
            assert (out.where("doc_id is null").count() > 0) == (df.count() > 0)
        assert (out.count() > 0) == (df.count() > 0)


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert 0 < out.count()
    assert out.agg({"length": "max"}).first()[0] <= 2048


def test_packing_holds_no_library():
    """A worker keeps its encoder for later tasks, but the file's own library only while a task has texts that need it."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_path())
    encode = packing.load_encoder(queries.tokenizer_path())
    added = next(iter(plain.get_added_tokens_decoder().values())).content
    for text, needed in (("It's plain. ", False), ("x" * 5000, True), (f"a {added} b", True), ("again 漢字", False)):
        encode.release()
        assert not encode.held
        assert encode(text) == plain.encode(text, add_special_tokens=False).ids
        assert bool(encode.held) == needed


def test_join_asks_once(spark, sf, monkeypatch, capsys):
    """No step of the n-gram join has two Python workers in one task: each stays, with its memory, for the stages that follow."""
    plans, stage = [], ngram_join.stage

    def watched(df, name):
        capsys.readouterr()
        df.explain()
        plans.append((name, capsys.readouterr().out))
        return stage(df, name)

    monkeypatch.setattr(ngram_join, "stage", watched)
    ngram_join.keep_first(read(spark, sf, "documents"))
    assert "join-left-over" in dict(plans)
    for name, plan in plans:
        run = 0
        for line in plan.splitlines():
            run = 0 if "Exchange" in line else run + any(x in line for x in ("ArrowEvalPython", "MapInPandas"))
            assert run < 2, (name, plan)
