import importlib
import sys

import __spark_entry__


def test_entry_and_registry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_stands_without_the_llm_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("spotweave.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "spotweave.llm", None)
    fresh = importlib.reload(__spark_entry__)
    names = fresh.queries()
    assert "region_pairs" in names
    assert not [n for n in names if n.startswith("op") or n == "pipeline"]
