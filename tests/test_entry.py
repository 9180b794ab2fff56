import sys

import __spark_entry__


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["status", "edges", "refs", "sources"] and df.count() == 2


def test_without_the_text_operators(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("weavegraph.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "weavegraph.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    queries = __spark_entry__.queries()
    assert len(queries) > 190 and not any(q.startswith("op") or q == "pipeline" for q in queries)
    assert set(__spark_entry__.oracle_sql()) <= set(queries)


def test_with_a_text_operator_that_lacks_a_dependency(monkeypatch):
    """A missing package takes the text operators with it, and no query of the library."""
    for name in [m for m in sys.modules if m.startswith("weavegraph.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "pyarrow.compute", None)
    assert len(__spark_entry__.queries()) > 190
