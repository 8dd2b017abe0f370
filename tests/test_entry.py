"""The driver's entry with and without the optional part."""

import importlib
import sys

import pytest

ROOT_QUERIES = {"dash_channel_kpis", "run_repeated", "flatten_threads"}


def fresh_entry(monkeypatch, missing):
    """The entry module imported anew while ``missing`` cannot be imported."""
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith(("chorale.llm", "__spark_entry__"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    return importlib.import_module("__spark_entry__")


@pytest.mark.parametrize("missing", ["ahocorasick", "corpus_pipeline", "chorale.llm"])
def test_entry_without_the_optional_part(monkeypatch, missing):
    import chorale

    monkeypatch.delattr(chorale, "llm", raising=False)
    if missing == "ahocorasick":
        pytest.importorskip("corpus_pipeline")
    with pytest.warns(UserWarning, match="training-data queries are left out"):
        entry = fresh_entry(monkeypatch, missing)
    assert ROOT_QUERIES <= entry.queries().keys()
    assert not [q for q in entry.queries() if q.startswith("op") or q == "pipeline"]
    assert entry.oracle_sql().keys() <= entry.queries().keys()
