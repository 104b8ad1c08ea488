"""The registered queries without the optional subpackage or a library it needs."""

import importlib
import sys
import warnings

import pytest


@pytest.mark.parametrize("missing", ["public_tokenizers", "tokenizers", "xxhash", "ahocorasick", "logquarry.llm", "corpus_pipeline"])
def test_the_library_needs_nothing_of_the_subpackage(monkeypatch, missing):
    import __spark_entry__ as entry

    for name in [n for n in sys.modules if n.startswith("logquarry.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    package = importlib.import_module("logquarry")
    if hasattr(package, "llm"):
        monkeypatch.delattr(package, "llm")
    monkeypatch.setitem(sys.modules, missing, None)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        found = entry.queries()
        assert set(entry.ORACLES) <= set(entry.oracle_sql())
    assert set(entry.QUERIES) <= set(found)
    if missing in ("public_tokenizers", "logquarry.llm"):
        assert set(found) == set(entry.QUERIES)
