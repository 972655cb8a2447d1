"""What is registered without the optional subpackage, or without something it needs."""

import sys

import pytest

import __spark_entry__ as entry
from hazegrid.plans import registry


@pytest.mark.parametrize("absent", ["hazegrid.llm.queries", "xxhash", "public_tokenizers", "corpus_pipeline"])
def test_a_missing_module_costs_no_other_query(monkeypatch, absent):
    for name in [m for m in sys.modules if m.startswith("hazegrid.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, absent, None)      # its import fails
    with pytest.warns(UserWarning, match="left out"):
        keys = set(entry.queries())
    assert keys >= set(registry.load()) and "pipeline" not in keys
    with pytest.warns(UserWarning):
        assert set(entry.oracle_sql()) <= keys
