"""The entry file without the optional subpackage or a library that it needs."""

import builtins
import importlib
import sys

import pytest


@pytest.mark.parametrize("missing", ["corpus_pipeline", "cardflow.llm", "public_tokenizers", "regex", "ahocorasick"])
def test_a_missing_optional_part_costs_no_other_query(monkeypatch, missing):
    whole = builtins.__import__

    def blocked(name, globals=None, locals=None, fromlist=(), level=0):
        if name == missing or name.startswith(missing + "."):
            raise ImportError(f"blocked: {name}")
        return whole(name, globals, locals, fromlist, level)

    entry = importlib.import_module("__spark_entry__")
    kept = {n: m for n, m in sys.modules.items() if n == "corpus_pipeline" or n.startswith("cardflow.llm")}
    for n in kept:
        monkeypatch.delitem(sys.modules, n)
    monkeypatch.setattr(builtins, "__import__", blocked)
    try:
        names, sql = set(entry.queries()), set(entry.oracle_sql())
    finally:
        monkeypatch.undo()
        sys.modules.update(kept)
    from cardflow.registry import QUERIES
    from sqlcheck.queries import ORACLE
    assert set(QUERIES) <= names and set(ORACLE) & set(QUERIES) <= sql
