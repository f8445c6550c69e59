"""The driver contract loads __spark_entry__.py by path from any cwd."""

from __future__ import annotations

import importlib.util
import os

from conftest import ROOT


def test_entry_loads_by_path_from_elsewhere(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    spec = importlib.util.spec_from_file_location("driver_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0 and df.columns[0] == "pair"
    from ticklake.plans import registry

    assert set(registry.queries()) <= set(mod.queries()) & set(mod.oracle_sql())
