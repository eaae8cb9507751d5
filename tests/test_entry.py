"""Driver contract."""
import importlib.util
import os


def _entry():
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_runs(spark):
    m = _entry()
    df = m.entry(spark)
    assert df.count() >= 1
    assert set(m.oracle_sql()) <= set(m.queries())


def test_entry_needs_no_optional_part(monkeypatch):
    """Without the optional subpackage and pipeline, everything else is still registered."""
    import sys
    full = set(_entry().queries())
    for name in ("stratum.llm", "stratum.llm.queries", "corpus_pipeline"):
        monkeypatch.setitem(sys.modules, name, None)
    rest = set(_entry().queries())
    assert rest <= full and "cap_outliers" in rest
    assert not any(k == "pipeline" or k.startswith("op") and k[2:3].isdigit() for k in rest)
