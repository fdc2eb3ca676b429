"""Driver contract: entry, query registry and oracle keys."""

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["search_engine_domain", "search_keyword", "revenue", "rank"]
    assert [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1, len(rows) + 1))


def test_every_query_has_oracle():
    """Of the queries of the attribution package."""
    from oracle_sql import oracle_queries
    from touchline.plans.catalog import registry

    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(registry()) == set(oracle_queries()) and set(registry()) <= set(q)


def test_optional_operators_may_be_missing(tmp_path):
    """Without the optional subpackage the other queries are registered."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    for name in ("__spark_entry__.py", "oracle_sql.py"):
        shutil.copy(os.path.join(root, name), tmp_path)
    shutil.copytree(os.path.join(root, "touchline"), tmp_path / "touchline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), set(e.queries()) == set(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    from touchline.plans.catalog import registry

    assert said.stdout.split() == [str(len(registry())), "False", "True"], said.stderr
