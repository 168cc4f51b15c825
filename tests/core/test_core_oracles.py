import pytest
from oracle import compare

from lakeloom.plans import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_statement(spark, sf_dir, name):
    compare(spark, sf_dir, queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_rounds_are_rewritten_with_nesting():
    assert queries.on_decimals("SELECT round(a / (b + f(1, 2)), 2), x") == "SELECT CAST(ROUND(CAST(a / (b + f(1, 2)) AS DECIMAL(38,8)), 2) AS DOUBLE), x"


def test_rest_imports_without_the_optional_part():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    code = "import sys; sys.modules['lakeloom.llm'] = None; sys.meta_path.insert(0, type('No', (), {'find_spec': staticmethod(lambda n, p=None, t=None: (_ for _ in ()).throw(ModuleNotFoundError(n)) if n.startswith('lakeloom.llm') else None)}))\nimport lakeloom.plans.queries, lakeloom.plans.medallion, lakeloom.streaming.ingest"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
