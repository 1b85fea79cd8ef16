"""Every query of the library against its SQL, on the smallest test tables."""

import pytest

from quillspan.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_sql(name, same_rows):
    assert name in catalogue.SQL
    same_rows(catalogue.QUERIES[name], catalogue.SQL[name])


def test_entry(spark, data):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_library_stands_without_the_training_package():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    for f in (root / "quillspan").rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "quillspan.llm" not in f.read_text(), f
    code = "import sys; sys.modules['quillspan.llm'] = None\nimport __spark_entry__ as e\nassert not [q for q in e.queries() if q.startswith('p1')]\nassert 'p5_found' in e.queries()"
    got = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert got.returncode == 0, got.stderr
