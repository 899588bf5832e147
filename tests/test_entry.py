"""The driver's contract, and the library without its text subpackage."""

import subprocess
import sys
import textwrap
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
FAST = ["url_normalized", "id_of_items", "archive_upserted", "view_window", "items_distinct", "story_of_pages", "stats_by_site", "p2_found", "p7_found"]


def test_names_agree():
    import __spark_entry__ as e

    queries, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 60
    # Whether the text subpackage is there or not.
    for n in (2, 6, 7):
        assert f"p{n}_found" in queries


def test_flagship(spark, sf_dir):
    import __spark_entry__ as e

    if not Path(sf_dir).exists():
        pytest.skip("no test data")
    assert e.entry(spark).count() > 0


@pytest.mark.parametrize("name", FAST)
def test_equals_sql(spark, sf_dir, name):
    import __spark_entry__ as e

    if not Path(sf_dir).exists():
        pytest.skip("no test data")
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = e.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    cur = c.execute(e.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols

    def plain(v):
        return round(float(v), 6) if isinstance(v, float) else v

    want = sorted(repr([plain(dict(zip(names, r, strict=True))[k]) for k in cols]) for r in cur.fetchall())
    got = sorted(repr([plain(r[k]) for k in cols]) for r in df.collect())
    assert got == want


def test_rest_works_without_the_text_subpackage():
    code = """
    import sys
    class Absent:
        def find_spec(self, name, path=None, target=None):
            if name.startswith("newsloom.llm"):
                raise ImportError(name)
    sys.meta_path.insert(0, Absent())
    import __spark_entry__ as e
    import newsloom.plans.pipeline, newsloom.streaming.ingest, newsloom.sinks.payloads, newsloom.sources.files
    assert "p2_found" in e.queries() and "p1_found" not in e.queries()
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_the_text_subpackage():
    for p in (ROOT / "newsloom").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert "newsloom.llm" not in p.read_text(), p
