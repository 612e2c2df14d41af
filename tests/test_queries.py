"""Every query with SQL against DuckDB on the smallest tables, the others run; and the package without its subpackage."""

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from cadenza import queries as core  # noqa: E402
from verify import norm  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in sorted(os.listdir(DATA)):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_core_query(spark, con, name):
    df = core.QUERIES[name](spark, DATA)
    rows = [tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    if name not in core.ORACLES:
        assert rows
        return
    got = con.execute(core.ORACLES[name])
    cols = [c[0] for c in got.description]
    assert sorted(cols) == sorted(df.columns)
    order = [cols.index(c) for c in sorted(cols)]
    assert sorted(map(repr, rows)) == sorted(repr(tuple(norm(r[i]) for i in order)) for r in got.fetchall())


def test_entry_without_the_subpackage():
    code = "import sys; sys.modules['cadenza.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'p3_found' in q and 'p1_found' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_nothing_else_imports_the_subpackage():
    for f in (ROOT / "cadenza").rglob("*.py"):
        if "llm" not in f.parts:
            assert "llm" not in f.read_text(encoding="utf-8"), f
