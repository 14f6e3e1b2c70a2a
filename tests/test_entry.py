"""The driver's contract, with and without the corpus subpackage."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent
SF = Path("/root/testdata/sf0.001")
SAMPLE = ["content_search", "url_normalize", "rule_resolve", "validate_codes", "content_upsert", "fifo_drain", "failure_window", "ttl_dedup", "path_infer_category", "p7_found"]


def test_names_and_sql_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 100


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", SAMPLE)
def test_sample_against_sql(spark, name):
    con = duckdb.connect()
    for p in SF.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    df = entry.queries()[name](spark, str(SF))
    cols = sorted(df.columns)
    got = sorted(str([f"{v:.9g}" if isinstance(v, float) else v for v in r]) for r in df.select(*cols).collect())
    res = con.execute(entry.oracle_sql()[name])
    order = [[d[0] for d in res.description].index(c) for c in cols]
    want = sorted(str([f"{r[i]:.9g}" if isinstance(r[i], float) else r[i] for i in order]) for r in res.fetchall())
    assert got == want


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
def test_entry(spark):
    assert entry.entry(spark).columns == ["delivery_id"]


def test_core_does_not_import_the_subpackage():
    code = "import sys; sys.modules['harrowmill.llm'] = None\nimport importlib\n" + "\n".join(f"importlib.import_module('{m}')" for m in entry.CORE)
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True).returncode == 0
    for p in (ROOT / "harrowmill").rglob("*.py"):
        if "llm" not in p.parts:
            assert "harrowmill.llm" not in p.read_text()
