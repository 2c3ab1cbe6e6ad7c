import os

import duckdb
import pytest

import __spark_entry__ as E
from riskflow.plans import catalog, oracle
from scripts.check_oracle import TABLES, digest
from tests.conftest import SF_SMALL


def test_entry_runs_with_rows(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 862
    assert df.columns == ["window_start", "window_end", "user_id", "window_amount", "window_count",
                          "avg_amount", "max_amount", "velocity", "fraud_reason", "rule_score"]


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_imports_without_the_llm_subpackage(tmp_path):
    """The rest works when the subpackage, its tests and the pipeline are gone."""
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/riskflow", tmp_path / "riskflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as E; q = E.queries(); assert q and set(q) == set(E.oracle_sql()), q.keys()"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


@pytest.mark.parametrize("name", ["transactions", "flag_windowed_closed", "payload_windowed", "flagged_topic"])
def test_results_do_not_depend_on_session_zone(spark, name):
    fn = E.queries()[name]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = sorted(map(tuple, fn(spark, SF_SMALL).collect()), key=repr)
    try:
        for tz in ("America/New_York", "Australia/Sydney"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert sorted(map(tuple, fn(spark, SF_SMALL).collect()), key=repr) == base, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
