"""Every registered query against its DuckDB statement (rule tables) on sf0.001."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from __spark_entry__ import entry
from billmodel.plans.oracle import oracle_queries
from billmodel.plans.registry import registered_queries
from conftest import SF_SMALL
from tools.oracle_check import compare, duck_connection

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
QUERIES = registered_queries()
SQL = oracle_queries()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL[name], SF_SMALL)
    assert r["cols_match"], r
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "bb_cost" in df.columns and df.columns[-1] == "bb_usage_year_month"


def test_benchs_projection_is_the_oracles_wide_table(con):
    """The yardstick that is timed gives the table that is checked."""
    from billmodel.plans.oracle import fixture_ctes
    from tools.duckdb_projection import projection

    con.execute(f"CREATE OR REPLACE TEMP TABLE bill AS WITH {fixture_ctes()} SELECT * FROM cur")
    names = [d[0] for d in con.sql(f"SELECT * FROM ({projection('bill')}) LIMIT 0").description]
    con.execute(f"CREATE OR REPLACE TEMP TABLE plain AS {projection('bill')}")
    con.execute(f"CREATE OR REPLACE TEMP TABLE checked AS {SQL['wide_costs']}")
    assert sorted(names) == sorted(d[0] for d in con.sql("SELECT * FROM checked LIMIT 0").description)
    typed = {c: t for c, t, *_ in con.sql("DESCRIBE checked").fetchall()}
    listed = lambda _: ", ".join(f'CAST("{c}" AS {k}) AS "{c}"' for c, k in sorted(typed.items()))
    differ = con.sql(f"(SELECT {listed('plain')} FROM plain EXCEPT ALL SELECT {listed('checked')} FROM checked)").fetchall()
    assert differ == [] and con.sql("SELECT count(*) FROM plain").fetchall() == con.sql("SELECT count(*) FROM checked").fetchall()


@pytest.mark.parametrize("missing", ["billmodel.llm", "corpus_pipeline", "zstandard", "xxhash"])
def test_entry_without_the_document_operators(missing):
    """Where they or a library of theirs can't be imported, the model's queries stay."""
    code = (f"import sys; sys.modules[{missing!r}] = None; sys.path.insert(0, {ROOT!r})\n"
            "import __spark_entry__ as e\nassert 'wide_costs' in e.queries() and not any(q.startswith('op') for q in e.queries())\n"
            "assert set(e.queries()) == set(e.oracle_sql())")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
