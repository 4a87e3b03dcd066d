"""Every registered query against its DuckDB formulation (row count, column
names, order-insensitive value hash with doubles compared bit for bit).

Runs on sf0.001 by default; set ``PROTOCLASS_ORACLE_SF`` to another table
folder (the driver's correctness gate uses sf0.01).
"""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402
from protoclass.plans.oracle import ORACLE_SQL  # noqa: E402
from protoclass.plans.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("PROTOCLASS_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_DIR}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_of_the_reference_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns) == digest(orows, ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "topic", "sim", "zero_overlap", "correct"]
    assert df.count() > 0


def test_report_lines(spark):
    lines = [r["line"] for r in entry.queries()["report_lines"](spark, SF_DIR).orderBy("line_no").collect()]
    assert lines[0] == "Recall\tPrecision\tF-measure\tTopic"
    assert lines[-1].startswith("Overall accuracy: ") and lines[-1].endswith("%")
    body = lines[2:-2]
    assert body and all("\t\t> " in line for line in body)
