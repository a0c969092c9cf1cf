"""The registered queries against their SQL twins, and what the SQL check cannot say."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from kerbline.llm.oracles import ORACLES
from kerbline.llm.queries import QUERIES


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(row[i] for i in order) for row in rows], key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    ours = QUERIES[name](spark, sf_dir)
    theirs = con.execute(ORACLES[name])
    columns = [d[0] for d in theirs.description]
    assert _rows(ours.columns, [tuple(r) for r in ours.collect()]) == _rows(columns, theirs.fetchall())


def test_the_operators_and_the_pipeline_are_registered():
    found = entry.queries()
    assert "pipeline" in found
    numbers = sorted(int(m[1]) for m in (re.match(r"op(\d+)_", n) for n in found) if m)
    assert numbers == list(range(1, 14))
    assert set(entry.oracle_sql()) <= set(found)
