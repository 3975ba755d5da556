"""Every registered query (except the ingest round trip, see test_ingest)
against its DuckDB oracle on the smallest driver tables."""

import re

import pytest

from civicflow.plans.oracle import render
from civicflow.plans.registry import load_all
from conftest import same_rows

SPECS = load_all()
NAMES = [n for n, s in SPECS.items() if s.oracle and s.section != "ingest"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(name, tables, duck):
    spec = SPECS[name]
    srows, drows = same_rows(spec(tables), duck.execute(render(spec.oracle)))
    assert srows == drows


def test_every_query_has_an_oracle():
    assert all(s.oracle for s in SPECS.values())


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["thema", "anzahl", "total_eur"]
    found, sql = set(E.queries()), set(E.oracle_sql())
    # Every register query has SQL; what has none is a training-data operator or the pipeline.
    assert set(SPECS) <= sql <= found
    assert all(n == "pipeline" or re.fullmatch(r"op\d+_\w+", n) for n in found - set(SPECS))
