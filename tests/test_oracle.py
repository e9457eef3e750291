"""Every registered query against its DuckDB SQL on the supplied tables."""

import pytest

import __spark_entry__ as E
from logsift.plans import oracle, registry
from tests.oracle_compare import compare, duck

from .conftest import SF_MID, SF_SMALL

# Queries that SQL cannot express have tests of their own.
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


def test_every_log_query_has_sql():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(registry.QUERIES) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_small(spark, con_small, name):
    r = compare(spark, name, SF_SMALL, con_small)
    assert r["ok"], r


@pytest.mark.parametrize("name", ["match_lines", "match_custom", "upsert_logs", "results_rejected", "bulk_lookup"])
def test_query_matches_oracle_mid(spark, name):
    r = compare(spark, name, SF_MID)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["regexId", "log_id", "line_number", "matched_text"]
    assert df.count() > 0
