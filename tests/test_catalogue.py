"""Every catalogue query against its DuckDB oracle at sf0.001 (the driver checks sf0.01)."""

import pytest

from orderpulse.plans.catalogue import ORACLES, QUERIES
from orderpulse.plans.compare import compare

from conftest import SF_SMALL

STREAMING = {"stream_land_merge", "stream_land_merge_full", "stream_raw_refresh", "run_log", "counts_over_time"}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in ORACLES and n not in STREAMING))
def test_query_matches_oracle(spark, duck_small, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), ORACLES[name], duck_small)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(STREAMING))
def test_streaming_query_matches_oracle(spark, duck_small, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), ORACLES[name], duck_small)
    assert ok, msg


def test_every_query_runs(spark):
    for name, fn in QUERIES.items():
        assert fn(spark, SF_SMALL).schema is not None, name


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
