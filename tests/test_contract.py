"""Driver contract: entry smoke, key coverage, every key against its SQL twin
(sf0.001 here; the driver checks sf0.01)."""

import os

import pytest

import __spark_entry__ as E
import tools_compare as TC
from tripwire.plans import batch_queries
from tripwire.streaming.catalog import stream_queries

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["merchant_category", "fraud_count", "total_amount", "avg_amount",
                          "max_amount", "unique_users"]


def test_every_key_has_sql_twin():
    own = {*batch_queries(), *stream_queries()}
    assert own <= set(E.queries())
    assert own <= set(E.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_all_keys_match_sql(spark):
    failures = TC.compare(spark, SF, [*batch_queries(), *stream_queries()])
    assert failures == []
