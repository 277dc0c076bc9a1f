"""Streaming scoring with fitted codes, and physical-plan checks."""

import os
import tempfile

import pytest

from __spark_entry__ import oracle_sql, queries
from stackyard.plans import q_exact
from tests.conftest import SF_SMALL


def test_stream_scoring_matches_batch(spark):
    from stackyard.operators.encode import fit_first_seen
    from stackyard.sources import fixtures as fx
    from stackyard.streaming.scoring import encoded_events_stream, score_stream
    ev = fx.events(spark, SF_SMALL).select("id", "event_type", "value")
    codes = fit_first_seen(ev, "event_type")
    stream = encoded_events_stream(spark, SF_SMALL, [codes])
    root = tempfile.mkdtemp(prefix="stackyard-stream-")
    q = score_stream(stream, os.path.join(root, "out"), os.path.join(root, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(root, "out"))
    want = codes.transform(ev)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


MODELS = [n for n in oracle_sql() if n in q_exact.QUERIES and n[0] in "tkxsbl" or n.startswith("op")]


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - set(MODELS)))
def test_sql_operators_stay_in_the_jvm(spark, name):
    plan = _plan(queries()[name](spark, SF_SMALL))
    assert not any(n in plan for n in PY_NODES), name


def test_stats_join_is_broadcast(spark):
    plan = _plan(queries()["j1_stats_join"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_filters_and_columns_reach_the_scan(spark):
    df = queries()["p7_null_filter"](spark, SF_SMALL)
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in txt
    scan = queries()["s3_projected_scan"](spark, SF_SMALL)
    st = scan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in st
