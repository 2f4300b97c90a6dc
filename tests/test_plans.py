"""The physical plans are the ones intended."""

import re

import pytest
from pyspark.sql import functions as F

from snapledger.catalog import ORACLES, QUERIES
from snapledger.catalog.quality import LINE_RULES
from snapledger.operators import dedup_first, latest_one
from snapledger.quality import evaluate
from snapledger.quality.rules import UNIQUE

FOLDER = "/root/testdata/sf0.001"
# These run whole batches or streams before they return; their plans only read the result.
EAGER = {n for n in QUERIES if n.startswith(("medallion", "stream"))}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(QUERIES[name](spark, FOLDER)) for name in QUERIES if name not in EAGER}


def test_no_python_and_no_cross_joins(plans):
    for name, text in plans.items():
        assert not re.search(r"Python|ArrowEval|Pandas", text), name
        assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text), name


def test_every_query_reads_the_tables(spark):
    for name, build in QUERIES.items():
        if name not in EAGER:
            assert build(spark, FOLDER).inputFiles(), name


def scans(text):
    return re.findall(r"ReadSchema: struct<(.*?)>\n", text + "\n")


def test_current_state_shuffles_only_the_maxima(plans):
    text = plans["latest_snapshot"]
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_max" in text and "SortMergeJoin" not in text
    assert "l_partkey:bigint,l_shipdate:timestamp_ntz" in scans(text)
    assert all("l_extendedprice" not in s for s in scans(text))


def test_profile_aggregates_before_the_join(plans):
    text = plans["hourly_ratio"]
    assert text.index("BroadcastHashJoin") < text.index("HashAggregate")
    assert text.count("Exchange hashpartitioning") == 1
    assert scans(text)[0] == "l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz"


def test_row_number_limits_groups_before_the_shuffle(spark):
    df = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    for chosen in (latest_one(df, ["l_partkey"], [F.desc("l_shipdate")]),
                   dedup_first(df, ["l_partkey"], [F.asc("l_shipdate")])):
        text = plan(chosen)
        before = text[text.index("Exchange"):]
        assert "WindowGroupLimit" in before and "Partial" in before


def test_a_suite_scans_once_plus_once_per_unique_rule(spark):
    df = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    without = [r for r in LINE_RULES if r.kind != UNIQUE]
    text = plan(evaluate(df, without))
    assert text.count("FileScan") == 1
    assert scans(text)[0] == \
        "l_partkey:bigint,l_quantity:double,l_tax:double,l_returnflag:string"
    assert "hashpartitioning" not in text
    assert plan(evaluate(df, LINE_RULES)).count("FileScan") == 2


def test_top_k_does_not_sort_everything(plans):
    for name in ("recent_runs", "orphans"):
        assert "TakeOrderedAndProject" in plans[name], name
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in \
        plans["recent_runs"]


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
