"""What the plans must look like at any size."""

import re

import pytest
from pyspark.sql import functions as F

from downfold.operators import decode, filters, outages, sla, state
from downfold.plans.catalog import QUERIES
from downfold.plans.table_queries import QUERIES as WRITING
from downfold.session import work_folder
from downfold.sources import intervals as tables, testtables
from helpers import intervals

SF_DIR = "/root/testdata/sf0.001"
READING = [name for name in QUERIES if name not in WRITING]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


@pytest.mark.parametrize("name", READING)
def test_no_product_joins_and_no_python(spark, name):
    plan = physical(QUERIES[name].run(spark, SF_DIR))
    for bad in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan, bad


@pytest.mark.parametrize("name", ["downtime_intervals", "downtime_intervals_by_event_time", "latest_node_state"])
def test_hash_aggregates_only(spark, name):
    plan = physical(QUERIES[name].run(spark, SF_DIR))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_fold_reads_only_what_it_needs(spark):
    plan = physical(state.downtime_intervals(testtables.alarms(spark, SF_DIR)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("value" not in s and "props" not in s for s in schemas)


def test_no_exchange_on_the_node_alone_carries_alarms(spark):
    """Rows are shuffled by (node, slice); only one row per slice goes by node."""
    plan = physical(state.downtime_intervals(testtables.alarms(spark, SF_DIR)))
    alone = [keys for keys in exchanges(plan) if "_slice" not in keys]
    assert len(alone) == 1
    assert sum("_slice" in keys for keys in exchanges(plan)) >= 2


def test_single_slice_needs_no_join(spark):
    df = state.downtime_intervals(testtables.alarms(spark, SF_DIR))
    df.collect()
    assert "Join" not in physical(df).split("== Initial Plan ==")[0]


def test_messages_are_parsed_once(spark):
    plan = optimized(decode.accepted_alarms(testtables.cdc_messages(spark, SF_DIR)))
    assert plan.count("from_json") == 1


def test_filters_reach_the_scan(spark):
    path = work_folder(spark, "pushed")
    tables.write_intervals(intervals(spark, [("A", 0, 5), ("B", 90_000, 90_005)]), path)
    df = tables.read_intervals(spark, path)
    ranged = filters.filter_time_range(df, "1970-01-02 00:00:00", "1970-01-02 12:00:00")
    chosen = filters.filter_nodes(ranged, ["B"])
    plan = physical(outages.max_duration(chosen))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", plan).group(1)
    assert "down_at" in pushed and "node_id" in pushed
    assert re.search(r"PartitionFilters: \[[^\]]*down_day", plan)
    assert re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1).count(":") == 3
    assert outages.total_outages(chosen).first()[0] == 1


def test_top_k_does_not_sort_everything(spark):
    df = intervals(spark, [("A", 0, 5)])
    assert "TakeOrderedAndProject" in physical(outages.recent_outages(df))
    assert "TakeOrderedAndProject" in physical(outages.top_nodes_downtime(df))


def test_daily_states_shuffle_partial_sums(spark):
    plan = physical(sla.daily_node_partials(state.downtime_intervals(testtables.alarms(spark, SF_DIR))))
    assert "partial_sum(duration_ms" in plan


def test_hot_node_is_balanced(spark):
    """With one node holding a third of the alarms, no task of the fold gets a third of them."""
    n, parts = 40_000, 16
    third = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 500))
    df = spark.range(n).select(
        "id", third.alias("node_id"), F.lit(1417).alias("trap_id"), F.col("id").alias("event_time")
    )
    sliced = df.withColumn("s", F.expr("id div 256")).repartition(parts, "node_id", "s")
    largest = sliced.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < n / 8
    plain = state.with_previous_state(df, span=None).select("id", "prev")
    assert state.with_previous_state(df, span=256).select("id", "prev").exceptAll(plain).count() == 0
