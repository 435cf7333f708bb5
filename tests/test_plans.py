"""Shapes of the physical plans that matter at scale."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parity.queries import QUERIES, house, silver
from tidemark.operators import history, quality, star
from tidemark.plans import build
from tidemark.plans.rules import MART_RULES
from tidemark.sources.store import Scratch, shared_folder

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.fixture
def static(spark):
    """Plans without adaptive re-planning, so that they can be counted."""
    house(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", [
    "silver_listings", "host_latest", "listing_latest", "scd2_timestamp_two_runs", "asof_join",
    "fact_listings", "mart_listing_neighbourhood", "mart_property_type",
    "mart_host_neighbourhood"])
def test_no_cross_joins_no_single_partition_no_python(static, name):
    text = plan(QUERIES[name](static, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval",
                "Window [" if "SinglePartition" in text else "CartesianProduct"):
        assert bad not in text


def test_cleaning_is_narrow(static):
    assert "Exchange" not in plan(silver(static, SF))


def test_host_history_shuffles_twice(static):
    assert exchanges(plan(history.latest_hosts(silver(static, SF)))) == 2
    assert exchanges(plan(history.host_history(silver(static, SF)))) == 2


def test_listing_history_shuffles_once(static):
    for operator in (history.listing_versions, history.latest_listings, history.listing_history):
        assert exchanges(plan(operator(silver(static, SF)))) == 1


def test_fact_of_a_build_needs_no_shuffle_of_listing_rows(static):
    """A build joins the few absent keys, whatever the size of the listing dimension."""
    h = house(static, SF)
    tables = [build.table(h, f"gold.{t}") for t in ("dim_listing", "dim_host", "dim_lga", "dim_suburb")]
    fact = star.fact_listings(build.table(h, "silver.listings"), *tables,
                              stage=Scratch(static, "absent"))
    text = plan(fact)
    assert "SortMergeJoin" not in text
    assert exchanges(text) == len(re.findall(r"Exchange hashpartitioning\(_member", text)) == 1
    assert fact.count() == build.table(h, "gold.fact_listings").count()


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_marts_and_views_run_no_job_and_write_nothing(spark, threshold):
    """With broadcasts or without: making a mart or a view only builds a plan."""
    h = house(spark, SF)
    for name in build.TABLES:
        h.table(name)  # finds the files; from here on nothing may run
    sc, folder = spark.sparkContext, Path(shared_folder(spark))
    before, files = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), set(folder.rglob("*"))
    group = f"lazy{threshold}"
    sc.setJobGroup(group, group)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in build.MARTS:
            build.table(h, name)
        quality.dq_report({m: build.table(h, m) for m in build.MARTS}, MART_RULES)
        assert not sc.statusTracker().getJobIdsForGroup(group)
        build.register_views(h, f"lazy_{threshold.strip('-')}_")
        assert set(folder.rglob("*")) == files
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_marts_do_not_expand_rows_per_distinct_count(static):
    for name in ("mart_listing_neighbourhood", "mart_property_type", "mart_host_neighbourhood"):
        assert "Expand" not in plan(QUERIES[name](static, SF))


def test_only_needed_columns_are_read(static):
    schemas = re.findall(r"ReadSchema: (\S+)", plan(QUERIES["mart_host_neighbourhood"](static, SF)))
    assert any("host_suburb" in s for s in schemas)
    assert not any("number_of_reviews" in s or "review_scores" in s for s in schemas)


def test_history_sorts_each_exchange_once(static):
    text = plan(history.host_versions(silver(static, SF)))
    # One sort before and one after the first exchange (both for min of a struct), and one
    # after the second, shared by every window.
    assert len(re.findall(r"\bSort \[", text)) == 3


def test_hot_key_is_split_in_the_shuffled_asof_join(spark):
    """A third of the facts on one key: adaptive execution spreads it over several tasks."""
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 300).cast("int"))
        facts = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 997 + 2).alias("k"),
            day.alias("d"), (F.col("id") % 7).alias("g"))
        versions = spark.range(2, 1000).select(
            F.col("id").alias("k"), (F.col("id") % 5).alias("v"),
            F.lit("1900-01-01").cast("timestamp_ntz").alias("valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"))
        got = star.asof_join(facts, versions, F.col("k"), "k", "d", {"v": "v"})
        totals = got.groupBy("g", "v").count()
        assert sum(r["count"] for r in totals.collect()) == 300_000
        assert "skew=true" in plan(totals)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
