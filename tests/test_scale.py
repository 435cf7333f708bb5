"""What the figures at size rest on: unsorted monthly writes, narrow shuffles, single tables."""

import re

import pyarrow.parquet as pq

from parity import adapter, queries
from tidemark.operators import geography
from tidemark.plans import build, marts
from tidemark.sources import store

SF = "/root/testdata/sf0.001"


def plans(spark):
    """Physical plans of the statements that ran, oldest first."""
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]


def test_monthly_writes_neither_sort_rows_nor_keep_the_setting(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "FILE_ROWS", 40)
    before = spark.conf.get(store._WRITERS)
    rows = spark.range(300).selectExpr("id", "concat('0', cast(id % 3 + 1 as string), '_1995') as month").coalesce(1)
    store.write_by_month(rows, str(tmp_path / "t"), "month")
    assert "Sort" not in plans(spark)[-1]
    assert spark.conf.get(store._WRITERS) == before
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "t").glob("*/*.parquet")]
    assert max(f.num_rows for f in files) <= 40 and sum(f.num_rows for f in files) == 300
    assert {f.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_months_beyond_the_open_files_are_written_too(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(store, "OPEN_MONTHS", 2)
    given = spark.range(200).selectExpr("id", "cast(id % 7 as int) as month").coalesce(1)
    store.write_by_month(given, str(tmp_path / "t"), "month")
    assert rows(spark.read.parquet(str(tmp_path / "t")), "id", "month") == rows(given)


def test_landing_moves_only_what_the_columns_are_made_from(spark):
    plan = adapter.listings(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    above, _, below = plan.partition("RebalancePartitions")
    assert below and "scrape_id" in above and "scrape_id" not in below


def test_a_query_lands_its_own_table_alone(spark, monkeypatch):
    read, whole = [], adapter.given
    monkeypatch.setattr(adapter, "given", lambda s, d, name: read.append(name) or whole(s, d, name))
    monkeypatch.setattr(queries, "_landed", {})
    monkeypatch.setattr(queries, "_roots", {})
    got = queries.QUERIES["census_g02"](spark, SF)
    assert set(read) == {"customer", "nation", "region"}
    want = geography.clean_census(adapter.census(spark, SF, "census_g02"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_builds_of_landed_months_shuffle_no_listing_rows(spark, monkeypatch):
    """The landed listings lie in monthly directories."""
    asked = []
    monkeypatch.setattr(queries, "_houses", {})
    monkeypatch.setattr(build, "run_build", lambda *_, **how: asked.append(how.get("regroup_months", True)))
    queries.house(spark, SF)
    assert asked == [False, False]


def test_mart_rows_meet_in_one_shuffle_with_a_part_per_file(spark, tmp_path):
    fact = (spark.range(400).selectExpr(
        "cast(id % 5 as int) as host_id", "cast(id % 3 as string) as kind", "date'2020-01-01' as scraped_date",
        "date'2020-01-01' as month_year", "1 as is_active", "cast(id as decimal(12,2)) as price",
        "3 as availability_30", "id as review_scores_rating").repartition(7))
    fact.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    hosts = spark.sql("select 1 as host_id, true as host_is_superhost, timestamp_ntz'1900-01-01' as valid_from, "
                      "cast(null as timestamp_ntz) as valid_to")
    mart = marts.listing_metrics(fact, hosts, ["kind"])
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert f"hashpartitioning(kind, month_year, host_id, {len(fact.inputFiles())})" in re.sub(r"#\d+", "", plan)
    got = {r.kind: (r.distinct_hosts, r.superhost_rate, r.total_stays) for r in mart.collect()}
    assert got == {k: (5, 20, 27 * n) for k, n in (("0", 134), ("1", 133), ("2", 133))}
