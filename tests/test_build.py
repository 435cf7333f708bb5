from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parity import adapter
from tidemark.functions import dates
from tidemark.operators import star
from tidemark.plans import build
from tidemark.sources.raw import RAW_TABLES, read_all_raw, read_raw, typed
from tidemark.sources.store import Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("warehouse"))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("raw"))
    adapter.land(spark, SF, where)
    return read_all_raw(spark, where)


@pytest.fixture(scope="module")
def house(spark, raw, root):
    early = dates.month_start(F.col("source_month")) < F.lit("1998-01-01").cast("date")
    first = {**raw, "listings": raw["listings"].where(early)}
    build.run_build(spark, first, root, datetime(1999, 1, 1), cutoff=adapter.CUTOFF,
                    overrides=(), with_gold=False)
    return build.run_build(spark, raw, root, datetime(2000, 1, 1), cutoff=adapter.CUTOFF)


def test_fact_has_every_listing_row_once(house):
    fact = build.table(house, "gold.fact_listings")
    n = build.table(house, "silver.listings").count()
    assert fact.count() == n == fact.select("listing_row_id").distinct().count()


@pytest.mark.parametrize("name, key", [
    ("silver.host_snapshot", "host_id"), ("silver.listing_snapshot", "listing_id"),
    ("silver.lga_snapshot", "lga_code"), ("silver.suburb_snapshot", "suburb_name")])
def test_versions_do_not_overlap_and_one_is_open(house, name, key):
    snap = build.table(house, name)
    per_key = snap.groupBy(key).agg(
        F.count_if(F.col("valid_to").isNull()).alias("open"),
        F.sort_array(F.collect_list(F.struct("valid_from", "valid_to"))).alias("v")).collect()
    for r in per_key:
        assert r.open == 1
        for a, b in zip(r.v, r.v[1:]):
            assert a.valid_to == b.valid_from


def test_second_build_closed_versions(house):
    hosts = build.table(house, "silver.host_snapshot")
    assert hosts.where("valid_to IS NOT NULL").count() > 0
    assert house.builds == [1, 2]


@pytest.mark.parametrize("dim, fact_key, key", [
    ("gold.dim_host", "host_id", "host_id"), ("gold.dim_listing", "listing_id", "listing_id"),
    ("gold.dim_lga", "listing_lga_code", "lga_code"),
    ("gold.dim_suburb", "host_suburb", "suburb_name")])
def test_every_fact_finds_one_version(house, dim, fact_key, key):
    fact = build.table(house, "gold.fact_listings")
    joined = star.asof_join(fact, build.table(house, dim), F.col(fact_key), key, "scraped_date",
                            {"valid_from": "found"})
    assert joined.count() == joined.where("found IS NOT NULL").count() == fact.count()


def test_quality_suite_passes(house):
    report = build.quality_report(house).collect()
    assert len(report) == 37
    assert [r for r in report if not r.passed] == []


def test_an_unfinished_build_stays_invisible(spark, house, root):
    before = build.table(house, "silver.host").count()
    house.write("silver.host", 3, spark.range(1))
    house.write_snapshot("silver.host_snapshot", 3,
                         build.table(house, "silver.host_snapshot").limit(1))
    again = Warehouse(spark, root)
    assert again.builds == [1, 2] and again.next_build() == 3
    assert build.table(again, "silver.host").count() == before
    snaps = [build.table(w, "silver.host_snapshot").count() for w in (house, again)]
    assert snaps[0] == snaps[1]


def test_an_earlier_build_can_be_opened(spark, house, root):
    first = Warehouse(spark, root, build=1)
    assert first.builds == [1]
    assert build.table(first, "silver.host_snapshot").where("valid_to IS NOT NULL").count() == 0


def test_regrouped_months_give_the_same_fact(spark, raw, house, tmp_path):
    mixed = {**raw, "listings": raw["listings"].repartition(4)}
    other = build.run_build(spark, mixed, str(tmp_path), datetime(2000, 1, 1),
                            cutoff=adapter.CUTOFF)
    columns = ["listing_row_id", "listing_month", "scraped_date", "is_active", "price"]
    a, b = (build.table(w, "gold.fact_listings").select(*columns) for w in (house, other))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()
    files = build.table(other, "gold.fact_listings").select(
        F.input_file_name().alias("f")).distinct().count()
    months = a.select("listing_month").distinct().count()
    assert files <= months + 8


def test_a_month_filter_reads_only_its_directory(house):
    fact = build.table(house, "gold.fact_listings")
    day = F.lit("1996-03-01").cast("date")
    one = fact.where(F.col("listing_month") == day)
    assert {f.split("listing_month=")[1][:10] for f in one.inputFiles()} \
        >= {"1996-03-01"}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(listing_month" in plan


def test_views(spark, house):
    names = build.register_views(house, "t_")
    assert len(names) == 27
    n = spark.sql("SELECT count(*) FROM t_mart_host_neighbourhood m JOIN t_gold_dim_lga l "
                  "ON l.lga_name = m.host_neighbourhood_lga").first()[0]
    assert n > 0


def test_empty_folder_has_no_tables(spark, tmp_path):
    with pytest.raises(LookupError):
        Warehouse(spark, str(tmp_path)).table("silver.host")


def test_month_comes_from_the_file_name_when_there_is_no_column(spark, tmp_path):
    header = ",".join(n.upper() for n in RAW_TABLES["listings"].names if n != "source_month")
    cells = ["7", "1", "2020-05-11", "3", '" Ann, B "', "1/2/2012", "t", "Bondi", "Waverley",
             "House", "Private room", "2", "120.50", "t", "x", "4"] + [""] * 6
    (tmp_path / "05_2020.csv").write_text(header + ",EXTRA\n" + ",".join(cells) + ",e\n")
    row = read_raw(spark, "listings", str(tmp_path), "csv").first()
    assert (row.source_month, row.listing_id, row.host_name) == ("05_2020", 7, " Ann, B ")
    assert row.availability_30 is None and row.extra == "e" and str(row.price) == "120.50"


def test_missing_raw_column_is_reported(spark):
    with pytest.raises(ValueError, match="lga_name"):
        typed(spark.createDataFrame([("1",)], "lga_code string"), RAW_TABLES["nsw_lga_code"])
