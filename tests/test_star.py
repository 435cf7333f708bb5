import random
import time
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import star

FOREVER = datetime(1900, 1, 1)


def snap(spark, data):
    return spark.createDataFrame(
        data, "lga_code string, lga_name string, lga_name_upper string, "
              "valid_from timestamp_ntz, valid_to timestamp_ntz")


def test_dimension_backdates_first_version_and_adds_unknown(spark, rows):
    t1, t2 = datetime(2020, 5, 1), datetime(2020, 6, 1)
    dim = star.dim_lga(snap(spark, [("1", "A", "A", t1, t2), ("1", "B", "B", t2, None),
                                    ("2", "C", "C", t2, None)]))
    assert rows(dim, "lga_code", "lga_name", "valid_from", "valid_to") == [
        ("0", "Unknown", FOREVER, None), ("1", "A", FOREVER, t2), ("1", "B", t2, None),
        ("2", "C", FOREVER, None)]


def test_unknown_host_has_typed_nulls(spark):
    empty = spark.createDataFrame(
        [], "host_id long, host_name string, host_since date, host_is_superhost boolean, "
            "host_neighbourhood string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    dim = star.dim_host(empty)
    assert dim.dtypes == empty.dtypes
    assert tuple(dim.first()) == (0, "Unknown", None, None, "UNKNOWN", FOREVER, None)


def test_asof_join_bounds(spark, rows):
    versions = spark.createDataFrame(
        [(1, "a", datetime(2020, 1, 1), datetime(2020, 2, 1)),
         (1, "b", datetime(2020, 2, 1), None)],
        "k long, v string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    facts = spark.createDataFrame(
        [(1, date(2019, 12, 31)), (1, date(2020, 1, 1)), (1, date(2020, 1, 31)),
         (1, date(2020, 2, 1)), (1, None), (2, date(2020, 1, 5)), (None, date(2020, 1, 5))],
        "k long, d date")
    got = star.asof_join(facts, versions, F.col("k"), "k", "d", {"v": "found"})
    assert [(str(d), f) for _, d, f in rows(got, "k", "d", "found")] == [
        ("2019-12-31", None), ("2020-01-01", "a"), ("2020-01-31", "a"), ("2020-02-01", "b"),
        ("None", None), ("2020-01-05", None), ("2020-01-05", None)]


@pytest.mark.parametrize("keys, want", [
    ([1, 2, 9, None, 2], [0, 0, 1, 2, 2]),
    ([1, 2, 2], [1, 2, 2]),
    ([None, 1], [0, 1]),
])
@pytest.mark.parametrize("staged", [False, True])
def test_resolve_key_lazy_and_staged(spark, tmp_path, keys, want, staged):
    def stage(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")

    facts = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k long")
    members = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k long")
    got = star.resolve_key(facts, "k", members, 0, stage if staged else None)
    assert sorted(r.k for r in got.collect()) == want
    assert got.columns == ["i", "k"]


def test_fact_falls_back_to_unknown_members(spark, rows):
    scores = ", ".join(f"{c} decimal(5,2)" for c in star.SCORES)
    listings = spark.createDataFrame(
        [("r1", 1, 1, " inner west ", "ENMORE", date(2020, 5, 3), date(2020, 5, 1), True,
          Decimal("10.00"), 3, 4, *[None] * 6),
         ("r2", 7, None, "Nowhere", None, date(2020, 5, 3), date(2020, 5, 1), None,
          None, None, None, *[None] * 6),
         ("r3", 1, 8, None, "OVERSEAS", date(2020, 7, 3), date(2020, 7, 1), False,
          Decimal("5.00"), 30, 0, *[None] * 6)],
        "listing_row_id string, listing_id long, host_id long, listing_neighbourhood string, "
        "host_neighbourhood string, scraped_date date, listing_month date, "
        "has_availability boolean, price decimal(12,2), availability_30 int, "
        f"number_of_reviews int, {scores}")

    def ids(name, *values):
        return spark.createDataFrame([(v,) for v in values], name)

    lga = star.dim_lga(snap(spark, [("14170", "Inner West", "INNER WEST", FOREVER, None)]))
    fact = star.fact_listings(listings, ids("listing_id long", 0, 1), ids("host_id long", 0, 1),
                              lga, ids("suburb_name string", "UNKNOWN", "ENMORE"))
    assert rows(fact, "listing_row_id", "listing_id", "host_id", "listing_lga_code",
                "host_suburb", "is_active") == [
        ("r1", 1, 1, "14170", "ENMORE", 1), ("r2", 0, 0, "0", "UNKNOWN", 0),
        ("r3", 1, 0, "0", "UNKNOWN", 0)]


CARRIED = "k long, v string, valid_from timestamp_ntz, valid_to timestamp_ntz"


def test_asof_carry_equals_the_join(spark, rows):
    """Gaps, versions of no length, keys without versions, null keys and dates, hot keys, clashing names."""
    rng = random.Random(4)
    versions = []
    for k in range(8):
        at = datetime(2020, 1, 1) + timedelta(days=rng.randint(0, 5))
        for i in range(rng.randint(0, 9)):
            end = at + timedelta(days=rng.choice([0, 1, 3, 20]))
            versions.append((k, f"{k}-{i}", at, None if i == 8 else end))
            at = end + timedelta(days=rng.choice([0, 0, 2]))
    versions = spark.createDataFrame(versions, CARRIED)
    facts = spark.createDataFrame(
        [(rng.choice([0, 0, 0, 1, 2, 5, 7, 11, None]), i,
          None if i % 50 == 0 else date(2020, 1, 1) + timedelta(days=rng.randint(-3, 60)), "x")
         for i in range(900)], "k long, _part long, d date, v string")
    carry = {"v": "found", "valid_from": "since"}
    want = rows(star.asof_join(facts, versions, F.col("k"), "k", "d", carry))
    assert sum(r[4] is not None for r in want) > 100
    hot = star.hot_keys(facts, F.col("k"), 50)
    assert {r._hot: r._parts for r in hot.collect()}[0] > 3
    for h in (None, hot):
        got = star.asof_carry(facts, versions, F.col("k"), "k", "d", carry, h)
        assert got.columns == [*facts.columns, "found", "since"]
        assert rows(got) == want


def test_asof_carry_is_linear_in_the_versions_of_a_key(spark):
    """One key with 10,000 versions and 400,000 facts: the join would test 4 billion pairs."""
    day = lambda n: F.date_add(F.lit("2000-01-01").cast("date"), n).cast("timestamp_ntz")
    i = F.col("id").cast("int")
    versions = spark.range(10_000).select(
        F.lit(1).cast("long").alias("k"), F.col("id").cast("string").alias("v"),
        day(i).alias("valid_from"), day(i + 1).alias("valid_to"))
    facts = spark.range(0, 400_000, 1, 4).select(
        F.lit(1).cast("long").alias("k"), "id",
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 10_000).cast("int")).alias("d"))
    hot = star.hot_keys(facts, F.col("k"), 100_000)
    start = time.time()
    got = star.asof_carry(facts, versions, F.col("k"), "k", "d", {"v": "found"}, hot)
    right = got.agg(F.count_if(F.col("found") == (F.col("id") % 10_000).cast("string")).alias("n"),
                    F.count(F.lit(1)).alias("all")).first()
    assert (right.n, right["all"]) == (400_000, 400_000)
    assert time.time() - start < 60
