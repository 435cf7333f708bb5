import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history, snapshot

SCHEMA = ("listing_id long, host_id long, listing_month date, scraped_date date, "
          "host_name string, host_since date, host_is_superhost boolean, "
          "host_neighbourhood string, property_type string, room_type string, "
          "accommodates int, listing_neighbourhood string")


def host_row(host, month, name, day=5, listing=1, suburb="X", superhost=True):
    """A row of month 2020-<month>; name None makes it a scrape gap."""
    filled = name is not None
    return (listing, host, date(2020, month, 1), date(2020, month, day), name,
            date(2012, 1, 1) if filled else None, superhost if filled else None, suburb,
            "House", "Private room", 2, "Sydney")


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_gap_rows_give_dates_but_no_values(spark, rows):
    df = frame(spark, [
        host_row(1, 1, None, day=2), host_row(1, 1, "Ann", day=9, listing=2),
        host_row(1, 2, None),                      # only gaps: the month disappears
        host_row(1, 3, "Ann"),
    ])
    got = rows(history.host_versions(df), "listing_month", "first_date", "host_name",
               "is_change", "version_no")
    assert got == [(date(2020, 1, 1), date(2020, 1, 2), "Ann", 1, 1),
                   (date(2020, 3, 1), date(2020, 3, 5), "Ann", 0, 1)]


def test_always_empty_host_is_kept(spark, rows):
    df = frame(spark, [host_row(1, 1, None), host_row(1, 2, None, suburb="Y"),
                       host_row(None, 1, "Nobody")])
    got = rows(history.latest_hosts(df), "host_id", "host_name", "host_neighbourhood",
               "listing_month", "updated_at")
    assert got == [(1, None, "Y", date(2020, 2, 1), date(2020, 2, 5))]


def test_returning_values_are_a_new_version_and_skipped_months_are_none(spark, rows):
    df = frame(spark, [host_row(1, 1, "A"), host_row(1, 2, "B"), host_row(1, 5, "A"),
                       host_row(1, 9, "A")])
    assert [r[1] for r in rows(history.host_versions(df), "listing_month", "version_no")] \
        == [1, 2, 3, 3]
    assert rows(history.latest_hosts(df), "host_name", "listing_month", "updated_at") \
        == [("A", date(2020, 9, 1), date(2020, 5, 5))]
    assert rows(history.host_history(df), "host_name", "valid_from", "valid_to") == [
        ("A", datetime(2020, 1, 5), datetime(2020, 2, 5)), ("A", datetime(2020, 5, 5), None),
        ("B", datetime(2020, 2, 5), datetime(2020, 5, 5))]


def test_first_row_of_the_month_wins(spark, rows):
    df = frame(spark, [
        host_row(1, 1, "late", day=9, listing=1), host_row(1, 1, "third", day=3, listing=7),
        host_row(1, 1, "first", day=3, listing=5)])
    assert rows(history.host_monthly(df), "host_name", "first_date") \
        == [("first", date(2020, 1, 3))]


def test_null_attribute_change_is_a_change(spark, rows):
    df = frame(spark, [host_row(1, 1, "A", suburb=None), host_row(1, 2, "A", suburb=None),
                       host_row(1, 3, "A", suburb="X"), host_row(1, 4, "A", suburb=None)])
    assert [r[1] for r in rows(history.host_versions(df), "listing_month", "version_no")] \
        == [1, 1, 2, 3]


def test_listings_ignore_gaps_and_null_ids(spark, rows):
    df = frame(spark, [host_row(1, 1, None, listing=4), host_row(1, 2, None, listing=4),
                       host_row(1, 1, None, listing=None)])
    assert rows(history.latest_listings(df), "listing_id", "listing_month", "updated_at") \
        == [(4, date(2020, 2, 1), date(2020, 1, 5))]


# ---- snapshots ----------------------------------------------------------------------


def staged(spark, data):
    return spark.createDataFrame(data, "k long, name string, updated_at date")


def merge(previous, stage):
    return snapshot.snapshot_merge(previous, stage, "k", updated_at="updated_at")


def test_timestamp_strategy(spark, rows):
    first = merge(None, staged(spark, [
        (1, "same", date(2020, 1, 1)), (2, "old", date(2020, 1, 1)),
        (3, "gone", date(2020, 1, 1)), (4, "older", date(2020, 1, 5))]))
    second = merge(first, staged(spark, [
        (1, "same", date(2020, 1, 1)), (2, "new", date(2020, 2, 1)),
        (4, "ignored", date(2020, 1, 4)), (5, "born", date(2020, 2, 1))]))
    jan, feb = datetime(2020, 1, 1), datetime(2020, 2, 1)
    assert rows(second, "k", "name", "valid_from", "valid_to") == [
        (1, "same", jan, None), (2, "new", feb, None), (2, "old", jan, feb),
        (3, "gone", jan, None), (4, "older", datetime(2020, 1, 5), None),
        (5, "born", feb, None)]
    assert second.select("scd_id").distinct().count() == 6
    # A rerun on the same stage changes nothing.
    again = merge(second, staged(spark, [(2, "new", date(2020, 2, 1))]))
    assert rows(again) == rows(second)


def test_check_strategy_compares_nulls_and_only_the_named_columns(spark, rows):
    def stage(data):
        return spark.createDataFrame(data, "k string, name string, other string")

    def run(prev, data, ts):
        return snapshot.snapshot_merge(prev, stage(data), "k", check_cols=["name"], run_ts=ts)

    t1, t2 = datetime(2020, 1, 1, 8), datetime(2020, 2, 1, 9, 30)
    one = run(None, [("a", "x", "1"), ("b", None, "1"), ("c", "x", "1"), ("d", None, "1")], t1)
    two = run(one, [("a", "x", "2"), ("b", "y", "2"), ("c", None, "2"), ("d", None, "2")], t2)
    assert rows(two, "k", "name", "other", "valid_from", "valid_to") == [
        ("a", "x", "1", t1, None), ("b", None, "1", t1, t2), ("b", "y", "2", t2, None),
        ("c", None, "2", t2, None), ("c", "x", "1", t1, t2), ("d", None, "1", t1, None)]


def test_snapshot_arguments_are_checked(spark):
    df = staged(spark, [(1, "a", date(2020, 1, 1))])
    with pytest.raises(ValueError):
        snapshot.snapshot_merge(None, df, "k")
    with pytest.raises(ValueError):
        snapshot.snapshot_merge(None, df, "k", check_cols=["name"])


def _replay(spark, df, months):
    held = None
    for m in months:
        stage = history.latest_hosts(df.where(F.col("listing_month") <= F.lit(m)))
        held = snapshot.snapshot_merge(held, stage.drop("listing_month"), "host_id",
                                       updated_at="updated_at")
        held = spark.createDataFrame(held.collect(), held.schema)  # small: keeps plans short
    return held


def test_batch_history_equals_monthly_replay(spark, rows):
    rng = random.Random(3)
    data = [host_row(h, m, rng.choice("AB"), day=rng.randint(1, 28), listing=rng.randint(1, 9),
                     suburb=rng.choice([None, "X"]))
            for h in range(1, 13) for m in range(1, 6) for _ in range(2) if rng.random() < 0.8]
    data += [host_row(h, m, None, day=1) for h in (1, 2) for m in (2, 4)
             if any(r[1] == h and r[2].month < m for r in data)]
    df = frame(spark, data)
    columns = ["host_id", *history.HOST_ATTRIBUTES, "valid_from", "valid_to"]
    replayed = _replay(spark, df, [date(2020, m, 1) for m in range(1, 6)])
    assert rows(replayed, *columns) == rows(history.host_history(df), *columns)


def test_replay_keeps_the_empty_start_that_batch_history_drops(spark, rows):
    df = frame(spark, [host_row(1, 1, None), host_row(1, 2, "Ann")])
    replayed = _replay(spark, df, [date(2020, 1, 1), date(2020, 2, 1)])
    assert [r[0] for r in rows(replayed, "host_name")] == ["Ann", None]
    assert [r[0] for r in rows(history.host_history(df), "host_name")] == ["Ann"]
