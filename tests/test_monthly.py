"""Builds of single months against builds of everything, and builds at the same time."""

import random
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parity import adapter
from tests.test_history import SCHEMA, host_row
from tidemark.functions import dates
from tidemark.operators import history
from tidemark.plans import build, views
from tidemark.sources import store
from tidemark.sources.raw import read_all_raw
from tidemark.sources.store import ConcurrentBuild, Scratch, Warehouse

SF = "/root/testdata/sf0.001"


def listings(spark, seed, months):
    """Random hosts over months: gaps, skipped months, values that come back, hosts that start or
    stay empty, several rows a month."""
    rng = random.Random(seed)
    rows = []
    for host in range(40):
        for m in range(months):
            for _ in range(rng.choice([0, 1, 1, 2])):
                empty = host % 7 == 0 and (host % 2 or m < months // 2) or rng.random() < 0.2
                r = list(host_row(host, 1, None if empty else rng.choice("AAAB"), day=rng.randint(1, 28),
                                  listing=rng.randint(1, 9), suburb=rng.choice("XY")))
                r[2] = date(2018 + m // 12, 1 + m % 12, 1)
                r[3] = r[2].replace(day=rng.randint(1, 28))
                rows.append(tuple(r))
    return spark.createDataFrame(rows, SCHEMA)


def whole_state(df, of):
    """The summary from the batch operators."""
    versions = history.number_versions(history.monthly_collapse(
        df, of.key, of.month, of.date, of.order, of.attributes, of.empty), of.key, of.month, of.attributes)
    n = versions.groupBy(of.key).agg(F.max("version_no").cast("long").alias("versions"))
    return history.latest_version(versions, of.key, of.month, of.attributes).join(n, of.key)


@pytest.mark.parametrize("make, months", [(history.host_entity, 36), (history.listing_entity, 12)])
def test_months_one_by_one_equal_the_batch(spark, rows, make, months):
    of = make()
    df = Scratch(spark, "months")(listings(spark, 5, months), "rows")
    scratch, state = Scratch(spark, "states"), None
    for m in range(months):
        month = df.where(F.col("listing_month") == F.lit(date(2018 + m // 12, 1 + m % 12, 1)))
        new = history.summary(month, of)
        state = scratch(new if state is None else history.merged(state, new, of), f"m{m}")
    got = history.latest(state, of).join(state.select(of.key, "versions"), of.key)
    want = whole_state(df, of)
    assert rows(got, *sorted(got.columns)) == rows(want, *sorted(got.columns))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_summaries_merge_in_any_grouping(spark, rows, seed):
    of = history.host_entity()
    df = listings(spark, seed, 9).cache()
    cuts = sorted(random.Random(seed).sample(range(1, 9), 2))
    bounds = [date(2018, 1 + c, 1) for c in cuts]
    month = F.col("listing_month")
    a, b, c = (history.summary(df.where(w), of) for w in (
        month < bounds[0], (month >= bounds[0]) & (month < bounds[1]), month >= bounds[1]))
    left = history.merged(history.merged(a, b, of), c, of)
    right = history.merged(a, history.merged(b, c, of), of)
    whole = history.summary(df, of)
    columns = sorted(whole.columns)
    assert rows(left, *columns) == rows(right, *columns) == rows(whole, *columns)


@pytest.mark.parametrize("make, windows", [(history.host_entity, 3), (history.listing_entity, 2)])
def test_summary_walks_the_months_of_a_key_no_more_than_it_must(spark, rows, make, windows):
    """Version numbers take two windows and gaps one; the last version is found while grouping."""
    of = make()
    undated = [list(r) for r in listings(spark, 6, 6).collect()]
    for i, r in enumerate(undated):
        r[2] = None if i % 5 == 0 else r[2]
        r[3] = None if i % 3 == 0 else date(1905, 1, 1 + i % 28) if i % 4 == 0 else r[3]
    df = spark.createDataFrame(undated, SCHEMA)
    got = history.summary(df, of)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == windows
    state = history.latest(got, of).join(got.select(of.key, "versions"), of.key)
    want = whole_state(df, of)
    assert rows(state, *sorted(state.columns)) == rows(want, *sorted(state.columns))


# ---- builds ----


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("raw"))
    adapter.land(spark, SF, where)
    return read_all_raw(spark, where)


def upto(raw, last, months=None):
    month = dates.month_start(F.col("source_month"))
    wanted = month <= F.lit(last) if months is None else month.isin(months)
    return {**raw, "listings": raw["listings"].where(wanted)}


BASE, MONTHS = date(1997, 12, 1), [date(1998, 1, 1), date(1998, 2, 1)]


@pytest.fixture(scope="module")
def houses(spark, raw, tmp_path_factory):
    """The same runs: of everything up to a month, and of the month alone."""
    full, monthly = (str(tmp_path_factory.mktemp(n)) for n in ("full", "monthly"))
    for root in (full, monthly):
        build.run_build(spark, upto(raw, BASE), root, datetime(1998, 1, 1), cutoff=adapter.CUTOFF)
    for i, m in enumerate(MONTHS):
        at = datetime(1998, 2 + i, 1)
        a = build.run_build(spark, upto(raw, m), full, at, cutoff=adapter.CUTOFF)
        b = build.run_build(spark, upto(raw, m, [m]), monthly, at, cutoff=adapter.CUTOFF, months=[m])
    return a, b


NAMES = ["bronze.listings", "silver.listings", "silver.host", "silver.listing_latest", "gold.dim_host",
         "gold.dim_listing", "gold.dim_lga", "gold.dim_suburb", "gold.fact_listings", *build.SNAPSHOTS,
         "mart.host_neighbourhood"]


@pytest.mark.parametrize("name", NAMES)
def test_monthly_builds_give_the_tables_of_full_builds(houses, name):
    a, b = (build.table(h, name) for h in houses)
    columns = sorted(a.columns)
    assert sorted(b.columns) == columns
    a, b = a.select(*columns), b.select(*columns)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def folders(house, table, n):
    return {p.name.partition("=")[2] for p in Path(house.root, table, f"build={n}").iterdir() if "=" in p.name}


def test_a_monthly_build_writes_only_its_month(houses):
    _, house = houses
    n, m = house.builds[-1], MONTHS[-1]
    assert folders(house, "silver.listings", n) == folders(house, "gold.fact_listings", n) == {str(m)}
    assert folders(house, "bronze.listings", n) == {f"{m:%m_%Y}"}
    assert "open" in folders(house, "silver.host_snapshot", house.builds[0])
    assert folders(house, "silver.host_snapshot", n) <= {"opened", "closed"}
    earlier = Warehouse(house.spark, house.root, build=house.builds[1])
    last = earlier.table("silver.listings").agg(F.max("listing_month")).first()[0]
    assert last == MONTHS[0]


def test_the_state_goes_on_from_the_build_before(houses):
    """What a monthly build reads of the stored listings is one month."""
    _, house = houses
    before = build._state_before(Warehouse(house.spark, house.root, build=house.builds[-2]), MONTHS[-1])
    assert (before.build, before.through) == (house.builds[-2], MONTHS[-2])
    later = house.monthly("silver.listings").where(F.col("listing_month") > F.lit(before.through))
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "listing_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    files = later.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("listing_month=")[1][:10] for r in files} == {str(MONTHS[-1])}
    assert build._state_before(house, MONTHS[0]).through == BASE
    assert build._state_before(house, date(1990, 1, 1)) is None


def test_months_can_be_loaded_again(spark, raw, houses, tmp_path):
    """An older month comes a second time with other rows: the state reads the months after it."""
    m = MONTHS[0]
    less = raw["listings"].where((dates.month_start(F.col("source_month")) != F.lit(m)) | (F.col("listing_id") % 3 > 0))
    for p in (upto(raw, MONTHS[-1]), upto({**raw, "listings": less}, MONTHS[-1])):
        a = build.run_build(spark, p, str(tmp_path / "full"), datetime(1999, 1, 1), cutoff=adapter.CUTOFF)
    build.run_build(spark, upto(raw, MONTHS[-1]), str(tmp_path / "monthly"), datetime(1999, 1, 1), cutoff=adapter.CUTOFF)
    b = build.run_build(spark, {**raw, "listings": less}, str(tmp_path / "monthly"), datetime(1999, 1, 1),
                        cutoff=adapter.CUTOFF, months=[m])
    for name in ("silver.listings", "silver.host", "gold.fact_listings", "silver.host_snapshot"):
        x, y = (build.table(h, name) for h in (a, b))
        assert x.exceptAll(y.select(*x.columns)).isEmpty() and x.count() == y.count()
    # Without the older build's state there is nothing to go on from, so all months were read.
    assert build._state_before(b, m) is None


def test_the_second_of_two_writers_fails_and_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    first, second = Warehouse(spark, root), Warehouse(spark, root)
    a, b = first.claim(), second.claim()
    assert a != b
    for house, n in ((first, a), (second, b)):
        house.write("silver.host", n, spark.range(n))
    second.commit(b, datetime(2020, 1, 1))
    with pytest.raises(ConcurrentBuild, match="run this one again"):
        first.commit(a, datetime(2020, 1, 2))
    now = Warehouse(spark, root)
    assert now.builds == [b] and now.table("silver.host").count() == b
    c = now.claim()
    assert c > b
    now.write("silver.host", c, spark.range(9))
    now.commit(c, datetime(2020, 1, 3))
    assert Warehouse(spark, root).builds == [b, c]


def test_a_commit_that_was_broken_off_is_passed_over(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    house.commit(house.claim(), datetime(2020, 1, 1))
    (tmp_path / "commits" / "00000002.json").touch()
    again = Warehouse(spark, str(tmp_path))
    assert again.builds == [1]
    again.commit(again.claim(), datetime(2020, 1, 2))
    assert Warehouse(spark, str(tmp_path)).builds == [1, 2]


def test_snapshot_log_is_compacted(spark, rows, tmp_path, monkeypatch):
    """30 keys, two change per build: a build writes four rows, every fourth all open ones."""
    from tidemark.operators import snapshot

    monkeypatch.setattr(store, "COMPACT_EVERY", 4)
    plain = None
    for n in range(1, 10):
        house = Warehouse(spark, str(tmp_path))
        staged = spark.createDataFrame([(k, f"v{n if k == n else 0}") for k in range(30)], "k long, v string")
        how = {"check_cols": ["v"], "run_ts": datetime(2020, 1, n)}
        whole = house.snapshot_is_whole()
        assert whole == (n % 4 == 1)
        changes = snapshot.snapshot_delta(house.open_versions("s"), staged, "k", changes_only=not whole, **how)
        house.write_snapshot("s", house.claim(), changes, whole)
        house.commit(n, datetime(2020, 1, n), whole=whole)
        plain = Scratch(spark, "plain")(snapshot.snapshot_merge(plain, staged, "k", **how), "p")
        house = Warehouse(spark, str(tmp_path))
        columns = sorted(plain.columns)
        assert rows(house.snapshot("s"), *columns) == rows(plain, *columns)
        written = spark.read.parquet(f"{tmp_path}/s/build={n}").count()
        assert written >= 30 if whole else written == 4
    early = Warehouse(spark, str(tmp_path), build=3)
    assert early.snapshot("s").count() == 30 + 2 + 2


def test_views_last_in_the_catalog(spark, houses):
    """Another session reads what was published: every table, snapshot and mart of a monthly build."""
    _, house = houses
    names = views.publish(house, "tide", "p_")
    assert len(names) == 27
    other = spark.newSession()
    for name in ("bronze.listings", "silver.listings", "silver.host", "gold.fact_listings", "gold.dim_lga",
                 "silver.host_snapshot", "silver.lga_snapshot", "gold.census_g01", *build.MARTS):
        shown = other.table(f"tide.p_{name.replace('.', '_')}").collect()
        held = build.table(house, name)
        assert shown and sorted(map(str, shown)) == sorted(map(str, held.collect()))
    earlier = Warehouse(spark, house.root, build=house.builds[0])
    views.publish(earlier, "tide", "p_")
    n = other.table("tide.p_gold_fact_listings").count()
    assert n == build.table(earlier, "gold.fact_listings").count() < build.table(house, "gold.fact_listings").count()
    for v in names:
        spark.sql(f"DROP VIEW tide.{v}")
    spark.sql("DROP DATABASE tide")
