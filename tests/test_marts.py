import random
import statistics
from collections import defaultdict
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import measures, star
from tidemark.plans import marts

FOREVER, TURN = datetime(1900, 1, 1), datetime(2020, 3, 10)


def cents(x):
    return None if x is None else Decimal(x).quantize(Decimal("0.01"), ROUND_HALF_UP)


def over(a, b, times=1):
    return None if a is None or not b else cents(Decimal(times) * Decimal(a) / Decimal(b))


@pytest.fixture(scope="module")
def star_tables(spark):
    """Random facts with a host and a listing holding a third of the rows each."""
    rng = random.Random(11)
    facts = []
    for i in range(600):
        host = 1 if rng.random() < 0.34 else rng.randint(0, 12)
        listing = 1 if rng.random() < 0.34 else rng.randint(0, 15)
        month = rng.choice([1, 2, 3, 5])
        facts.append((
            f"r{i}", listing, host, rng.choice(["0", "A", "B", "Z"]),
            rng.choice(["UNKNOWN", "S1", "S2", "S3"]),
            date(2020, month, rng.randint(1, 28)), date(2020, month, 1),
            0 if month == 5 and rng.random() < 0.7 else int(rng.random() < 0.7),
            None if rng.random() < 0.1 else Decimal(rng.randint(0, 9999)) / 100,
            rng.randint(0, 30), None if rng.random() < 0.3 else Decimal(rng.randint(1, 100))))
    fact = spark.createDataFrame(facts, (
        "listing_row_id string, listing_id long, host_id long, listing_lga_code string, "
        "host_suburb string, scraped_date date, listing_month date, is_active int, "
        "price decimal(12,2), availability_30 int, review_scores_rating decimal(5,2)"))

    def versions(spec, data):
        return spark.createDataFrame(data, spec + ", valid_from timestamp_ntz, "
                                                  "valid_to timestamp_ntz")

    hosts = [(h, s, f, t) for h in range(13) for s, f, t in (
        [(None, FOREVER, None)] if h == 0 else
        [(h % 2 == 0, FOREVER, TURN), (h % 3 == 0, TURN, None)])]
    listings = [(x, p, r, a, f, t) for x in range(14) for p, r, a, f, t in (
        [("Unknown", "Unknown", None, FOREVER, None)] if x == 0 else
        [(f"P{x % 2}", None if x == 5 else "R", x % 3, FOREVER, TURN),
         (f"P{x % 3}" if x != 7 else None, "R", None if x == 4 else x % 3, TURN, None)])]
    lgas = [("0", "Unknown", "UNKNOWN", FOREVER, None), ("A", "Alpha", "ALPHA", FOREVER, TURN),
            ("A", "Alpha 2", "ALPHA 2", TURN, None), ("B", "Beta", "BETA", FOREVER, None)]
    suburbs = [("UNKNOWN", "UNKNOWN", FOREVER, None), ("S1", "BETA", FOREVER, TURN),
               ("S1", "ALPHA 2", TURN, None), ("S2", "NOT LISTED", FOREVER, None),
               ("S3", "ALPHA", FOREVER, None)]
    return {
        "facts": facts, "host_rows": hosts, "listing_rows": listings, "lga_rows": lgas,
        "suburb_rows": suburbs, "fact": fact,
        "hosts": versions("host_id long, host_is_superhost boolean", hosts),
        "listings": versions("listing_id long, property_type string, room_type string, "
                             "accommodates int", listings),
        "lgas": versions("lga_code string, lga_name string, lga_name_upper string", lgas),
        "suburbs": versions("suburb_name string, lga_name string", suburbs),
    }


def at(table, key, day, position=0):
    """The version row of ``key`` on ``day``, by brute force."""
    when = datetime(day.year, day.month, day.day)
    return next((v for v in table if v[position] == key and v[-2] <= when
                 and (v[-1] is None or when < v[-1])), None)


def listing_mart_by_hand(t, group_of):
    groups = defaultdict(list)
    for f in t["facts"]:
        host = at(t["host_rows"], f[2], f[5])
        groups[(*group_of(f), f[6])].append((f, bool(host and host[1])))
    counts = {k: (sum(f[7] for f, _ in v), sum(1 - f[7] for f, _ in v))
              for k, v in groups.items()}
    out = []
    for k, v in groups.items():
        act = [f for f, _ in v if f[7] == 1]
        prices = sorted(f[8] for f in act if f[8] is not None)
        scores = [f[10] for f in act if f[10] is not None]
        hosts, supers = {f[2] for f, _ in v}, {f[2] for f, s in v if s}
        money = [(30 - f[9]) * f[8] for f in act if f[8] is not None]
        month = k[-1]
        before = counts.get((*k[:-1], date(2020, month.month - 1, 1))) if month.month > 1 else None
        pct = [over(now - old, old, 100) if before else None
               for now, old in zip(counts[k], before or (0, 0))]
        out.append((*k, over(len(act), len(v), 100),
                    prices[0] if prices else None, prices[-1] if prices else None,
                    cents(statistics.median(prices)) if prices else None,
                    over(sum(prices), len(prices)) if prices else None, len(hosts),
                    over(len(supers), len(hosts), 100),
                    over(sum(scores), len(scores)) if scores else None,
                    *pct, sum(30 - f[9] for f in act),
                    over(sum(money), len(act)) if money else None))
    return sorted(out, key=lambda r: [str(x) for x in r])


@pytest.fixture(params=["10MB", "-1"], ids=["broadcast", "shuffled"])
def threshold(spark, request):
    """Every mart is checked with dimensions that Spark broadcasts and with none."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.set(name, before)


def test_listing_neighbourhood(star_tables, rows, threshold):
    t = star_tables

    def group(f):
        lga = at(t["lga_rows"], f[3], f[5])
        return (lga[1] if lga else "Unknown",)

    got = marts.listing_neighbourhood(t["fact"], t["lgas"], t["hosts"])
    assert rows(got) == listing_mart_by_hand(t, group)


def test_property_type(star_tables, rows, threshold):
    t = star_tables

    def group(f):
        v = at(t["listing_rows"], f[1], f[5])
        return ("Unknown", "Unknown", None) if v is None else (
            v[1] or "Unknown", v[2] or "Unknown", v[3])

    got = marts.property_type(t["fact"], t["listings"], t["hosts"])
    assert rows(got) == listing_mart_by_hand(t, group)


def test_host_neighbourhood(star_tables, rows, threshold):
    t = star_tables
    groups = defaultdict(list)
    for f in t["facts"]:
        suburb = at(t["suburb_rows"], f[4], f[5])
        lga = suburb and at(t["lga_rows"], suburb[1], f[5], 2)
        groups[(lga[1] if lga else "Unknown", f[6])].append(f)
    want = []
    for k, v in groups.items():
        money = [(30 - f[9]) * f[8] for f in v if f[7] == 1 and f[8] is not None]
        total = sum(money) if money else None
        hosts = len({f[2] for f in v})
        want.append((*k, hosts, over(total, sum(f[7] for f in v)), over(total, hosts), total))
    got = marts.host_neighbourhood(t["fact"], t["suburbs"], t["lgas"])
    assert rows(got) == sorted(want, key=lambda r: [str(x) for x in r])


def test_unmatched_host_suburb_is_unknown(star_tables):
    got = marts.host_neighbourhood(star_tables["fact"], star_tables["suburbs"],
                                   star_tables["lgas"])
    names = {r[0] for r in got.select("host_neighbourhood_lga").collect()}
    assert names == {"Unknown", "Alpha", "Alpha 2", "Beta"}


def test_presentation_order_puts_null_last(star_tables):
    t = star_tables
    mart = marts.property_type(t["fact"], t["listings"], t["hosts"])
    shown = [tuple(r)[:4] for r in marts.presented(mart, "property_type").collect()]
    assert shown == sorted(shown, key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0, r[3]))


@pytest.mark.parametrize("values", [
    ["1.00"], ["1.00", "2.01"], ["3.00", "1.00", "2.00"], ["5.00", "5.00", "5.00", "9.99"],
    ["0.01", "0.02"], ["1.00", None, "4.00"],
])
def test_exact_median(spark, values):
    df = spark.createDataFrame([("g", None if v is None else Decimal(v)) for v in values],
                               "g string, v decimal(12,2)")
    got = measures.exact_median(df, ["g"], "v", "m").first().m
    assert got == cents(statistics.median([Decimal(v) for v in values if v is not None]))


def test_mom_change(spark, rows):
    df = spark.createDataFrame(
        [("a", date(2020, 1, 1), 4), ("a", date(2020, 2, 1), 6), ("a", date(2020, 4, 1), 3),
         ("a", date(2020, 5, 1), 0), ("a", date(2020, 6, 1), 5), ("b", date(2020, 2, 1), 1)],
        "g string, m date, n long")
    got = measures.mom_change(df, ["g"], "m", {"n": "pct"})
    assert rows(got, "g", "m", "pct") == [
        ("a", date(2020, 1, 1), None), ("a", date(2020, 2, 1), Decimal("50.00")),
        ("a", date(2020, 4, 1), None), ("a", date(2020, 5, 1), Decimal("-100.00")),
        ("a", date(2020, 6, 1), None), ("b", date(2020, 2, 1), None)]


def test_group_without_active_rows(spark, star_tables):
    fact = star_tables["fact"].withColumn("is_active", F.lit(0))
    got = marts.listing_neighbourhood(fact, star_tables["lgas"], star_tables["hosts"]).first()
    assert got.total_stays == 0 and got.median_price is None
    assert got.avg_estimated_revenue_per_active_listing is None
    assert got.active_listings_rate == Decimal("0.00")


def test_exact_median_brackets_many_values(spark):
    """Several groups, null keys, negative and wide-spread values; one group is most of the rows."""
    rng = random.Random(3)
    rows = [(g, Decimal(rng.randint(-10**rng.randint(1, 11), 10**rng.randint(1, 11))).scaleb(-2))
            for g in ["a"] * 3000 + ["b", "b", "c", None, None, None] * 20]
    df = spark.createDataFrame(rows, "g string, v decimal(12,2)")
    got = {r.g: r.m for r in measures.exact_median(df, ["g"], "v", "m").collect()}
    for g in ("a", "b", "c", None):
        assert got[g] == cents(statistics.median([v for k, v in rows if k == g]))


@pytest.mark.parametrize("value", ["0.00", "9.99", "10.00", "999.99", "1000.00", "-12.34", "9999999999.99"])
def test_leading_digits_never_fall(spark, value):
    around = sorted(Decimal(value) + Decimal(d).scaleb(-2) for d in range(-30, 31))
    around = [v for v in around if abs(v) < 10**10]
    df = spark.createDataFrame([(v,) for v in around], "v decimal(12,2)")
    out = df.orderBy("v").select(measures.leading_digits(F.col("v"), df.schema["v"].dataType).alias("b")).collect()
    assert [r.b for r in out] == sorted(r.b for r in out)
    assert all(len(str(abs(r.b)).rstrip("0")) <= 3 for r in out)
