import hashlib
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, keys, numbers, text
from tidemark.operators.listings import unreadable_dates

OLD, NEW = date(2020, 5, 11), date(2020, 8, 1)


@pytest.mark.parametrize("kind, room, seen, want", [
    ("Hotel", "Entire home/apt", OLD, "Room in hotel"),
    ("Boutique hotel", "Private room", OLD, "Room in boutique hotel"),
    ("Aparthotel", None, OLD, "Room in aparthotel"),
    ("Boat", "Entire home/apt", OLD, "Boat"),
    ("Tiny house", "Entire home/apt", OLD, "Tiny house"),
    ("Other", "Entire home/apt", OLD, "Entire place"),
    ("Casa particular (Cuba)", "Entire home/apt", OLD, "Casa particular"),
    ("Loft", "Entire home/apt", OLD, "Entire loft"),
    (None, "Entire home/apt", OLD, None),
    ("Other", "Private room", OLD, "Private room"),
    ("Other", "Lounge", OLD, "Lounge"),
    ("Other", None, OLD, None),
    ("Boat", "Private room", OLD, "Private room in boat"),
    ("House", "Shared room", OLD, "Shared room in house"),
    ("House", "Hotel room", OLD, "Room in house"),
    (None, "Hotel room", OLD, None),
    ("House", "Lounge", OLD, "House"),
    ("House", None, OLD, "House"),
    ("Hotel", "Private room", NEW, "Hotel"),
    ("Entire house", "Entire home/apt", NEW, "Entire house"),
    ("House", "Private room", None, "Private room in house"),
])
def test_property_recode(spark, kind, room, seen, want):
    df = spark.createDataFrame([(kind, room, seen)], "kind string, room string, seen date")
    got = df.select(text.modern_property_type(
        F.col("kind"), F.col("room"), F.col("seen"), text.RECODE_CUTOFF)).first()[0]
    assert got == want


def test_dates(spark):
    df = spark.createDataFrame([
        ("05_2020", "2020-05-11", "03/04/2015"),
        ("07_2020", "2020-09-05", "3/4/2015"),
        ("07_2020", None, None),
        ("07_2020", "2020-06-30", "31/02/2015"),
        ("02_2020", "nonsense", ""),
        ("13_2020", "2020-01-01", "2015-04-03"),
    ], "m string, d string, s string")
    m, d = dates.month_start(F.col("m")), dates.iso_day(F.col("d"))
    got = [tuple(r) for r in df.select(
        m, dates.clamp_to_month(d, m), dates.is_after_month(d, m),
        dates.day_first(F.col("s"))).collect()]
    since = date(2015, 4, 3)
    assert got == [
        (date(2020, 5, 1), date(2020, 5, 11), False, since),
        (date(2020, 7, 1), date(2020, 7, 31), True, since),
        (date(2020, 7, 1), date(2020, 7, 31), None, None),
        (date(2020, 7, 1), date(2020, 6, 30), False, None),
        (date(2020, 2, 1), date(2020, 2, 29), None, None),
        (None, date(2020, 1, 1), None, None),
    ]


def test_text_and_flags(spark):
    df = spark.createDataFrame(
        [(" Waverly ", "t"), ("  ", "f"), (None, None), (" bondi", "T"), ("Waverley", "")],
        "s string, f string")
    got = [tuple(r) for r in df.select(
        text.suburb_name(F.col("s")), text.blank_to_null(F.col("s")),
        text.flag(F.col("f"))).collect()]
    assert got == [("WAVERLEY", "Waverly", True), (None, None, False), (None, None, None),
                   ("BONDI", "bondi", None), ("WAVERLEY", "Waverley", None)]


def test_surrogate_key(spark):
    df = spark.createDataFrame([(1, "05_2020"), (1, None), (1, ""), (None, None)],
                               "a long, b string")
    got = [r[0] for r in df.select(keys.surrogate_key("a", "b")).collect()]
    assert len(set(got)) == 4
    assert got[0] == hashlib.md5(b"1-05_2020").hexdigest()
    assert got[1] == hashlib.md5(f"1-{keys.NULL_KEY_PART}".encode()).hexdigest()
    assert got[2] == hashlib.md5(b"1-").hexdigest()


@pytest.mark.parametrize("part, whole, times, want", [
    (1, 3, 1, "0.33"), (2, 3, 100, "66.67"), (1, 8, 1, "0.13"), (-1, 8, 1, "-0.13"),
    (201, 200, 1, "1.01"), (5, 0, 1, None), (None, 3, 1, None), (0, 3, 100, "0.00"),
])
def test_ratio_rounds_halves_away_from_zero(spark, part, whole, times, want):
    df = spark.createDataFrame([(part, whole)], "p long, w long")
    got = df.select(numbers.ratio(F.col("p"), F.col("w"), times)).first()[0]
    assert got == (None if want is None else Decimal(want))


def test_unreadable_dates_are_counted(spark, rows):
    df = spark.createDataFrame(
        [("05_2020", "2020-05-01", "1/2/2015"), ("5-2020", "soon", ""), (None, None, "2015"),
         ("13_2020", "2020-02-30", "31/4/2015")],
        "source_month string, scraped_date string, host_since string")
    assert rows(unreadable_dates(df)) == [("host_since", 2), ("scraped_date", 2),
                                          ("source_month", 2)]


def test_ratio_keeps_a_divisor_with_decimals(spark):
    from tidemark.functions.numbers import ratio

    df = spark.sql("SELECT 10.50BD AS a, 1.50BD AS b, 0.40BD AS c, 0BD AS z")
    row = df.select(ratio(F.col("a"), F.col("b")), ratio(F.col("a"), F.col("c")), ratio(F.col("a"), F.col("z"))).first()
    assert [None if v is None else float(v) for v in row] == [7.0, 26.25, None]


def test_dates_with_too_many_parts_are_unreadable(spark):
    from tidemark.functions import dates

    df = spark.sql("SELECT '1/2/3/2012' AS d, '05_xx_2020' AS m, '1/2/2012' AS ok, '05_2020' AS fine")
    row = df.select(dates.day_first(F.col("d")), dates.month_start(F.col("m")),
                    dates.day_first(F.col("ok")), dates.month_start(F.col("fine"))).first()
    assert [str(v) for v in row] == ["None", "None", "2012-02-01", "2020-05-01"]


def test_dates_are_read_without_splitting_text(spark):
    texts = [None, "", "_", "05_2020", "5_2020", "_05_2020", "05_2020_", "05__2020", "052020", "//", "1/2/2012",
             "/1/2/2012", "1/2/2012/", "1//2012", "1/2", "é_2020"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", dates.month_start(F.col("t")).alias("m"), dates.day_first(F.col("t")).alias("d"))
    assert "split(" not in got._jdf.queryExecution().optimizedPlan().toString()
    found = {r.t: (r.m, r.d) for r in got.collect() if r.m or r.d}
    assert found == {"05_2020": (date(2020, 5, 1), None), "5_2020": (date(2020, 5, 1), None),
                     "1/2/2012": (None, date(2012, 2, 1))}
