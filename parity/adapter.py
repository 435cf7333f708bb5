"""The five raw tables, made from the given TPC-H-like tables (formulas: FIXTURES.md, part 3).

A listing is a part, a host is a supplier, and a monthly extract is the line items of a part
shipped in a month.  Everything is integer, date or text arithmetic, so that the SQL twin in
``oracle.py`` gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.geography import SUBURB_OVERRIDES, constant_table
from tidemark.sources.raw import RAW_LISTINGS, SCORES
from tidemark.sources.store import write_by_month

FIRST_YEAR = 1995
CUTOFF = "1998-08-01"  # the given line items run from 1995 to 2001

PROPERTY_TYPES = ("Apartment", "House", "Other", "Boat", "Hotel", "Casa particular (Cuba)",
                  "Tiny house", "Aparthotel", "Loft")
ROOM_TYPES = ("Private room", "Shared room", "Hotel room", "Lounge", "Entire home/apt")
PLACES = ("Africa ", "America", "Asia", "Europe", "Middle East")
EXTRA_LGAS = (("14170", "Inner West"), ("15350", "Mosman"), ("17200", "Sydney"),
              ("18050", "Waverley"))
EXTRA_SUBURBS = (*((s.capitalize(), in_file) for s, _, in_file in SUBURB_OVERRIDES),
                 ("WAVERLEY", "WAVERLEY"), ("Gundagai", "NOT LISTED"))
EMPTY_LGA = "LGA19499"
# Month multipliers of the five scores that the fixture description leaves open.
SCORE_STEPS = (2, 3, 5, 7, 11)


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows brought together by month while they hold only what the columns are made from.

    ``rebalance`` does that without tying a month to one task: a month with a third of all rows
    is split over several.
    """
    monthly = (
        given(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", F.trunc("l_shipdate", "month").alias("month"))
        .agg(F.min("l_shipdate").cast("date").alias("day"),
             F.min("l_suppkey").alias("l_suppkey"),
             F.min("l_quantity").cast("int").alias("quantity"))
    )
    part = given(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    supplier = given(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    rows = (
        monthly.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .drop("p_partkey", "s_suppkey")
        .hint("rebalance", "month")
        .select(
            "*",
            (F.col("l_partkey") + 1).alias("listing_id"),
            (F.col("l_suppkey") + 1).alias("host_id"),
            ((F.year("month") - FIRST_YEAR) * 12 + F.month("month") - 1).alias("mi"),
        )
    )
    listing, host, mi, size = (F.col(c) for c in ("listing_id", "host_id", "mi", "p_size"))
    gap = (host % 37 == 0) | ((listing + host * 7 + mi) % 11 == 0)
    late = (listing + mi) % 13 == 0
    nation = (F.col("s_nationkey") + F.floor(mi / 24)) % 25

    def two(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")

    scores = [F.when(listing % 9 != 0, 60 + (listing + mi) % 41)]
    scores += [F.when(listing % 9 != 0, 1 + (listing + mi * k) % 10) for k in SCORE_STEPS]
    columns = {
        "listing_id": listing,
        "scrape_id": 1_000_000 + mi,
        "source_month": F.concat(two(F.month("month")), F.lit("_"),
                                 F.year("month").cast("string")),
        "scraped_date": F.when(late, F.date_add("day", 40)).otherwise(F.col("day")),
        "host_id": host,
        "host_name": F.when(gap, None).when(host % 17 == 0, "  ")
            .otherwise(F.concat(F.lit(" "), "s_name", F.lit(" "))),
        "host_since": F.when(~gap, F.concat(
            two(1 + host % 28), F.lit("/"), two(1 + host % 12), F.lit("/2012"))),
        "host_is_superhost": F.when(
            ~gap, F.when((host + F.floor(mi / 6)) % 2 == 0, "t").otherwise("f")),
        "host_neighbourhood": F.when(host % 19 == 0, None).when(host % 23 == 0, " ")
            .when(host % 29 == 0, "Waverly").when(host % 31 == 0, "Enmore")
            .when(host % 41 == 0, "Overseas")
            .otherwise(F.concat(F.lit(" Nation_"), nation.cast("string"))),
        "listing_neighbourhood": F.when(listing % 47 == 0, "Nowhere")
            .otherwise(_pick(size % 5, PLACES)),
        "property_type": _pick(size % 9, PROPERTY_TYPES),
        "room_type": _pick(listing % 5, ROOM_TYPES),
        "accommodates": 1 + size % 8 + F.when((mi >= 40) & (listing % 6 == 0), 1).otherwise(0),
        "price": F.col("p_retailprice").cast("decimal(12,2)")
            + mi.cast("decimal(10,0)") * F.lit("0.01").cast("decimal(3,2)"),
        "has_availability": F.when((listing + mi) % 7 == 0, "f")
            .when((listing + mi) % 29 == 0, None).otherwise("t"),
        "availability_30": F.col("quantity") % 31,
        "number_of_reviews": (listing * mi) % 300,
        **dict(zip(SCORES, scores, strict=True)),
    }
    return rows.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in RAW_LISTINGS])


def _peopled_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers counted per nation, with the nation's region: at most one row per nation."""
    balance = F.col("c_acctbal").cast("decimal(18,2)")
    people = given(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("people"), F.sum(balance).alias("sum_bal"),
        F.min(balance).alias("min_bal"), F.max(balance).alias("max_bal"))
    return (
        people.join(given(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(given(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def _code() -> Column:
    return (F.col("r_regionkey") * 10 + 10_000).cast("string")


def lga_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of the regions that have customers, and four fixed ones."""
    name = F.concat(F.lit(" "), F.upper(F.substring("r_name", 1, 1)),
                    F.lower(F.expr("substring(r_name, 2)")), F.lit(" "))
    regions = _peopled_nations(spark, sf_dir).select(
        _code().alias("lga_code"), name.alias("lga_name")).distinct()
    return regions.unionByName(constant_table(spark, ["lga_code", "lga_name"], EXTRA_LGAS))


def suburbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations that have customers as suburbs of their region, and seven fixed ones."""
    nations = _peopled_nations(spark, sf_dir).select(
        F.concat(F.lower("n_name"), F.lit(" ")).alias("suburb_name"),
        F.col("r_name").alias("lga_name"))
    return nations.unionByName(constant_table(spark, ["suburb_name", "lga_name"], EXTRA_SUBURBS))


def census(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Customer counts and balances per region, and an all-zero area that is no real LGA."""
    measures = {"census_g01": {"tot_p": ("people", F.sum), "sum_bal": ("sum_bal", F.sum)},
                "census_g02": {"min_bal": ("min_bal", F.min), "max_bal": ("max_bal", F.max)}}[table]
    types = {"tot_p": "bigint"}
    regions = (
        _peopled_nations(spark, sf_dir)
        .groupBy(F.concat(F.lit("LGA"), _code()).alias("lga_code_2016"))
        .agg(*[how(c).cast(types.get(name, "decimal(18,2)")).alias(name)
               for name, (c, how) in measures.items()])
    )
    zero = spark.range(1).select(F.lit(EMPTY_LGA).alias("lga_code_2016"), *[
        F.lit(0).cast(types.get(name, "decimal(18,2)")).alias(name) for name in measures])
    return regions.unionByName(zero)


#: How each raw table is made.
MAKERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "listings": listings,
    "census_g01": partial(census, table="census_g01"),
    "census_g02": partial(census, table="census_g02"),
    "nsw_lga_code": lga_codes,
    "nsw_lga_suburb": suburbs,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: make(spark, sf_dir) for name, make in MAKERS.items()}


def land_table(spark: SparkSession, sf_dir: str, root: str, name: str) -> DataFrame:
    """Store a raw table the way a loading job would, listings in monthly directories, and read
    it back."""
    df = MAKERS[name](spark, sf_dir)
    if name == "listings":
        write_by_month(df, f"{root}/{name}", "source_month")
    else:
        df.write.parquet(f"{root}/{name}")
    return landed_table(spark, root, name)


def landed_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    if name != "listings":
        return spark.read.parquet(f"{root}/{name}")
    return spark.read.schema(RAW_LISTINGS).parquet(f"{root}/{name}").select(*RAW_LISTINGS.names)


def land(spark: SparkSession, sf_dir: str, root: str) -> dict[str, DataFrame]:
    """All raw tables, each from the tables that it is made of."""
    return {name: land_table(spark, sf_dir, root, name) for name in MAKERS}


def landed(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: landed_table(spark, root, name) for name in MAKERS}
