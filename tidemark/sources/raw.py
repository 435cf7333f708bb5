"""Readers for the five raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCORES = (
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "review_scores_communication", "review_scores_value",
)

RAW_LISTINGS = T.StructType([
    T.StructField("listing_id", T.LongType()),
    T.StructField("scrape_id", T.LongType()),
    T.StructField("source_month", T.StringType()),
    T.StructField("scraped_date", T.StringType()),
    T.StructField("host_id", T.LongType()),
    T.StructField("host_name", T.StringType()),
    T.StructField("host_since", T.StringType()),
    T.StructField("host_is_superhost", T.StringType()),
    T.StructField("host_neighbourhood", T.StringType()),
    T.StructField("listing_neighbourhood", T.StringType()),
    T.StructField("property_type", T.StringType()),
    T.StructField("room_type", T.StringType()),
    T.StructField("accommodates", T.IntegerType()),
    T.StructField("price", T.DecimalType(12, 2)),
    T.StructField("has_availability", T.StringType()),
    T.StructField("availability_30", T.IntegerType()),
    T.StructField("number_of_reviews", T.IntegerType()),
    *[T.StructField(c, T.DecimalType(5, 2)) for c in SCORES],
])

LGA_CODE = T.StructType([
    T.StructField("lga_code", T.StringType()),
    T.StructField("lga_name", T.StringType()),
])

LGA_SUBURB = T.StructType([
    T.StructField("suburb_name", T.StringType()),
    T.StructField("lga_name", T.StringType()),
])

# Only the key of the census tables is declared; their other columns are taken as they come.
CENSUS = T.StructType([T.StructField("lga_code_2016", T.StringType())])

RAW_TABLES = {
    "listings": RAW_LISTINGS,
    "census_g01": CENSUS,
    "census_g02": CENSUS,
    "nsw_lga_code": LGA_CODE,
    "nsw_lga_suburb": LGA_SUBURB,
}


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the declared columns by name, declared ones first; other columns follow as they are.

    Text that does not fit its type becomes NULL rather than ending the job.
    """
    present = {c.lower(): c for c in df.columns}
    wanted = {f.name for f in schema}
    lacking = sorted(wanted - set(present))
    if lacking:
        raise ValueError(f"raw table lacks {lacking}")
    return df.select(
        *[F.col(present[f.name]).try_cast(f.dataType).alias(f.name) for f in schema],
        *[F.col(c).alias(low) for low, c in present.items() if low not in wanted],
    )


def read_raw(spark: SparkSession, name: str, path: str | None, fmt: str = "parquet",
             **options: str) -> DataFrame:
    """One raw table, from files (parquet, csv, orc, json) or any other Spark source.

    A listings file that does not carry ``source_month`` gets it from its file name,
    e.g. ``05_2020.csv``.  ``fmt='table'`` reads a catalog table; sources without a path
    (``fmt='jdbc'``) take ``None`` and their options.
    """
    if fmt == "table":
        return typed(spark.read.table(path), RAW_TABLES[name])
    if fmt == "csv":
        options = {"header": "true", **options}
    reader = spark.read.format(fmt).options(**options)
    df = reader.load() if path is None else reader.load(path)
    if name == "listings" and "source_month" not in [c.lower() for c in df.columns]:
        df = df.withColumn("source_month", F.nullif(
            F.regexp_extract(F.col("_metadata.file_name"), r"(\d{2}_\d{4})", 1), F.lit("")))
    return typed(df, RAW_TABLES[name])


def read_all_raw(spark: SparkSession, root: str, fmt: str = "parquet",
                 **options: str) -> dict[str, DataFrame]:
    """The five raw tables from ``root/<name>``."""
    return {n: read_raw(spark, n, f"{root}/{n}", fmt, **options) for n in RAW_TABLES}
