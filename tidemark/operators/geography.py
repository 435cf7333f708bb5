"""Census, LGA and suburb tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import upper_name

# Suburbs the file maps to a regional LGA of the same suburb name,
# as (suburb, right LGA, LGA in the file).
SUBURB_OVERRIDES = (
    ("DARLINGTON", "SYDNEY", "SINGLETON"),
    ("THE ROCKS", "SYDNEY", "BATHURST REGIONAL"),
    ("SUMMER HILL", "INNER WEST", "DUNGOG"),
    ("ENMORE", "INNER WEST", "ARMIDALE REGIONAL"),
    ("BALMORAL", "MOSMAN", "LAKE MACQUARIE"),
)


def constant_table(spark: SparkSession, columns: list[str],
                   rows: Iterable[tuple[str, ...]]) -> DataFrame:
    """Inline table of text values, made in the JVM so that its size is known to the planner."""
    cells = [F.struct(*[F.lit(v).cast("string").alias(c) for c, v in zip(columns, r, strict=True)])
             for r in rows]
    if not cells:
        return spark.range(0).select(*[F.lit(None).cast("string").alias(c) for c in columns])
    return spark.range(1).select(F.inline(F.array(*cells)))


def suburb_overrides(spark: SparkSession,
                     rows: Iterable[tuple[str, str, str]] = SUBURB_OVERRIDES) -> DataFrame:
    return constant_table(spark, ["suburb_name", "lga_name", "lga_name_in_file"], rows)


def clean_census(bronze: DataFrame) -> DataFrame:
    """LGA code without its prefix, then the code as given, then every other column in order."""
    rest = [c for c in bronze.columns if c.lower() != "lga_code_2016"]
    return bronze.select(
        F.regexp_replace("lga_code_2016", "^LGA", "").alias("lga_code"),
        F.col("lga_code_2016"),
        *rest,
    )


def clean_lga_codes(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.trim("lga_code").alias("lga_code"),
        F.trim("lga_name").alias("lga_name"),
        upper_name(F.col("lga_name")).alias("lga_name_upper"),
    )


def map_suburbs(bronze: DataFrame, overrides: DataFrame) -> DataFrame:
    """Suburb to LGA with the overrides applied; the LGA in the file is kept beside it.

    ``overrides`` is an inline table whose size the planner knows, so this is a broadcast
    join without a hint.
    """
    fix = overrides.select(F.col("suburb_name").alias("_suburb"), F.col("lga_name").alias("_lga"))
    mapped = bronze.select(
        upper_name(F.col("suburb_name")).alias("suburb_name"),
        upper_name(F.col("lga_name")).alias("lga_name_in_file"),
    ).join(fix, F.col("suburb_name") == F.col("_suburb"), "left")
    return mapped.select(
        "suburb_name",
        F.coalesce("_lga", "lga_name_in_file").alias("lga_name"),
        "lga_name_in_file",
        F.col("_suburb").isNotNull().alias("is_corrected"),
    )
