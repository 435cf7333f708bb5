"""Raw listings to bronze and silver listings.  Both are narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..functions.keys import surrogate_key
from ..sources.raw import SCORES


def bronze_listings(raw: DataFrame) -> DataFrame:
    """Every raw column behind a row key."""
    return raw.select(surrogate_key("listing_id", "source_month").alias("listing_row_id"), "*")


def clean_listings(bronze: DataFrame, cutoff: str = text.RECODE_CUTOFF) -> DataFrame:
    """One cleaned, typed row per bronze row."""
    c = F.col
    # Parsed in a projection of their own, as several columns below read them.
    dated = bronze.withColumns({
        "listing_month": dates.month_start(c("source_month")),
        "scraped_date_raw": dates.iso_day(c("scraped_date")),
    })
    month, seen = c("listing_month"), c("scraped_date_raw")
    return dated.select(
        "listing_row_id",
        "listing_id",
        "host_id",
        "source_month",
        "listing_month",
        dates.clamp_to_month(seen, month).alias("scraped_date"),
        "scraped_date_raw",
        dates.is_after_month(seen, month).alias("is_scraped_date_fixed"),
        text.blank_to_null(c("host_name")).alias("host_name"),
        dates.day_first(c("host_since")).alias("host_since"),
        text.flag(c("host_is_superhost")).alias("host_is_superhost"),
        text.suburb_name(c("host_neighbourhood")).alias("host_neighbourhood"),
        F.trim("listing_neighbourhood").alias("listing_neighbourhood"),
        text.modern_property_type(c("property_type"), c("room_type"), seen, cutoff)
            .alias("property_type"),
        c("property_type").alias("property_type_raw"),
        "room_type",
        "accommodates",
        "price",
        text.flag(c("has_availability")).alias("has_availability"),
        "availability_30",
        "number_of_reviews",
        *SCORES,
    )


def unreadable_dates(bronze: DataFrame) -> DataFrame:
    """Rows whose date text gave no date, per column: (column_name, unreadable).

    Cleaning turns such text into NULL so that one bad row does not stop a build; this
    says how often it did.
    """
    readers = {"source_month": dates.month_start, "scraped_date": dates.iso_day,
               "host_since": dates.day_first}
    counts = bronze.agg(*[
        F.count_if(text.blank_to_null(F.col(c)).isNotNull() & read(F.col(c)).isNull()).alias(c)
        for c, read in readers.items()])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("unreadable")) for c in readers])))
