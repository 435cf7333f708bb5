"""The three marts.  Each is one lazy plan, as a view over the stored star would be: making
it runs no job and stores nothing, whatever the size of the dimensions.

Distinct hosts and superhosts are counted by grouping twice (per group and host, then per
group) instead of several count-distincts, which would copy every fact row per distinct
column.  The median has its own narrow pass, so no row carries a value map through the
host grouping; that pass scans the group, price and activity columns of active rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from ..operators.measures import exact_median, is_active, mom_change, revenue, stays
from ..operators.star import asof_join

# Partial measure -> how partials combine.
_COMBINE = {
    "total_listings": F.sum, "active_listings": F.sum,
    "min_price": F.min, "max_price": F.max, "price_sum": F.sum, "price_n": F.sum,
    "review_sum": F.sum, "review_n": F.sum, "total_stays": F.sum, "total_revenue": F.sum,
}


def _partials() -> list[Column]:
    """Measures of fact rows that later groupings can combine."""
    def active(c: Column) -> Column:
        return F.when(is_active(), c)

    price, review = F.col("price"), F.col("review_scores_rating")
    return [
        F.count(F.lit(1)).alias("total_listings"),
        F.count_if(is_active()).alias("active_listings"),
        F.min(active(price)).alias("min_price"),
        F.max(active(price)).alias("max_price"),
        F.sum(active(price)).alias("price_sum"),
        F.count(active(price)).alias("price_n"),
        F.sum(active(review)).alias("review_sum"),
        F.count(active(review)).alias("review_n"),
        F.sum(stays()).alias("total_stays"),
        F.sum(revenue()).alias("total_revenue"),
    ]


def _combined() -> list[Column]:
    return [how(c).alias(c) for c, how in _COMBINE.items()]


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on equal keys where NULL equals NULL; ``right`` is one row per key."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, "left").drop(*[f"_r_{k}" for k in keys])


def listing_metrics(rows: DataFrame, hosts: DataFrame, group: Sequence[str],
                    month: str = "month_year") -> DataFrame:
    """The twelve listing metrics per group and month.

    ``rows`` are fact rows that already carry the ``group`` columns.  They are brought together
    by (group, month, host) as they are: few rows share those and a day, so combining in the map
    tasks would hold nearly every row of a task beside ten measures.  There are as many parts as
    stored files, since Spark would merge parts by their bytes in the shuffle, which are far fewer
    than those of the measures.  Then they are reduced to
    one per (group, month, host, day) before they meet the host versions, so a host with a
    third of all rows is a few rows per group and day when a big dimension is shuffled; after
    that join, or with a broadcast dimension all along, they are together for the grouping by host.
    """
    keys = [*group, month]
    per_host = [*keys, "host_id"]
    used = ["scraped_date", "is_active", "price", "availability_30", "review_scores_rating"]
    narrow = rows.select(*per_host, *used)
    files = len(rows.inputFiles())  # each holds a bounded number of fact rows, so a part does
    together = narrow.repartition(files, *per_host) if files else narrow.repartition(*per_host)
    daily = together.groupBy(*per_host, "scraped_date").agg(*_partials())
    marked = asof_join(daily, hosts, F.col("host_id"), "host_id", "scraped_date",
                       {"host_is_superhost": "host_is_superhost"})
    by_host = marked.groupBy(*per_host).agg(
        *_combined(), F.max("host_is_superhost").alias("was_superhost"))
    monthly = by_host.groupBy(*keys).agg(
        *_combined(),
        F.count(F.lit(1)).alias("distinct_hosts"),
        F.count_if("was_superhost").alias("distinct_superhosts"),
    )
    monthly = monthly.withColumn(
        "inactive_listings", F.col("total_listings") - F.col("active_listings"))

    median = exact_median(rows.where(is_active()), keys, "price", "median_price")
    changes = mom_change(monthly, group, month, {
        "active_listings": "active_listings_pct_change",
        "inactive_listings": "inactive_listings_pct_change",
    })
    c = F.col
    return _null_safe(changes, median, keys).select(
        *keys,
        ratio(c("active_listings"), c("total_listings"), 100).alias("active_listings_rate"),
        "min_price",
        "max_price",
        "median_price",
        ratio(c("price_sum"), c("price_n")).alias("avg_price"),
        "distinct_hosts",
        ratio(c("distinct_superhosts"), c("distinct_hosts"), 100).alias("superhost_rate"),
        ratio(c("review_sum"), c("review_n")).alias("avg_review_scores_rating"),
        "active_listings_pct_change",
        "inactive_listings_pct_change",
        F.coalesce("total_stays", F.lit(0)).alias("total_stays"),
        ratio(c("total_revenue"), c("active_listings"))
            .alias("avg_estimated_revenue_per_active_listing"),
    )


def _facts(fact: DataFrame) -> DataFrame:
    return fact.withColumnRenamed("listing_month", "month_year")


def _or_unknown(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("Unknown")).alias(name)


def listing_neighbourhood(fact: DataFrame, lgas: DataFrame, hosts: DataFrame) -> DataFrame:
    """Listing metrics per LGA of the listing and month."""
    rows = asof_join(_facts(fact), lgas, F.col("listing_lga_code"), "lga_code", "scraped_date",
                     {"lga_name": "listing_neighbourhood"})
    rows = rows.withColumn("listing_neighbourhood", _or_unknown("listing_neighbourhood"))
    return listing_metrics(rows, hosts, ["listing_neighbourhood"])


def property_type(fact: DataFrame, listings: DataFrame, hosts: DataFrame) -> DataFrame:
    """Listing metrics per property type, room type, capacity and month.

    When the listing dimension is too big to broadcast, each of the two passes shuffles its
    own few fact columns to it: the median pass only active rows with their price.
    """
    rows = asof_join(
        _facts(fact).select("listing_id", "host_id", "scraped_date", "month_year", "is_active",
                            "price", "availability_30", "review_scores_rating"),
        listings, F.col("listing_id"), "listing_id", "scraped_date",
        {c: c for c in ("property_type", "room_type", "accommodates")},
    ).drop("listing_id")
    rows = rows.withColumns({c: _or_unknown(c) for c in ("property_type", "room_type")})
    return listing_metrics(rows, hosts, ["property_type", "room_type", "accommodates"])


def host_neighbourhood(fact: DataFrame, suburbs: DataFrame, lgas: DataFrame) -> DataFrame:
    """Hosts and revenue per LGA of the host's suburb and month."""
    rows = asof_join(_facts(fact), suburbs, F.col("host_suburb"), "suburb_name", "scraped_date",
                     {"lga_name": "suburb_lga"})
    rows = asof_join(rows, lgas, F.col("suburb_lga"), "lga_name_upper", "scraped_date",
                     {"lga_name": "host_neighbourhood_lga"})
    keys = ["host_neighbourhood_lga", "month_year"]
    by_host = (
        rows.withColumn(keys[0], _or_unknown(keys[0]))
        .groupBy(*keys, "host_id")
        .agg(F.count_if(is_active()).alias("active"), F.sum(revenue()).alias("revenue"))
    )
    monthly = by_host.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("distinct_hosts"),
        F.sum("active").alias("active"),
        F.sum("revenue").alias("revenue"),
    )
    return monthly.select(
        *keys, "distinct_hosts",
        ratio(F.col("revenue"), F.col("active"))
            .alias("avg_estimated_revenue_per_active_listing"),
        ratio(F.col("revenue"), F.col("distinct_hosts")).alias("estimated_revenue_per_host"),
        F.col("revenue").alias("total_estimated_revenue"),
    )


# Order in which each mart is shown.
PRESENTATION = {
    "listing_neighbourhood": ["listing_neighbourhood", "month_year"],
    "property_type": ["property_type", "room_type", "accommodates", "month_year"],
    "host_neighbourhood": ["host_neighbourhood_lga", "month_year"],
}


def presented(mart: DataFrame, name: str) -> DataFrame:
    """The mart in its display order, NULL last.  Only for showing: sorting is a shuffle."""
    return mart.orderBy(*[F.col(c).asc_nulls_last() for c in PRESENTATION[name]])
