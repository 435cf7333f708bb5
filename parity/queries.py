"""The registered queries: one per operator, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates, text
from tidemark.operators import geography, history, listings, measures, quality, snapshot, star
from tidemark.plans import build, marts
from tidemark.plans.rules import ALL_RULES
from tidemark.sources.raw import read_raw
from tidemark.sources.store import Scratch, Warehouse

from . import adapter

Query = Callable[[SparkSession, str], DataFrame]

RUN_1 = datetime(1999, 1, 1)
RUN_2 = datetime(2000, 1, 1)
RUN_1_LAST_MONTH = "1997-12-01"


def portable(df: DataFrame) -> DataFrame:
    """Types that any client compares alike: dates as ISO text, decimals as doubles."""
    def cast(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double")
        if isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*[cast(f) for f in df.schema])


# ---- inputs -------------------------------------------------------------------------


_landed: dict[tuple[str, str], dict[str, DataFrame]] = {}
_roots: dict[tuple[str, str], str] = {}
_houses: dict[tuple[str, str], Warehouse] = {}


def _session_key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, sf_dir


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw table as a loading job left it: made once per session, when a query first reads it."""
    at = _session_key(spark, sf_dir)
    held = _landed.setdefault(at, {})
    if name not in held:
        root = _roots.setdefault(at, Scratch(spark, "raw").path)
        held[name] = adapter.land_table(spark, sf_dir, root, name)
    return held[name]


def landed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All raw tables."""
    return {name: raw(spark, sf_dir, name) for name in adapter.MAKERS}


def house(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse after two builds, made once per session for the queries that read it.

    The first build sees the months up to 1997 and no suburb overrides, the second
    everything, so the dimensions hold closed and open versions.  The landed listings lie in
    monthly directories already, so the builds need not bring months together.
    """
    at = _session_key(spark, sf_dir)
    if at not in _houses:
        root = Scratch(spark, "warehouse").path
        tables = landed(spark, sf_dir)
        early = dates.month_start(F.col("source_month")) <= F.lit(RUN_1_LAST_MONTH).cast("date")
        build.run_build(spark, {**tables, "listings": tables["listings"].where(early)}, root, RUN_1,
                        cutoff=adapter.CUTOFF, overrides=(), with_gold=False, regroup_months=False)
        _houses[at] = build.run_build(spark, tables, root, RUN_2, cutoff=adapter.CUTOFF,
                                      regroup_months=False)
    return _houses[at]


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.bronze({"listings": raw(spark, sf_dir, "listings")})["listings"]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.clean_listings(bronze(spark, sf_dir), adapter.CUTOFF)


def first_run(clean: DataFrame) -> DataFrame:
    return clean.where(F.col("listing_month") <= F.lit(RUN_1_LAST_MONTH).cast("date"))


# ---- bronze and silver --------------------------------------------------------------


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored as comma-separated text, then read back through the typed reader."""
    path = Scratch(spark, "text").path
    raw(spark, sf_dir, "listings").write.option("header", True).csv(
        path, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return read_raw(spark, "listings", path, "csv")


def bronze_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row and column of the four stored tables that are copied as they are."""
    parts = [build.table(house(spark, sf_dir), f"bronze.{t}").select(F.lit(t).alias("table_name"), "*")
             for t in ("census_g01", "census_g02", "nsw_lga_code", "nsw_lga_suburb")]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(spark, sf_dir).select("listing_row_id", "listing_id", "source_month")


def _silver_columns(*columns: str) -> Query:
    return lambda spark, sf_dir: silver(spark, sf_dir).select("listing_row_id", *columns)


def suburb_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inline table beside the number of listing rows whose host lives in its suburb."""
    hosts = silver(spark, sf_dir).groupBy("host_neighbourhood").agg(
        F.count(F.lit(1)).alias("listing_rows"))
    fixes = geography.suburb_overrides(spark)
    return (fixes.join(hosts, F.col("suburb_name") == F.col("host_neighbourhood"), "left")
            .select(*fixes.columns, F.coalesce("listing_rows", F.lit(0)).alias("listing_rows")))


def census(name: str) -> Query:
    return lambda spark, sf_dir: geography.clean_census(raw(spark, sf_dir, name))


def lga_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geography.clean_lga_codes(raw(spark, sf_dir, "nsw_lga_code"))


def suburb_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geography.map_suburbs(raw(spark, sf_dir, "nsw_lga_suburb"),
                                 geography.suburb_overrides(spark))


# ---- history ------------------------------------------------------------------------


def _of_silver(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(silver(spark, sf_dir))


def scd2_timestamp_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = silver(spark, sf_dir)
    runs = [history.latest_hosts(c).drop("listing_month") for c in (first_run(clean), clean)]
    before = snapshot.snapshot_merge(None, runs[0], "host_id", updated_at="updated_at")
    return snapshot.snapshot_merge(before, runs[1], "host_id", updated_at="updated_at")


def scd2_check_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = raw(spark, sf_dir, "nsw_lga_suburb")
    runs = [geography.map_suburbs(mapping, geography.suburb_overrides(spark, rows))
            .select("suburb_name", "lga_name") for rows in ((), geography.SUBURB_OVERRIDES)]
    before = snapshot.snapshot_merge(None, runs[0], "suburb_name", check_cols=["lga_name"],
                                     run_ts=RUN_1)
    return snapshot.snapshot_merge(before, runs[1], "suburb_name", check_cols=["lga_name"],
                                   run_ts=RUN_2)


def _dimension(maker: Callable[[DataFrame], DataFrame], snap: str) -> Query:
    return lambda spark, sf_dir: maker(build.table(house(spark, sf_dir), snap))


# ---- star ---------------------------------------------------------------------------


def key_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host keys against the hosts of the first run only, suburb keys against the suburbs."""
    h = house(spark, sf_dir)
    rows = build.table(h, "silver.listings").select(
        "listing_row_id", "host_id", F.col("host_neighbourhood").alias("suburb_name"))
    early = h.snapshot("silver.host_snapshot", h.builds[:1])
    rows = star.resolve_key(rows, "host_id", early, 0)
    rows = star.resolve_key(rows, "suburb_name", build.table(h, "gold.dim_suburb"), "UNKNOWN")
    return rows.withColumnRenamed("suburb_name", "host_suburb")


def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listing row with the host version of its day, from the full host history."""
    clean = build.table(house(spark, sf_dir), "silver.listings")
    scratch = Scratch(spark, "asof")
    versions = scratch(star.dim_host(history.host_history(clean)), "host_versions")
    rows = clean.select("listing_row_id", "host_id", "scraped_date")
    hot = scratch(star.hot_keys(rows, F.col("host_id")), "hot_hosts")
    return star.asof_carry(rows, versions, F.col("host_id"), "host_id", "scraped_date", {
        "host_is_superhost": "host_is_superhost", "host_neighbourhood": "version_neighbourhood",
        "valid_from": "version_from"}, hot)


def fact_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = house(spark, sf_dir)
    return star.fact_listings(
        build.table(h, "silver.listings"), build.table(h, "gold.dim_listing"),
        build.table(h, "gold.dim_host"), build.table(h, "gold.dim_lga"),
        build.table(h, "gold.dim_suburb"))


# ---- marts and measures -------------------------------------------------------------


def _mart(name: str) -> Query:
    return lambda spark, sf_dir: build.mart(house(spark, sf_dir), name)


def mom_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active listings per listing and month, where most months are missing."""
    fact = build.table(house(spark, sf_dir), "gold.fact_listings")
    monthly = fact.groupBy("listing_id", "listing_month").agg(
        F.sum("is_active").alias("active"), F.sum("availability_30").alias("free_nights"))
    return measures.mom_change(monthly, ["listing_id"], "listing_month", {
        "active": "active_pct_change", "free_nights": "free_nights_pct_change"})


def stay_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = build.table(house(spark, sf_dir), "gold.fact_listings")
    return fact.select("listing_row_id", measures.stays().alias("stays"),
                       measures.revenue().alias("revenue"))


# ---- data quality -------------------------------------------------------------------

# Rules over the built tables; those that a sound build must fail are marked.
RULES = {
    "dq_unique": [r for r in ALL_RULES if r.kind == quality.UNIQUE]
        + [quality.unique("silver.listings", "listing_id"),        # fails
           quality.unique("silver.listings", "host_name")],        # fails, NULL ignored
    "dq_not_null": [r for r in ALL_RULES if r.kind == quality.NOT_NULL]
        + [quality.not_null("silver.listings", "host_name"),       # fails
           quality.not_null("silver.listings", "has_availability")],  # fails
    "dq_relationships": [r for r in ALL_RULES if r.kind == quality.RELATIONSHIPS]
        + [quality.relationships("silver.listings", "host_neighbourhood",
                                 "gold.dim_suburb", "suburb_name")],  # fails
    "dq_accepted_values": [r for r in ALL_RULES if r.kind == quality.ACCEPTED_VALUES]
        + [quality.accepted_values("silver.listings", "room_type",
                                   ["Private room", "Shared room", "Hotel room"])],  # fails
    "dq_accepted_range": [r for r in ALL_RULES if r.kind == quality.ACCEPTED_RANGE]
        + [quality.accepted_range("silver.listings", "availability_30", 2, 20),  # fails
           quality.accepted_range("silver.listings", "review_scores_rating", low=70)],  # fails
    "dq_unique_combination": [r for r in ALL_RULES if r.kind == quality.UNIQUE_COMBINATION]
        + [quality.unique_combination("silver.listings", ["host_id", "listing_month"]),  # fails
           quality.unique_combination("silver.listings",
                                      ["host_name", "property_type"])],  # fails, NULLs equal
    "dq_report": ALL_RULES,
}


def _dq(name: str) -> Query:
    return lambda spark, sf_dir: build.quality_report(house(spark, sf_dir), RULES[name])


# -------------------------------------------------------------------------------------

QUERIES: dict[str, Query] = {
    "raw_listings": raw_listings,
    "bronze_copy": bronze_copy,
    "bronze_listings": bronze,
    "surrogate_key": surrogate_key,
    "date_clamp": _silver_columns("listing_month", "scraped_date", "scraped_date_raw",
                                  "is_scraped_date_fixed", "host_since"),
    "flag_decode": _silver_columns("host_is_superhost", "has_availability"),
    "text_clean": _silver_columns("host_name", "host_neighbourhood", "listing_neighbourhood"),
    "property_recode": _silver_columns("property_type", "property_type_raw", "room_type"),
    "silver_listings": silver,
    "census_g01": census("census_g01"),
    "census_g02": census("census_g02"),
    "lga_code": lga_code,
    "suburb_override": suburb_override,
    "suburb_mapping": suburb_mapping,
    "host_monthly": _of_silver(history.host_monthly),
    "listing_monthly": _of_silver(history.listing_monthly),
    "host_versions": _of_silver(history.host_versions),
    "listing_versions": _of_silver(history.listing_versions),
    "host_latest": _of_silver(history.latest_hosts),
    "listing_latest": _of_silver(history.latest_listings),
    "host_history": _of_silver(history.host_history),
    "listing_history": _of_silver(history.listing_history),
    "scd2_timestamp_two_runs": scd2_timestamp_two_runs,
    "scd2_check_two_runs": scd2_check_two_runs,
    "dim_host": _dimension(star.dim_host, "silver.host_snapshot"),
    "dim_listing": _dimension(star.dim_listing, "silver.listing_snapshot"),
    "dim_lga": _dimension(star.dim_lga, "silver.lga_snapshot"),
    "dim_suburb": _dimension(star.dim_suburb, "silver.suburb_snapshot"),
    "key_resolution": key_resolution,
    "asof_join": asof_join,
    "fact_listings": fact_listings,
    "mart_listing_neighbourhood": _mart("listing_neighbourhood"),
    "mart_property_type": _mart("property_type"),
    "mart_host_neighbourhood": _mart("host_neighbourhood"),
    "mom_change": mom_change,
    "stay_revenue": stay_revenue,
    **{name: _dq(name) for name in RULES},
}


def queries() -> dict[str, Query]:
    def wrap(q: Query) -> Query:
        return lambda spark, sf_dir: portable(q(spark, sf_dir))

    return {name: wrap(q) for name, q in QUERIES.items()}
