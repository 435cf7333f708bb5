"""The full build: raw tables to silver, snapshots and star; marts on top as views."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import RECODE_CUTOFF
from ..operators import geography, history, listings, quality, snapshot, star
from ..sources.store import MONTHLY, Commit, Scratch, Warehouse, in_months
from . import marts
from .rules import ALL_RULES

CENSUS = ("census_g01", "census_g02")

TABLES = (
    "bronze.listings", "bronze.census_g01", "bronze.census_g02", "bronze.nsw_lga_code",
    "bronze.nsw_lga_suburb",
    "silver.listings", "silver.host", "silver.listing_latest", "silver.nsw_lga_code",
    "silver.nsw_lga_suburb", "silver.suburb_override", "silver.census_g01", "silver.census_g02",
    "gold.dim_host", "gold.dim_listing", "gold.dim_lga", "gold.dim_suburb",
    "gold.fact_listings",
)
SNAPSHOTS = ("silver.host_snapshot", "silver.listing_snapshot", "silver.lga_snapshot",
             "silver.suburb_snapshot")
MARTS = ("mart.listing_neighbourhood", "mart.property_type", "mart.host_neighbourhood")


def bronze(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The bronze layer: raw tables as they are, listings with a row key."""
    return {**raw, "listings": listings.bronze_listings(raw["listings"])}


STATES = {"silver.host": history.host_entity, "silver.listing_latest": history.listing_entity}


def _with_state(state: DataFrame, of: history.Entity) -> DataFrame:
    """The latest row of each key beside what a later build needs to go on from it."""
    kept = F.struct("is_gap", "versions", "first").alias("state")
    columns = [F.col(f"last.{a}").alias(a) for a in of.attributes]
    return state.select(of.key, *columns, F.col("month").alias(of.month), "updated_at", kept)


def _state(stored: DataFrame, of: history.Entity) -> DataFrame:
    return stored.select(of.key, "state.*", F.struct(*of.attributes).alias("last"),
                         F.col(of.month).alias("month"), "updated_at")


def _state_before(house: Warehouse, first: date) -> Commit | None:
    """The last build whose state covers only months before ``first``, all as they are now."""
    oldest = None  # the oldest month that a later build wrote
    for c in reversed(house.commits):
        if c.through and c.through < first and not c.undated and (oldest is None or c.through < oldest):
            return c
        months = c.months.get("silver.listings")
        if not months or None in months:
            return None
        oldest = min(months) if oldest is None else min(oldest, *months)
    return None


def _same_rows(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def run_build(spark: SparkSession, raw: Mapping[str, DataFrame], root: str, run_ts: datetime, *,
              cutoff: str = RECODE_CUTOFF,
              overrides: Iterable[tuple[str, str, str]] = geography.SUBURB_OVERRIDES,
              with_gold: bool = True, regroup_months: bool = True,
              months: Iterable[date | None] | None = None) -> Warehouse:
    """Build every table from the raw tables and move the snapshots on by one run.

    Meant to run after each monthly load: the history holds what the runs saw.  ``run_ts``
    stamps the versions of tables that have no date of their own.  ``with_gold=False``
    stops after the snapshots, for catching up month by month.

    Without ``months`` all tables are made anew.  With them (first days of months; None for
    listings whose month cannot be read) only listings of these months are read and written:
    bronze, silver and the fact get new directories for them, the state of hosts and listings
    goes on from the build before them, and the snapshots get the changes.  The result is that
    of a build of everything.  A month that was loaded again also reads the months after it;
    where listings have no month, the state is made from all of them; where the suburbs or LGAs
    changed, the fact is.

    Bronze listings are brought together by month in one shuffle; silver and the fact follow
    from them by narrow work, so they are grouped as well.  ``regroup_months=False`` saves
    that shuffle where the raw listings come month by month (see ``Warehouse.write_monthly``).

    Raises :class:`ConcurrentBuild` at the end, and changes nothing, when another build was
    finished meanwhile.
    """
    house = Warehouse(spark, root)
    n = house.claim()
    known = house.commits and all(t in house.commits[-1].months for t in ("bronze.listings", "silver.listings"))
    touched = tuple(dict.fromkeys(months)) if months is not None and known else None

    def write(table: str, df: DataFrame) -> DataFrame:
        return house.write(table, n, df)

    layer = bronze(raw)
    src = {name: write(f"bronze.{name}", df) for name, df in layer.items() if name != "listings"}
    loaded = layer["listings"]
    if touched is not None:
        loaded = loaded.where(in_months(MONTHLY["bronze.listings"](), touched))
    src["listings"] = house.write_monthly("bronze.listings", n, loaded, "source_month", regroup_months)
    clean = house.write_monthly(
        "silver.listings", n, listings.clean_listings(src["listings"], cutoff), "listing_month", False)
    everything = clean if touched is None else house.monthly("silver.listings", (n, touched))
    month = F.col("listing_month")
    seen = clean.agg(F.max(month).alias("last"), F.count_if(month.isNull()).alias("undated")).first()
    undated = seen.undated > 0 or (touched is not None and None not in touched and house.commits[-1].undated)
    through = max((m for m in (seen.last, *(c.through for c in house.commits if touched is not None)) if m), default=None)

    before = None
    if touched and None not in touched and not undated:
        before = _state_before(house, min(touched))
    states = {}
    for name, entity in STATES.items():
        of = entity()
        if before is None:
            state = history.summary(everything, of)
        else:
            held = spark.read.parquet(house.path(name, before.build))
            later = everything.where(month > F.lit(before.through))
            state = history.merged(_state(held, of), history.summary(later, of), of)
        states[name] = write(name, _with_state(state, of)).drop("state")
        if before is not None:  # the other keys are as they were
            states[name] = states[name].where(month > F.lit(before.through))
    lgas = write("silver.nsw_lga_code", geography.clean_lga_codes(src["nsw_lga_code"]))
    fixes = write("silver.suburb_override", geography.suburb_overrides(spark, overrides))
    suburbs = write("silver.nsw_lga_suburb",
                    geography.map_suburbs(src["nsw_lga_suburb"], fixes))
    for name in CENSUS:
        write(f"silver.{name}", geography.clean_census(src[name]))

    whole = house.snapshot_is_whole()

    def advance(table: str, staged: DataFrame, key: str, **how) -> DataFrame:
        held = house.open_versions(table)
        house.write_snapshot(
            table, n, snapshot.snapshot_delta(held, staged, key, changes_only=not whole, **how), whole)
        return house.snapshot(table, [*house.builds, n], whole)

    host_snap = advance(
        "silver.host_snapshot",
        states["silver.host"].select("host_id", *history.HOST_ATTRIBUTES, "updated_at"),
        "host_id", updated_at="updated_at")
    listing_snap = advance(
        "silver.listing_snapshot",
        states["silver.listing_latest"].select("listing_id", *history.LISTING_ATTRIBUTES, "updated_at"),
        "listing_id", updated_at="updated_at")
    lga_snap = advance("silver.lga_snapshot", lgas, "lga_code",
                       check_cols=["lga_name"], run_ts=run_ts)
    suburb_snap = advance("silver.suburb_snapshot", suburbs.select("suburb_name", "lga_name"),
                          "suburb_name", check_cols=["lga_name"], run_ts=run_ts)

    written = {"bronze.listings": touched, "silver.listings": touched}
    if with_gold:
        dims = {
            "listing_dim": write("gold.dim_listing", star.dim_listing(listing_snap)),
            "host_dim": write("gold.dim_host", star.dim_host(host_snap)),
            "lga_dim": write("gold.dim_lga", star.dim_lga(lga_snap)),
            "suburb_dim": write("gold.dim_suburb", star.dim_suburb(suburb_snap)),
        }
        # Hosts and listings of earlier months were in their dimensions already.
        keep = (touched is not None and "gold.fact_listings" in house.commits[-1].months
                and _same_rows(house.table("gold.dim_lga"), dims["lga_dim"])
                and _same_rows(house.table("gold.dim_suburb"), dims["suburb_dim"]))
        fact = star.fact_listings(clean if keep else everything, **dims, stage=Scratch(spark, f"build-{n}"))
        house.write_monthly("gold.fact_listings", n, fact, "listing_month", False)
        written["gold.fact_listings"] = touched if keep else None
    house.commit(n, run_ts, written, whole=whole, through=through, undated=undated)
    return Warehouse(spark, root)


def mart(house: Warehouse, name: str, ordered: bool = False) -> DataFrame:
    """One mart over a build, computed when read; ``ordered`` sorts it for display."""
    if ordered:
        return marts.presented(mart(house, name), name)
    fact = house.table("gold.fact_listings")
    if name == "listing_neighbourhood":
        return marts.listing_neighbourhood(
            fact, house.table("gold.dim_lga"), house.table("gold.dim_host"))
    if name == "property_type":
        return marts.property_type(
            fact, house.table("gold.dim_listing"), house.table("gold.dim_host"))
    if name == "host_neighbourhood":
        return marts.host_neighbourhood(
            fact, house.table("gold.dim_suburb"), house.table("gold.dim_lga"))
    raise ValueError(f"no mart named {name!r}")


def table(house: Warehouse, name: str) -> DataFrame:
    """Any table, snapshot or mart of a build by its ``layer.name``.

    The gold census tables are the silver ones unchanged, so they are not stored twice.
    """
    layer, _, alias = name.partition(".")
    if layer == "mart":
        return mart(house, alias)
    if name in SNAPSHOTS:
        return house.snapshot(name)
    if layer == "gold" and alias in CENSUS:
        name = f"silver.{alias}"
    return house.table(name).drop("state") if name in STATES else house.table(name)


def register_views(house: Warehouse, prefix: str = "") -> list[str]:
    """Temp views ``<prefix><layer>_<alias>`` of everything built, for use from SQL."""
    names = [*TABLES, *SNAPSHOTS, *(f"gold.{c}" for c in CENSUS), *MARTS]
    views = []
    for name in names:
        view = prefix + name.replace(".", "_")
        table(house, name).createOrReplaceTempView(view)
        views.append(view)
    return views


def quality_report(house: Warehouse, rules=ALL_RULES) -> DataFrame:
    """The suite over a build, one row per rule."""
    used = {r.table for r in rules} | {r.parent for r in rules if r.parent}
    return quality.dq_report({t: table(house, t) for t in sorted(used)}, rules,
                             stage=Scratch(house.spark, "quality"))
