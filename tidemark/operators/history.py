"""Monthly rows of an entity: collapse, version numbering, latest version, full history.

Only the first step sees raw rows, and it is an aggregation.  For hosts it runs inside each
map task first (at the price of a local sort: ``min`` of a struct is no hash aggregation), so
a host with a third of all rows is one row per month and task before anything is shuffled.
The windows that follow hold at most one row per month of an entity.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST_ATTRIBUTES = ("host_name", "host_since", "host_is_superhost", "host_neighbourhood")
LISTING_ATTRIBUTES = ("property_type", "room_type", "accommodates", "listing_neighbourhood")


def _nulls_last(columns: Sequence[str]) -> list[Column]:
    """Struct fields that sort ascending with NULL last (a struct sorts NULL first)."""
    fields = []
    for c in columns:
        fields += [F.col(c).isNull().alias(f"_{c}_null"), F.col(c).alias(f"_{c}_order")]
    return fields


def monthly_rows(rows: DataFrame, key: str, month: str, date: str, order: Sequence[str],
                 attributes: Sequence[str], empty: Column | None = None) -> DataFrame:
    """One row per (key, month): ``first_date``, and ``best``, its first row by ``order`` that is
    not ``empty``, with ``best.is_gap`` where all are.  Combined inside each map task."""
    gap = F.lit(False) if empty is None else empty
    best = F.struct(gap.alias("is_gap"), *_nulls_last(order), *attributes)
    return (rows.where(F.col(key).isNotNull())
            .groupBy(key, month)
            .agg(F.min(date).alias("first_date"), F.min(best).alias("best")))


def monthly_collapse(rows: DataFrame, key: str, month: str, date: str, order: Sequence[str],
                     attributes: Sequence[str], empty: Column | None = None) -> DataFrame:
    """One row per (key, month): the attributes of its first row by ``order``.

    ``first_date`` is the smallest ``date`` over all rows of the month.  Rows that are
    ``empty`` (scrape gaps) only count for that date, unless every row of the key is empty.
    Rows equal on ``order`` are settled by their attribute values, so reruns agree.

    An all-empty month is one whose best row is empty, since empty rows sort last; so one
    ``min`` of a struct gives both the row and the flag, without joining rows to flags.
    """
    monthly = monthly_rows(rows, key, month, date, order, attributes, empty)
    if empty is not None:
        monthly = _without_gaps(monthly, key, month)
    return monthly.select(key, month, "first_date",
                          *[F.col(f"best.{a}").alias(a) for a in attributes])


def _without_gaps(monthly: DataFrame, key: str, month: str) -> DataFrame:
    """Without all-empty months, unless a key has no others.

    Ordered by month although a minimum needs no order: number_versions then finds the rows
    sorted as it wants them.
    """
    whole = (Window.partitionBy(key).orderBy(F.col(month).asc_nulls_last())
             .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    always = F.min(F.col("best.is_gap")).over(whole)
    return (monthly.withColumn("always_gap", always)
            .where(~F.col("best.is_gap") | F.col("always_gap")))


def number_versions(monthly: DataFrame, key: str, month: str,
                    attributes: Sequence[str]) -> DataFrame:
    """``is_change`` against the previous kept month, and its running sum ``version_no``.

    Skipped months are no change; values that come back are a new version.
    """
    by_month = Window.partitionBy(key).orderBy(F.col(month).asc_nulls_last())
    now = F.struct(*attributes)
    changed = F.lag(month).over(by_month).isNull() | ~now.eqNullSafe(F.lag(now).over(by_month))
    return (
        monthly.withColumn("is_change", F.when(changed, 1).otherwise(0))
        .withColumn("version_no", F.sum("is_change").over(
            by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )


def latest_version(versions: DataFrame, key: str, month: str,
                   attributes: Sequence[str]) -> DataFrame:
    """One row per key: its latest month, and ``updated_at``, the first date of that version.

    The version numbers rise with the month, so the last version is a plain window maximum
    over the sort order that is already there, and the rest is one grouping on the key.
    """
    last = F.max("version_no").over(Window.partitionBy(key))
    newest = F.max(F.struct(F.col(month).isNull().alias("undated"), month, *attributes))
    return (
        versions.withColumn("last_no", last)
        .where(F.col("version_no") == F.col("last_no"))
        .groupBy(key)
        .agg(newest.alias("newest"), F.min("first_date").alias("updated_at"))
        .select(key, *[F.col(f"newest.{a}").alias(a) for a in attributes],
                F.col(f"newest.{month}").alias(month), "updated_at")
    )


def batch_history(versions: DataFrame, key: str, month: str,
                  attributes: Sequence[str]) -> DataFrame:
    """All versions of all keys in one pass, as a monthly replay of snapshots would leave them.

    ``valid_from`` is the first date of the version's first month and ``valid_to`` the
    start of the next version.  One case differs from a replay: a key whose early rows are
    all empty and later ones are not has no version for the empty months here.
    """
    by_month = Window.partitionBy(key).orderBy(F.col(month).asc_nulls_last())
    starts = versions.where(F.col("is_change") == 1)
    return starts.select(
        key, *attributes,
        F.col("first_date").cast("timestamp_ntz").alias("valid_from"),
        F.lead("first_date").over(by_month).cast("timestamp_ntz").alias("valid_to"),
    )


# ---- state that grows by the month ----------------------------------------------------


@dataclass(frozen=True)
class Entity:
    """What the history of an entity is made of (see :func:`monthly_collapse`)."""

    key: str
    order: tuple[str, ...]
    attributes: tuple[str, ...]
    empty: Column | None = None
    #: Whether raw rows are shuffled as they are: one row per key and month leaves nothing to combine.
    shuffle_rows: bool = False
    month: str = "listing_month"
    date: str = "scraped_date"


def summary(rows: DataFrame, of: Entity) -> DataFrame:
    """One row per key of a range of months: (key, is_gap, versions, first, last, month, updated_at).

    ``first`` and ``last`` are the attributes of its first and last version, ``versions`` how
    many there are, ``month`` the last month and ``updated_at`` the first date of the last
    version; ``is_gap`` tells that all rows of the key are empty.  Summaries of ranges that
    follow each other are joined by :func:`merged`, in any grouping.
    """
    if of.shuffle_rows:
        rows = rows.repartition(of.key)
    monthly = monthly_rows(rows, of.key, of.month, of.date, of.order, of.attributes, of.empty)
    if of.empty is not None:
        monthly = _without_gaps(monthly, of.key, of.month)
    monthly = monthly.select(of.key, of.month, "first_date", F.col("best.is_gap").alias("is_gap"),
                             *[F.col(f"best.{a}").alias(a) for a in of.attributes])
    versions = number_versions(monthly, of.key, of.month, of.attributes)
    held = F.struct(*of.attributes)
    undated = F.col(of.month).isNull()
    # The highest version number and the smallest date of its rows: with its bits flipped a smaller
    # date is greater, and a missing one is the smallest.
    last_start = F.max(F.struct("version_no", F.bitwise_not(F.unix_date("first_date")).alias("day")))
    return (versions.groupBy(of.key)
            .agg(F.min("is_gap").alias("is_gap"),
                 F.min(F.struct(undated, of.month, held.alias("held"))).alias("first"),
                 F.max(F.struct(undated, of.month, held.alias("held"))).alias("last"),
                 last_start.alias("started"))
            .select(of.key, "is_gap", F.col("started.version_no").cast("long").alias("versions"),
                    F.col("first.held").alias("first"), F.col("last.held").alias("last"),
                    F.col(f"last.{of.month}").alias("month"),
                    F.date_from_unix_date(F.bitwise_not(F.col("started.day"))).alias("updated_at")))


def merged(before: DataFrame, after: DataFrame, of: Entity) -> DataFrame:
    """The summary of two ranges of months of which ``after`` follows ``before``.

    A key with rows in both keeps its versions; the last one before and the first one after are
    the same if their attributes are.  Empty months count only while a key has no others.  One
    row per key and side: the one join cannot be skewed.
    """
    fields = ("is_gap", "versions", "first", "last", "month", "updated_at")
    both = (before.select(F.col(of.key).alias("_a"), F.struct(*fields).alias("a"))
            .join(after.select(F.col(of.key).alias("_b"), F.struct(*fields).alias("b")),
                  F.col("_a") == F.col("_b"), "full"))
    a, b = F.col("a"), F.col("b")
    same = a["last"].eqNullSafe(b["first"])
    together = F.struct(
        b["is_gap"].alias("is_gap"), (a["versions"] + b["versions"] - F.when(same, 1).otherwise(0)).alias("versions"),
        a["first"].alias("first"), b["last"].alias("last"), b["month"].alias("month"),
        F.when(same & (b["versions"] == 1), F.least(a["updated_at"], b["updated_at"]))
        .otherwise(b["updated_at"]).alias("updated_at"))
    kept = (F.when(b.isNull() | (b["is_gap"] & ~a["is_gap"]), a)
            .when(a.isNull() | (a["is_gap"] & ~b["is_gap"]), b).otherwise(together))
    return (both.select(F.coalesce("_a", "_b").alias(of.key), kept.alias("kept"))
            .select(of.key, *[F.col(f"kept.{f}").alias(f) for f in fields]))


def latest(state: DataFrame, of: Entity) -> DataFrame:
    """What :func:`latest_version` gives, from a summary of all months."""
    return state.select(of.key, *[F.col(f"last.{a}").alias(a) for a in of.attributes],
                        F.col("month").alias(of.month), "updated_at")


# ---- hosts and listings -------------------------------------------------------------


def no_host() -> Column:
    """A scrape gap: the host's own columns are all empty."""
    return (F.col("host_name").isNull() & F.col("host_since").isNull()
            & F.col("host_is_superhost").isNull())


def host_entity() -> Entity:
    return Entity("host_id", ("scraped_date", "listing_id"), HOST_ATTRIBUTES, no_host())


def listing_entity() -> Entity:
    return Entity("listing_id", ("scraped_date",), LISTING_ATTRIBUTES, shuffle_rows=True)


def host_monthly(listings: DataFrame) -> DataFrame:
    return monthly_collapse(listings, "host_id", "listing_month", "scraped_date",
                            ["scraped_date", "listing_id"], HOST_ATTRIBUTES, no_host())


def listing_monthly(listings: DataFrame) -> DataFrame:
    """Raw listings have about one row per listing and month, so combining before the shuffle
    would only sort them.  One shuffle on the listing serves this grouping and the windows."""
    return monthly_collapse(listings.repartition("listing_id"), "listing_id", "listing_month", "scraped_date",
                            ["scraped_date"], LISTING_ATTRIBUTES)


def host_versions(listings: DataFrame) -> DataFrame:
    return number_versions(host_monthly(listings), "host_id", "listing_month", HOST_ATTRIBUTES)


def listing_versions(listings: DataFrame) -> DataFrame:
    return number_versions(listing_monthly(listings), "listing_id", "listing_month",
                           LISTING_ATTRIBUTES)


def latest_hosts(listings: DataFrame) -> DataFrame:
    return latest_version(host_versions(listings), "host_id", "listing_month", HOST_ATTRIBUTES)


def latest_listings(listings: DataFrame) -> DataFrame:
    return latest_version(listing_versions(listings), "listing_id", "listing_month",
                          LISTING_ATTRIBUTES)


def host_history(listings: DataFrame) -> DataFrame:
    return batch_history(host_versions(listings), "host_id", "listing_month", HOST_ATTRIBUTES)


def listing_history(listings: DataFrame) -> DataFrame:
    return batch_history(listing_versions(listings), "listing_id", "listing_month",
                         LISTING_ATTRIBUTES)
