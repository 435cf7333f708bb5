"""Dimensions, key resolution, the as-of join and the fact table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import BEGINNING, OPEN_END, ntz
from ..functions.text import upper_name
from ..sources.raw import SCORES
from .history import HOST_ATTRIBUTES, LISTING_ATTRIBUTES

# The Unknown member of each dimension.
UNKNOWN_HOST = {"host_id": 0, "host_name": "Unknown", "host_neighbourhood": "UNKNOWN"}
UNKNOWN_LISTING = {"listing_id": 0, "property_type": "Unknown", "room_type": "Unknown",
                   "listing_neighbourhood": "Unknown"}
UNKNOWN_LGA = {"lga_code": "0", "lga_name": "Unknown", "lga_name_upper": "UNKNOWN"}
UNKNOWN_SUBURB = {"suburb_name": "UNKNOWN", "lga_name": "UNKNOWN"}


#: Facts of one key that one task sorts, about.
PART_ROWS = 4_000_000


# ---- dimensions ---------------------------------------------------------------------


def build_dimension(snapshot: DataFrame, key: str, attributes: Sequence[str],
                    unknown: dict[str, object]) -> DataFrame:
    """All versions of a snapshot plus an Unknown member.

    The first version of each key is back-dated, so facts older than the first run still
    find it.  Attributes that ``unknown`` does not name are NULL in that member.
    """
    columns = [key, *attributes, "valid_from", "valid_to"]
    first = F.min("valid_from").over(Window.partitionBy(key))
    versions = snapshot.select(
        key, *attributes,
        F.when(F.col("valid_from") == first, ntz(BEGINNING))
        .otherwise(F.col("valid_from")).alias("valid_from"),
        "valid_to",
    )
    types = dict(versions.dtypes)
    member = versions.sparkSession.range(1).select(*[
        (ntz(BEGINNING) if c == "valid_from" else F.lit(unknown.get(c)).cast(types[c])).alias(c)
        for c in columns
    ])
    return member.unionByName(versions)


def dim_host(snapshot: DataFrame) -> DataFrame:
    return build_dimension(snapshot, "host_id", HOST_ATTRIBUTES, UNKNOWN_HOST)


def dim_listing(snapshot: DataFrame) -> DataFrame:
    return build_dimension(snapshot, "listing_id", LISTING_ATTRIBUTES, UNKNOWN_LISTING)


def dim_lga(snapshot: DataFrame) -> DataFrame:
    return build_dimension(snapshot, "lga_code", ("lga_name", "lga_name_upper"), UNKNOWN_LGA)


def dim_suburb(snapshot: DataFrame) -> DataFrame:
    return build_dimension(snapshot, "suburb_name", ("lga_name",), UNKNOWN_SUBURB)


# ---- joins --------------------------------------------------------------------------


def asof_join(facts: DataFrame, versions: DataFrame, fact_key: Column, version_key: str,
              at: str, carry: dict[str, str]) -> DataFrame:
    """``facts`` with columns of the version of ``fact_key`` valid on date ``at``.

    Left outer; ``valid_from <= at < valid_to``.  ``carry`` names the version columns to
    bring along and what to call them.  There is always an equality on the key, so the
    range is only a residual test inside a hash or merge join.

    No hint: Spark broadcasts versions below its byte threshold.  Otherwise both sides are
    shuffled on the key; a hot fact key is then split by Spark's adaptive skew join (it may
    split the left side of a left join), as long as the caller does not need the rows to stay
    grouped by key.
    """
    right = versions.select(
        F.col(version_key).alias("_key"), F.col("valid_from").alias("_from"),
        F.coalesce("valid_to", ntz(OPEN_END)).alias("_to"),
        *[F.col(c).alias(name) for c, name in carry.items()],
    )
    day = F.col(at).cast("timestamp_ntz")
    hit = (fact_key == F.col("_key")) & (day >= F.col("_from")) & (day < F.col("_to"))
    return facts.join(right, hit, "left").drop("_key", "_from", "_to")


def hot_keys(facts: DataFrame, key: Column, part_rows: int = PART_ROWS) -> DataFrame:
    """(key, parts) of keys with more than ``part_rows`` facts: in how many parts to deal them.

    There are fewer of these than ``part_rows`` goes into the number of facts.  Counting combines
    in the map tasks, so no fact row is shuffled.
    """
    n = F.count(F.lit(1))
    return (facts.where(key.isNotNull()).groupBy(key.alias("_hot")).agg(n.alias("n")).where(F.col("n") > part_rows)
            .select("_hot", F.ceil(F.col("n") / part_rows).cast("int").alias("_parts")))


def asof_carry(facts: DataFrame, versions: DataFrame, fact_key: Column, version_key: str, at: str,
               carry: dict[str, str], hot: DataFrame | None = None) -> DataFrame:
    """The result of :func:`asof_join` by carrying the last version forward in time.

    Facts and versions are put together, sorted once by key and time, and a window carries the
    latest version on to the facts after it.  So the work on a key grows with its facts plus
    its versions, not with their product as where a join tests the range of every version.

    ``hot`` (see :func:`hot_keys`; best stored, so that Spark knows its size) deals the facts
    of a hot key to several parts, each with all versions of the key.  Versions of a key must
    not overlap; of several that start together the one that ends last counts.  A fact without
    key or date has no version and is not sorted.
    """
    names = list(carry.values())
    day = F.col(at).cast("timestamp_ntz")
    version = F.struct(*[F.col(c).alias(n) for c, n in carry.items()])
    rows = facts.select(F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_fact"), fact_key.alias("_key"),
                        day.alias("_time"))
    usable = F.col("_key").isNotNull() & F.col("_time").isNotNull()
    lone, rows = rows.where(~usable), rows.where(usable)
    known = versions.select(F.col(version_key).alias("_key"), F.col("valid_from").alias("_time"),
                            F.coalesce("valid_to", ntz(OPEN_END)).alias("_to"), version.alias("_version"))
    one = F.lit(0)
    if hot is not None:
        many = F.coalesce("_parts", F.lit(1))
        rows = (rows.join(hot, F.col("_key") == F.col("_hot"), "left")
                .withColumn("_part", F.pmod(F.xxhash64("_fact"), many).cast("int")).drop("_hot", "_parts"))
        known = (known.join(hot, F.col("_key") == F.col("_hot"), "left")
                 .withColumn("_part", F.explode(F.sequence(F.lit(0), many - 1))).drop("_hot", "_parts"))
    else:
        rows, known = rows.withColumn("_part", one), known.withColumn("_part", one)
    both = known.unionByName(rows, allowMissingColumns=True)
    # A version that starts on the day of a fact comes before it.
    in_time = (Window.partitionBy("_key", "_part").orderBy("_time", F.col("_fact").isNotNull(), "_to")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    started = F.when(F.col("_fact").isNull(), F.struct("_to", "_version"))
    met = both.withColumn("_last", F.last(started, ignorenulls=True).over(in_time)).where(F.col("_fact").isNotNull())
    valid = F.col("_time") < F.col("_last._to")
    kinds = {n: versions.schema[c].dataType for c, n in carry.items()}
    own = [F.col("_fact").getField(c).alias(c) for c in facts.columns]
    return (met.select(*own, *[F.when(valid, F.col("_last._version").getField(n)).alias(n) for n in names])
            .unionByName(lone.select(*own, *[F.lit(None).cast(kinds[n]).alias(n) for n in names])))


def resolve_key(facts: DataFrame, key: str, members: DataFrame, unknown: object,
                stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Replace keys that are no member, and NULL, by ``unknown``.

    ``members`` is a frame whose column of the same name holds the valid keys.  Without
    ``stage`` the result is a lazy join whose form Spark picks by size.

    A build gives ``stage``, which stores a frame and reads it back.  Then the fact rows are
    not shuffled to the members, however many: only the distinct fact keys are (hot keys
    shrink to one row per task), to store the keys that are *not* members.  These are
    usually none or few, and as stored files Spark knows their bytes and broadcasts them.
    """
    value = F.col(key)
    valid = members.select(F.col(key).alias("_member")).distinct()
    if stage is None:
        found = facts.join(valid, value == F.col("_member"), "left")
        return found.withColumn(key, F.coalesce("_member", F.lit(unknown))).drop("_member")

    keys = facts.select(value.alias("_absent")).where(value.isNotNull()).distinct()
    absent = stage(keys.join(valid, F.col("_absent") == F.col("_member"), "left_anti"),
                   f"absent_{key}")
    known = F.coalesce(value, F.lit(unknown))
    marked = facts.join(absent, value == F.col("_absent"), "left")
    return marked.withColumn(
        key, F.when(F.col("_absent").isNull(), known).otherwise(F.lit(unknown))).drop("_absent")


# ---- fact ---------------------------------------------------------------------------


def fact_listings(listings: DataFrame, listing_dim: DataFrame, host_dim: DataFrame,
                  lga_dim: DataFrame, suburb_dim: DataFrame,
                  stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """One row per silver listing: dimension keys, dates and metrics.

    With small dimensions this is a narrow job over the listings.  Suburbs and LGAs are
    joined as they are; ``stage`` is for listings and hosts, which grow with the rows.
    """
    rows = listings.select(
        "listing_row_id", "listing_id", "host_id", "listing_neighbourhood",
        F.col("host_neighbourhood").alias("suburb_name"), "scraped_date", "listing_month",
        F.when(F.col("has_availability"), 1).otherwise(0).alias("is_active"),
        "price", "availability_30", "number_of_reviews", *SCORES,
    )
    rows = resolve_key(rows, "listing_id", listing_dim, 0, stage)
    rows = resolve_key(rows, "host_id", host_dim, 0, stage)
    rows = resolve_key(rows, "suburb_name", suburb_dim, UNKNOWN_SUBURB["suburb_name"])
    real_lgas = lga_dim.where(F.col("lga_code") != UNKNOWN_LGA["lga_code"])
    rows = asof_join(rows, real_lgas, upper_name(F.col("listing_neighbourhood")),
                     "lga_name_upper", "scraped_date", {"lga_code": "found_lga"})
    return rows.select(
        "listing_row_id", "listing_id", "host_id",
        F.coalesce("found_lga", F.lit(UNKNOWN_LGA["lga_code"])).alias("listing_lga_code"),
        F.col("suburb_name").alias("host_suburb"),
        "scraped_date", "listing_month", "is_active",
        "price", "availability_30", "number_of_reviews", *SCORES,
    )
