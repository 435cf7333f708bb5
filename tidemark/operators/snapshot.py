"""Slowly changing history (type 2): merge a staged table into the open versions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ntz
from ..functions.keys import version_id

VERSION_COLUMNS = ("scd_id", "scd_updated_at", "valid_from", "valid_to")


def _differs(columns: Sequence[str]) -> Column:
    old = F.struct(*[F.col(f"held.{c}").alias(c) for c in columns])
    new = F.struct(*[F.col(f"fresh.{c}").alias(c) for c in columns])
    return ~old.eqNullSafe(new)


def snapshot_delta(open_versions: DataFrame | None, staged: DataFrame, key: str, *,
                   updated_at: str | None = None, check_cols: Sequence[str] | None = None,
                   run_ts: datetime | str | None = None, changes_only: bool = False) -> DataFrame:
    """Every version that is open, opened or closed by this run, or with ``changes_only`` those
    that it opened or closed.

    A key is changed when its ``updated_at`` is later than the open ``valid_from``
    (timestamp strategy), or when any of ``check_cols`` differs from the open version
    (check strategy, stamped with ``run_ts``).  The changed version ends where the new one
    begins.  Keys missing from ``staged`` stay open.

    Both sides hold one row per key, so the only shuffle, a join on the key, cannot be
    skewed; one joined row gives its one or two result rows in place.
    """
    if (updated_at is None) == (check_cols is None):
        raise ValueError("give either updated_at or check_cols")
    if check_cols is not None and run_ts is None:
        raise ValueError("the check strategy needs run_ts: it stamps the new versions")
    stamp = F.col(updated_at).cast("timestamp_ntz") if updated_at else ntz(str(run_ts))
    columns = [*staged.columns, *VERSION_COLUMNS]
    if updated_at:
        staged = staged.withColumn(updated_at, stamp)
    fresh = staged.select("*", version_id(F.col(key), stamp).alias("scd_id"),
                          stamp.alias("scd_updated_at"), stamp.alias("valid_from"),
                          F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    if open_versions is None:
        return fresh

    joined = open_versions.select(
        F.col(key).alias("held_key"), F.struct(*columns).alias("held"),
    ).join(
        fresh.select(F.col(key).alias("fresh_key"), F.struct(*columns).alias("fresh")),
        F.col("held_key") == F.col("fresh_key"), "right" if changes_only else "full",
    )
    both = F.col("held").isNotNull() & F.col("fresh").isNotNull()
    changed = both & (F.col("held.valid_from") < F.col("fresh.valid_from") if updated_at
                      else _differs(check_cols))
    closed = F.struct(*[F.col("fresh.valid_from" if c == "valid_to" else f"held.{c}").alias(c)
                        for c in columns])
    before = F.when(changed, closed)
    if not changes_only:
        before = before.otherwise(F.col("held"))
    after = F.when(F.col("held").isNull() | changed, F.col("fresh"))
    return joined.select(F.inline(F.array_compact(F.array(before, after))))


def snapshot_merge(previous: DataFrame | None, staged: DataFrame, key: str, **how) -> DataFrame:
    """The whole history after this run: versions closed before stay as they are."""
    if previous is None:
        return snapshot_delta(None, staged, key, **how)
    is_open = F.col("valid_to").isNull()
    return previous.where(~is_open).unionByName(
        snapshot_delta(previous.where(is_open), staged, key, **how))
