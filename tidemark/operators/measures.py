"""Stay and revenue measures, exact median, month-over-month change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import ratio

NIGHTS = 30  # Fixed value: the window that availability_30 counts over.


def is_active() -> Column:
    return F.col("is_active") == 1


def stays() -> Column:
    """Booked nights of an active listing; NULL when inactive."""
    return F.when(is_active(), F.lit(NIGHTS) - F.col("availability_30"))


def revenue() -> Column:
    return stays() * F.col("price")


def leading_digits(value: Column, kind: T.DataType) -> Column:
    """A number without its digits after the third significant one, as a whole number of the
    last place that ``kind`` has.  It never falls as the value rises."""
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        whole = (value * F.lit(10 ** kind.scale)).cast("decimal(18,0)").cast("long")
    elif isinstance(kind, T.IntegralType):
        whole = value.cast("long")
    else:
        raise TypeError(f"exact_median takes whole numbers and decimals of up to 18 digits, not {kind}")
    digits = F.length(F.abs(whole).cast("string"))
    unit = F.element_at(F.array(*[F.lit(10 ** max(0, n - 3)).cast("long") for n in range(1, 20)]), digits)
    return whole - whole % unit


def exact_median(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Interpolated 0.5 percentile of a decimal column per group, to two places.

    Rows are counted per distinct value, combining inside each map task, and these counts again
    per leading digits of the value: a few thousand buckets a group at most, whatever the number
    of rows or values.  A window over the buckets brackets the middle ranks, and only values of
    the one or two buckets that hold them are ranked.  So no task walks a whole group.
    """
    counts = (rows.where(F.col(value).isNotNull()).groupBy(*keys, value)
              .agg(F.count(F.lit(1)).alias("n"))
              .withColumn("_bucket", leading_digits(F.col(value), rows.schema[value].dataType)))
    group = Window.partitionBy(*keys)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    buckets = counts.groupBy(*keys, "_bucket").agg(F.sum("n").alias("held"))
    ranked = (buckets.withColumn("upto", F.sum("held").over(group.orderBy("_bucket").rowsBetween(*so_far)))
              .withColumn("total", F.sum("held").over(group)))
    # The middle rows are number floor((total+1)/2) and floor(total/2)+1, counted from one.
    bracket = (ranked.withColumn("low", F.floor((F.col("total") + 1) / 2))
               .withColumn("high", F.floor(F.col("total") / 2) + 1)
               .where((F.col("upto") >= F.col("low")) & (F.col("upto") - F.col("held") < F.col("high")))
               .select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.col("_bucket").alias("_b"),
                       (F.col("upto") - F.col("held")).alias("before"), "low", "high"))
    same = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys] + [F.col("_bucket") == F.col("_b")]
    near = counts.join(bracket, same)
    upto = F.col("before") + F.sum("n").over(
        Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(*so_far))
    middle = (near.withColumn("upto", upto)
              .where((F.col("upto") >= F.col("low")) & (F.col("upto") - F.col("n") < F.col("high"))))
    return middle.groupBy(*keys).agg(
        ratio(F.min(value) + F.max(value), F.lit(2)).alias(name))


def mom_change(df: DataFrame, group: Sequence[str], month: str,
               columns: dict[str, str]) -> DataFrame:
    """Percent change against the month before, for each ``column -> result name``.

    NULL when the previous row is not exactly one month earlier, or is 0.
    """
    w = Window.partitionBy(*group).orderBy(F.col(month).asc_nulls_last())
    follows = F.lag(month).over(w) == F.add_months(month, -1)
    df = df.withColumns({f"_prev_{c}": F.when(follows, F.lag(c).over(w)) for c in columns})
    for c, name in columns.items():
        before = F.col(f"_prev_{c}")
        df = df.withColumn(name, ratio(F.col(c) - before, before, 100))
    return df.drop(*[f"_prev_{c}" for c in columns])
