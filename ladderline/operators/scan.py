"""Running values of a key over many tasks: numbers, maxima and last values across segments.

A window by key is one task for each key. Here a key is cut into segments that follow each other
in its order, each is scanned by itself, and what the segments before it hold (a count, a maximum,
a last value: a row a segment) is added. A segment is an interval of the first column of the
order, so it needs no statistics: ``SEGMENT`` dense positions, or ``SPAN_US`` of time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions (lines, messages) and microseconds in a segment.
SEGMENT, SPAN_US = 1_000_000, 3_600_000_000


def by_position(c: str) -> Column:
    return F.expr(f"CAST({c} div {SEGMENT} AS BIGINT)")


def by_time(c: str) -> Column:
    return F.expr(f"CAST(floor({c} / {SPAN_US}) AS BIGINT)")


def _with_carry(rows: DataFrame, by: str, carry: DataFrame) -> DataFrame:
    # Null keys and null times are values here, so the join is null-safe on both.
    both = [rows[by].eqNullSafe(carry["_by"]), rows["_seg"].eqNullSafe(carry["_in"])]
    return rows.join(carry, both[0] & both[1], "left").drop("_by", "_in")


def _before(by: str) -> Window:
    return Window.partitionBy(by).orderBy(F.col("_seg").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)


def numbered(df: DataFrame, by: str, order: list[Column], segment: Column, out: str) -> DataFrame:
    """``out``: position of each row of a key, from 0."""
    rows = df.withColumn("_seg", segment)
    own = F.row_number().over(Window.partitionBy(by, "_seg").orderBy(*order))
    sizes = rows.groupBy(by, "_seg").agg(F.count(F.lit(1)).alias("_n"))
    carry = sizes.select(F.col(by).alias("_by"), F.col("_seg").alias("_in"), F.coalesce(F.sum("_n").over(_before(by)), F.lit(0)).alias("_past"))
    got = _with_carry(rows.withColumn("_own", own), by, carry)
    return got.withColumn(out, (F.col("_past") + F.col("_own") - 1).cast("bigint")).drop("_seg", "_own", "_past")


def running_max(df: DataFrame, by: str, order: str, segment: Column, value: Column, out: str) -> DataFrame:
    """``out``: the largest value so far, rows of equal order included; null values don't count."""
    rows = df.withColumns({"_seg": segment, "_v": value})
    own = F.max("_v").over(Window.partitionBy(by, "_seg").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    most = rows.groupBy(by, "_seg").agg(F.max("_v").alias("_m"))
    carry = most.select(F.col(by).alias("_by"), F.col("_seg").alias("_in"), F.max("_m").over(_before(by)).alias("_past"))
    return _with_carry(rows.withColumn("_own", own), by, carry).withColumn(out, F.greatest("_own", "_past")).drop("_seg", "_v", "_own", "_past")


def last_value(df: DataFrame, by: str, order: tuple[str, ...], segment: Column, value: str, out: str) -> DataFrame:
    """``out``: the last value so far that isn't null, the row's own included. Order columns without
    nulls, or whose nulls come first."""
    rows = df.withColumn("_seg", segment)
    own = F.last(value, ignorenulls=True).over(Window.partitionBy(by, "_seg").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Only rows with a value are ordered; a segment without any carries on what came before.
    last = rows.groupBy(by, "_seg").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_m"))
    carry = last.select(F.col(by).alias("_by"), F.col("_seg").alias("_in"), F.last("_m", ignorenulls=True).over(_before(by)).alias("_past"))
    return _with_carry(rows.withColumn("_own", own), by, carry).withColumn(out, F.coalesce("_own", "_past")).drop("_seg", "_own", "_past")
