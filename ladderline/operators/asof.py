"""As-of joins by union and a running last value: one sort per segment of time, no range join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scan


def asof_backward(left: DataFrame, right: DataFrame, by: str, left_ts: str, right_ts: str, right_order: str, take: list[str], segment: Column | None = None) -> DataFrame:
    """Left rows with the columns of the last right row at or before them (null if there is none).

    Right rows of equal time count in the order of ``right_order``, the last one wins. ``segment``
    cuts time (the column ``_ts``), by hours of microseconds if it isn't given.
    """
    cols = left.columns
    l = left.select(F.col(by), F.col(left_ts).alias("_ts"), F.lit(1).alias("_lane"), F.lit(None).cast("bigint").alias("_o"), F.struct(*cols).alias("_l"))
    r = right.select(F.col(by), F.col(right_ts).alias("_ts"), F.lit(0).alias("_lane"), F.col(right_order).cast("bigint").alias("_o"), F.struct(*take).alias("_r"))
    both = scan.last_value(l.unionByName(r, allowMissingColumns=True), by, ("_ts", "_lane", "_o"), scan.by_time("_ts") if segment is None else segment, "_r", "_found")
    return both.where("_lane = 1").select("_l.*", *[F.col(f"_found.{c}").alias(c) for c in take])


def events_with_top(book_events: DataFrame, top: DataFrame) -> DataFrame:
    return book_events.join(top.select("ticker", "event_idx", "yes_bid_micro", "yes_ask_micro", "mid_micro"), ["ticker", "event_idx"])
