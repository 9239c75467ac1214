"""Sequence numbers of a connection: verdicts on jumps, and the markers they fan out to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def verdicts(frames: DataFrame, by: tuple[str, ...] = ("sid",), order: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """accept, duplicate or gap for each frame with (kind, seq), and the seq expected before it.

    A snapshot sets the baseline, even to none. Other frames without seq are not tracked
    (verdict accept). Without baseline any seq is accepted; the next one is, the same is a
    duplicate, anything else is a gap and becomes the baseline.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    snap = F.col("kind") == "snapshot"
    era = F.sum(F.when(snap, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    f = frames.withColumn("_era", era)
    inside = Window.partitionBy(*by, "_era").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    f = f.withColumn("last_seq", F.last("seq", ignorenulls=True).over(inside))
    v = (
        F.when(snap | F.col("seq").isNull() | F.col("last_seq").isNull(), "accept")
        .when(F.col("seq") == F.col("last_seq") + 1, "accept")
        .when(F.col("seq") == F.col("last_seq"), "duplicate")
        .otherwise("gap")
    )
    return f.withColumn("verdict", v).drop("_era")


def fan_out(marks: DataFrame, tickers: DataFrame) -> DataFrame:
    """Gap markers: a seq jump marks every ticker of its connection on the frame's channel, a
    reconnect every ticker on both channels, and says nothing about numbers. ``marks`` has (sid, kind,
    channel, recv_ts_us), and last_seq and observed_seq of jumps where they are known."""
    jump = F.col("kind") != "reconnect"
    marks = marks.withColumns({c: F.when(jump, F.col(c)) for c in ("last_seq", "observed_seq") if c in marks.columns})
    chan = F.when(F.col("kind") == "reconnect", F.array(F.lit("orderbook"), F.lit("trade"))).otherwise(F.array(F.col("channel")))
    return marks.withColumn("channel", F.explode(chan)).join(tickers.select("sid", "ticker").distinct(), "sid")
