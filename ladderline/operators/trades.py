"""Trade tape, effective time, and merging of stream and fetched copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.units import contracts, dollars

#: Order of trades inside the merged stream: time, rows with seq first, seq, file position.
KEY = ("eff_ts_us", "seq_class", "seq", "file_row")


def tape(trades: DataFrame) -> DataFrame:
    return trades.select(
        "ticker", "file_row", "recv_ts_us", "event_ts_us", "seq", "price_micro", "count_centi",
        dollars(F.col("price_micro")).alias("yes_price"), contracts(F.col("count_centi")).alias("count"), "taker_side", "taker_book_side", "trade_id",
    )


def with_effective(trades: DataFrame) -> DataFrame:
    """Stream rows happen when received, fetched rows (without seq) when executed."""
    ws = F.col("seq").isNotNull()
    return (
        trades.withColumn("eff_ts_us", F.when(ws, F.col("recv_ts_us")).otherwise(F.col("event_ts_us")))
        .withColumn("seq_class", F.when(ws, 0).otherwise(1))
        .withColumn("source", F.when(ws, "ws").otherwise("rest_backfill"))
    )


def dedup(trades: DataFrame) -> DataFrame:
    """One row per trade_id; rows without one are all kept.

    The position (time, seq, file_row, source) is that of the first stream copy, else the first
    copy; the figures are those of the first fetched copy, else of the position row;
    taker_book_side is taken from the position row where the fetched copy has none. Copies are
    folded by aggregation: no sort, and what is shuffled is one partial row per id and task.
    """
    t = with_effective(trades)
    key = F.struct(F.col("seq_class") != 0, *KEY)
    row = F.struct("eff_ts_us", "recv_ts_us", "event_ts_us", "seq", "seq_class", "file_row", "source", "price_micro", "count_centi", "taker_side", "taker_book_side")
    rest = F.col("seq_class") == 1
    many = t.where("trade_id IS NOT NULL").groupBy("ticker", "trade_id").agg(
        F.min_by(row, key).alias("p"), F.min_by(row, F.when(rest, F.struct(*KEY))).alias("r"), F.count(F.lit(1)).alias("copies")
    )
    f = lambda c: F.when(F.col("r").isNotNull(), F.col(f"r.{c}")).otherwise(F.col(f"p.{c}")).alias(c)
    many = many.select(
        "ticker", "trade_id", "p.eff_ts_us", "p.recv_ts_us", F.col("p.event_ts_us").alias("event_ts_us"), "p.seq", "p.seq_class", "p.file_row", "p.source",
        f("price_micro"), f("count_centi"), f("taker_side"), F.coalesce("r.taker_book_side", "p.taker_book_side").alias("taker_book_side"), "copies",
    )
    alone = t.where("trade_id IS NULL").withColumn("copies", F.lit(1).cast("bigint"))
    return many.unionByName(alone.select(many.columns))


def top_trades(trades: DataFrame, n: int = 10) -> DataFrame:
    return trades.orderBy(F.desc("count_centi"), "ticker", "file_row").limit(n).select("ticker", "file_row", "price_micro", "count_centi", "trade_id")


def taker_pressure(trades: DataFrame) -> DataFrame:
    return trades.groupBy("ticker", "taker_side").agg(F.sum("count_centi").alias("count_centi"), F.count(F.lit(1)).alias("n"))


def order_key(source: str = "ticker") -> Window:
    return Window.partitionBy(source).orderBy(*[F.col(c).asc_nulls_last() for c in KEY])
