"""The merged event stream: gaps, book messages and trades of a ticker in one total order.

Order: effective time, rows with seq first, seq, lane (gap, book, trade), event_idx, file_row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scan
from .book import book_at
from .trades import dedup

KEY = ("ts", "seq_class", "seq", "lane", "event_idx", "file_row")
LEVELS = "array<struct<side:string,price_micro:bigint,qty_centi:bigint>>"
_NULL = {
    "kind": "string", "source": "string", "side": "string", "price_micro": "bigint", "qty_centi": "bigint",
    "n_levels": "bigint", "levels": LEVELS, "trade_id": "string", "taker_book_side": "string", "reason": "string", "detail": "string", "event_idx": "bigint",
}
_COLS = ("ticker", *KEY, "kind", "source", "side", "price_micro", "qty_centi", "n_levels", "levels", "trade_id", "taker_book_side", "reason", "detail")


def _lane(df: DataFrame, lane: int, **cols: Column) -> DataFrame:
    df = df.withColumns({**cols, "lane": F.lit(lane), "seq_class": F.when(F.col("seq").isNull(), 1).otherwise(0)})
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(_NULL[c]).alias(c) for c in _COLS])


def _ladder(*order: Column) -> Column:
    """The levels of a group of rows, as an array in that order; rows without side count for none."""
    row = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)], "side", "price_micro", "qty_centi")
    rows = F.array_sort(F.collect_list(F.when(F.col("side").isNotNull(), row)))
    return F.transform(rows, lambda x: F.struct(x["side"].alias("side"), x["price_micro"].alias("price_micro"), x["qty_centi"].alias("qty_centi")))


def levels_text(levels: Column) -> Column:
    """side:price:quantity of each level, separated by commas."""
    return F.array_join(F.transform(levels, lambda x: F.concat_ws(":", x["side"], x["price_micro"].cast("string"), x["qty_centi"].cast("string"))), ",")


def book_lane(book_events: DataFrame) -> DataFrame:
    """One row per message; a snapshot's key is that of its first row, and it carries its levels."""
    head = F.struct(F.col("recv_ts_us").alias("ts"), "seq", "file_row", "is_snapshot", "side", "price_micro", "qty_centi")
    g = book_events.groupBy("ticker", "event_idx").agg(F.min_by(head, "file_row").alias("f"), _ladder(F.col("file_row")).alias("_all"))
    snap = F.col("f.is_snapshot")
    pick = lambda c: F.when(~snap, F.col(f"f.{c}")).alias(c)
    g = g.select(
        "ticker", "event_idx", "f.ts", "f.seq", "f.file_row", F.when(snap, "snapshot").otherwise("delta").alias("kind"),
        pick("side"), pick("price_micro"), pick("qty_centi"),
        F.when(snap, F.size("_all").cast("bigint")).alias("n_levels"), F.when(snap, F.col("_all")).alias("levels"),
    )
    return _lane(g, 1)


def gap_lane(gaps: DataFrame) -> DataFrame:
    return _lane(gaps.select("ticker", F.col("recv_ts_us").alias("ts"), "seq", "file_row", "reason", "detail"), 0, kind=F.lit("gap"), event_idx=F.lit(0).cast("bigint"))


def trade_lane(trades: DataFrame) -> DataFrame:
    t = dedup(trades).select("ticker", F.col("eff_ts_us").alias("ts"), "seq", "file_row", "source", F.col("taker_side").alias("side"), "price_micro", F.col("count_centi").alias("qty_centi"), "trade_id", "taker_book_side")
    return _lane(t, 2, kind=F.lit("trade"), event_idx=F.lit(0).cast("bigint"))


def _order() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in KEY]


def merged(book_events: DataFrame, trades: DataFrame, gaps: DataFrame) -> DataFrame:
    """All events with their position in the ticker's stream (``pos``, from 0)."""
    return _placed(gap_lane(gaps).unionByName(book_lane(book_events)).unionByName(trade_lane(trades)))


def _placed(lanes: DataFrame) -> DataFrame:
    return scan.numbered(lanes, "ticker", _order(), scan.by_time("ts"), "pos")


def order_violations(book_events: DataFrame, gaps: DataFrame) -> DataFrame:
    """Rows of the book or gap lane whose key is below that of the row before in file order.
    (Trades are sorted when merged, so they can't violate it.)"""
    lanes = gap_lane(gaps).unionByName(book_lane(book_events))
    key = F.struct("ts", "seq_class", F.coalesce("seq", F.lit(0)).alias("seq"), "lane", "event_idx", "file_row")
    w = Window.partitionBy("ticker", "lane").orderBy("file_row")
    return lanes.withColumn("_k", key).withColumn("_p", F.lag("_k").over(w)).where("_k < _p").select("ticker", "lane", "file_row", "ts", F.col("_p.ts").alias("prev_ts"))


def pending_gaps(stream: DataFrame, t0_us: int) -> DataFrame:
    """Gaps before t0 that no later snapshot before t0 has settled: the book is suspect."""
    before = stream.where(F.col("ts") < t0_us)
    last = before.where("kind = 'snapshot'").groupBy("ticker").agg(F.max("pos").alias("_snap"))
    return before.where("kind = 'gap'").join(last, "ticker", "left").where("_snap IS NULL OR pos > _snap").drop("_snap")


def between(book_events: DataFrame, trades: DataFrame, gaps: DataFrame, t0_us: int, t1_us: int) -> DataFrame:
    """Replay of [t0, t1): pending gaps (lead 0), the book at t0 as a snapshot with event_idx -1
    (lead 1, the only row that is ``synthetic``), then the events (lead 2), in the order (lead, pos).

    Of the time before t0 only what follows a ticker's last snapshot is put in order, and pos
    counts from there.
    """
    if t0_us >= t1_us:
        raise ValueError("a range needs t0 < t1")
    # Trades count by effective time, which for fetched ones is their event time: the bound
    # on receive times holds for the other tables only.
    soon = F.col("recv_ts_us") < t1_us
    books, holes, deals = book_events.where(soon), gaps.where(soon), trade_lane(trades).where(F.col("ts") < t1_us)
    tickers = books.select("ticker").unionByName(holes.select("ticker")).unionByName(deals.select("ticker")).distinct()
    last = books.where((F.col("recv_ts_us") < t0_us) & F.col("is_snapshot")).groupBy("ticker").agg(F.max("event_idx").alias("_idx"), F.max_by("recv_ts_us", "event_idx").alias("_ts"))
    books = books.join(last, "ticker", "left").where("_idx IS NULL OR event_idx >= _idx").drop("_idx", "_ts")
    holes = holes.join(last, "ticker", "left").where("_ts IS NULL OR recv_ts_us >= _ts").drop("_idx", "_ts")
    stream = _placed(gap_lane(holes).unionByName(book_lane(books)).unionByName(deals.where(F.col("ts") >= t0_us)))
    # yes before no, each by price
    open_ = book_at(book_events, t0_us).groupBy("ticker").agg(_ladder(F.col("side") == "no", F.col("price_micro")).alias("levels"))
    snap = tickers.join(open_, "ticker", "left").select(
        "ticker", F.lit(1).alias("lead"), F.lit(-1).cast("bigint").alias("pos"), F.lit(t0_us).cast("bigint").alias("ts"),
        F.lit("snapshot").alias("kind"), F.lit(-1).cast("bigint").alias("event_idx"), F.coalesce("levels", F.array().cast(LEVELS)).alias("levels"),
    ).withColumn("n_levels", F.size("levels").cast("bigint"))
    rows = pending_gaps(stream, t0_us).withColumn("lead", F.lit(0)).unionByName(stream.where(F.col("ts") >= t0_us).withColumn("lead", F.lit(2)))
    return rows.unionByName(snap, allowMissingColumns=True).select(
        "ticker", "lead", "pos", "ts", "kind", "source", "event_idx", "side", "price_micro", "qty_centi", "n_levels", "levels", "trade_id",
        "taker_book_side", "reason", "detail", (F.col("lead") == 1).alias("synthetic"),
    )
