"""Book replay as window algebra.

Between two snapshots (an epoch) the quantity of a price level is a walk reflected at zero:
q_n = max(0, q_{n-1} + d_n). With S the running sum of its changes and M the running minimum
of S, q = S - least(0, M). So the history of levels needs no loop: it is windows by (ticker,
epoch, side, price). What all levels together make of a book at a moment, its best prices or its
whole ladder, comes from one fold over the changes (``fold``). Numbers and epochs run across
segments of a ticker (``scan``), so that one ticker may hold most events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.units import complement, dollars, imbalance, mid, spread
from . import fold, scan


def number_events(messages: DataFrame, order: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """event_idx: 0-based position among the snapshot and delta messages of a ticker."""
    m = messages.where("kind IN ('snapshot', 'delta')")
    return scan.numbered(m, "ticker", [F.col(c) for c in order], scan.by_position(order[0]), "event_idx")


_EVENT = ("ticker", "event_idx", "recv_ts_us", "event_ts_us", "seq", "sid")


def flatten(numbered: DataFrame) -> DataFrame:
    """book_events: a row per snapshot level (yes, then no) or delta; an empty snapshot leaves a
    row without side, price and quantity. ``file_row`` keeps the order inside a ticker."""
    side = lambda s: f"transform(coalesce({s}, array()), l -> named_struct('side', '{s}', 'price_micro', l.price, 'qty_centi', l.quantity))"
    levels = F.expr(f"CASE WHEN kind = 'snapshot' THEN concat({side('yes')}, {side('no')}) ELSE array(named_struct('side', side, 'price_micro', price_micro, 'qty_centi', delta_centi)) END")
    rows = numbered.select(*_EVENT, (F.col("kind") == "snapshot").alias("is_snapshot"), F.posexplode_outer(levels).alias("pos", "level"))
    rows = scan.numbered(rows, "ticker", [F.col("event_idx"), F.col("pos")], scan.by_position("event_idx"), "file_row")
    return rows.select(*_EVENT, "is_snapshot", "level.side", "level.price_micro", "level.qty_centi", "file_row")


def with_epoch(book_events: DataFrame) -> DataFrame:
    """epoch: event_idx of the last snapshot at or before the row, -1 before any."""
    at = F.when(F.col("is_snapshot"), F.col("event_idx"))
    e = scan.running_max(book_events, "ticker", "event_idx", scan.by_position("event_idx"), at, "epoch")
    return e.withColumn("epoch", F.coalesce("epoch", F.lit(-1)))


def replay_levels(book_events: DataFrame) -> DataFrame:
    """One row per change of a level: its quantity after it (``qty_after``), before it, and the
    event_idx at which the level next changes in the epoch (null: it doesn't). ``last_idx`` is
    the last message of the epoch.

    Of a price that repeats inside a snapshot the last row counts. A row is live while
    qty_after > 0, or from a snapshot, until the next change.
    """
    e = with_epoch(book_events)
    # Before rows without side go: an empty message still belongs to its epoch.
    e = e.withColumn("last_idx", F.max("event_idx").over(Window.partitionBy("ticker", "epoch"))).where("side IS NOT NULL")
    level = Window.partitionBy("ticker", "epoch", "side", "price_micro")
    rows = level.orderBy("event_idx", "file_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.lead("event_idx").over(level.orderBy("event_idx", "file_row"))
    e = e.withColumn("_next", last).where("NOT is_snapshot OR _next IS NULL OR _next <> event_idx").drop("_next")
    e = e.withColumn("_s", F.sum("qty_centi").over(rows))
    e = e.withColumn("qty_after", (F.col("_s") - F.least(F.lit(0), F.min("_s").over(rows))).cast("bigint"))
    w = level.orderBy("event_idx", "file_row")
    return e.select(
        "ticker", "epoch", "event_idx", "recv_ts_us", "is_snapshot", "side", "price_micro", "qty_centi",
        F.coalesce(F.lag("qty_after").over(w), F.lit(0)).cast("bigint").alias("qty_before"),
        "qty_after",
        F.lead("event_idx").over(w).alias("next_idx"), "last_idx",
    )


def underflows(levels: DataFrame) -> DataFrame:
    """Deltas that would take a level below zero, with the count of them so far in the ticker."""
    w = Window.partitionBy("ticker").orderBy("event_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bad = levels.where("NOT is_snapshot AND qty_before + qty_centi < 0")
    return bad.select("ticker", "event_idx", "side", "price_micro", "qty_before", "qty_centi", F.count(F.lit(1)).over(w).alias("underflows"))


def book_top(book_events: DataFrame) -> DataFrame:
    """Best prices, sizes, totals and level counts after every message; sizes are 0 on an empty side."""
    return top_rows(fold.best_levels(book_events))


def top_rows(t: DataFrame, *more: str) -> DataFrame:
    """The columns of book_top from those of the best levels: yb, ybs, nb, nbs (best prices and
    their sizes), yt, nt (totals), yl, nl (numbers of levels); null on an empty side. ``more``
    names columns to keep."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    t = t.select(
        "ticker", "event_idx", "recv_ts_us", "event_ts_us", "seq", "event",
        F.col("yb").alias("yes_bid_micro"), zero("ybs").alias("yes_bid_sz_centi"),
        F.when(F.col("nb").isNotNull(), complement(F.col("nb"))).alias("yes_ask_micro"), zero("nbs").alias("yes_ask_sz_centi"),
        zero("yt").alias("yes_total_centi"), zero("nt").alias("no_total_centi"), zero("yl").alias("yes_levels"), zero("nl").alias("no_levels"), *more,
    )
    return t.select(
        "ticker", "event_idx", "recv_ts_us", "event_ts_us", "seq", "event",
        "yes_bid_micro", "yes_bid_sz_centi", "yes_ask_micro", "yes_ask_sz_centi",
        mid(F.col("yes_bid_micro"), F.col("yes_ask_micro")).alias("mid_micro"),
        spread(F.col("yes_bid_micro"), F.col("yes_ask_micro")).alias("spread_micro"),
        "yes_total_centi", "no_total_centi", "yes_levels", "no_levels",
        imbalance(F.col("yes_total_centi"), F.col("no_total_centi")).alias("imbalance"), *more,
    )


def with_dollars(top: DataFrame) -> DataFrame:
    """Floating-point convenience columns; the integers stay authoritative."""
    return top.select("*", *[dollars(F.col(f"{c}_micro")).alias(c) for c in ("yes_bid", "yes_ask", "mid")])


def book_states(book_events: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Per message ticker, event_idx, epoch, recv_ts_us, and its full ladders yes and no (arrays of
    price and quantity, ascending): null where (ticker, event_idx) is not in ``wanted``, if given."""
    all_ = book_events.select("ticker", "event_idx") if wanted is None else wanted
    states = fold.ladders(book_events, all_)
    at = F.when(F.col("event") == "snapshot", F.col("event_idx"))
    s = scan.running_max(states, "ticker", "event_idx", scan.by_position("event_idx"), at, "epoch")
    return s.select("ticker", "event_idx", F.coalesce("epoch", F.lit(-1)).alias("epoch"), "recv_ts_us", "yes", "no")


def book_at(book_events: DataFrame, t_us: int) -> DataFrame:
    """The ladder that holds just before an instant: levels with quantity, by price.

    Only messages with a receive time before t count; the filter reaches the scan. Of each
    ticker only those since its last snapshot are replayed.
    """
    before = book_events.where(F.col("recv_ts_us") < F.lit(t_us))
    last = before.where("is_snapshot").groupBy("ticker").agg(F.max("event_idx").alias("_last"))
    since = before.join(last, "ticker", "left").where("_last IS NULL OR event_idx >= _last").drop("_last")
    levels = replay_levels(since)
    return levels.where("next_idx IS NULL AND qty_after > 0").select("ticker", "side", "price_micro", F.col("qty_after").alias("qty_centi"))


def two_sided(top: DataFrame) -> DataFrame:
    """Per ticker: messages, messages with both sides, whether any had both, empty books."""
    both = "yes_bid_micro IS NOT NULL AND yes_ask_micro IS NOT NULL"
    return top.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_events"), F.expr(f"count_if({both})").alias("n_two_sided"), F.expr(f"bool_or({both})").alias("two_sided"),
        F.expr("count_if(yes_levels = 0 AND no_levels = 0)").alias("n_empty"),
    )
