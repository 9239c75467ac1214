"""Dataset trust: gaps, the holes they leave, and how much of a capture's span is covered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.naming import ticker_date


def with_mismatch_gaps(gaps: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Stream gaps and one `verify_mismatch` gap for each mismatch; ``gap_no`` orders them by
    receive time, stream rows first on ties, then file order."""
    cols = ["ticker", "recv_ts_us", "seq", "last_seq", "observed_seq", "reason", "channel", "detail", "file_row"]
    own = gaps.select(*cols, F.lit(0).alias("_synth"))
    bad = outcomes.where("outcome = 'mismatch'").select(
        "ticker", "recv_ts_us", *[F.lit(None).cast("bigint").alias(c) for c in ("seq", "last_seq", "observed_seq")], F.lit("verify_mismatch").alias("reason"), F.lit("orderbook").alias("channel"), "detail",
        F.col("event_idx").alias("file_row"), F.lit(1).alias("_synth"),
    )
    w = Window.partitionBy("ticker").orderBy("recv_ts_us", "_synth", "file_row")
    return own.unionByName(bad).withColumn("gap_no", (F.row_number().over(w) - 1).cast("bigint")).drop("_synth", "file_row")


def spans(tickers: DataFrame, book_events: DataFrame, trades: DataFrame) -> DataFrame:
    """Per ticker: extent of the book's receive times, else of the trades' event times, else null."""
    b = book_events.groupBy("ticker").agg(F.min("recv_ts_us").alias("b0"), F.max("recv_ts_us").alias("b1"))
    t = trades.groupBy("ticker").agg(F.min("event_ts_us").alias("t0"), F.max("event_ts_us").alias("t1"))
    return tickers.select("ticker").join(b, "ticker", "left").join(t, "ticker", "left").select(
        "ticker", F.col("b0").isNotNull().alias("has_book"), F.coalesce("b0", "t0").alias("span_start_us"), F.coalesce("b1", "t1").alias("span_end_us")
    )


def holes(gaps: DataFrame, book_events: DataFrame, span: DataFrame) -> DataFrame:
    """One row per gap: the hole lasts to the first snapshot at or after it, else to the end of
    the span if that is not before the gap, else it can't be measured (null)."""
    snap = book_events.where("is_snapshot").select("ticker", F.col("recv_ts_us").alias("ts"), F.col("recv_ts_us").alias("_snap")).distinct()
    cols = [c for c in gaps.columns if c != "ticker"]
    g = gaps.select("ticker", F.col("recv_ts_us").alias("ts"), F.lit(None).cast("bigint").alias("_snap"), F.struct(*cols).alias("g"))
    # Reversed, with ties: a frame that ends at the last row would be computed anew for every row.
    ahead = Window.partitionBy("ticker").orderBy(F.desc("ts")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = g.unionByName(snap, allowMissingColumns=True).withColumn("_next", F.min("_snap").over(ahead)).where("g IS NOT NULL")
    end = F.when(F.col("_next").isNotNull(), F.col("_next")).when(F.col("span_end_us") >= F.col("ts"), F.col("span_end_us"))
    return (
        both.join(span.select("ticker", "span_end_us"), "ticker", "left")
        .select("ticker", "g.*", end.alias("hole_end_us"), F.col("_next").isNotNull().alias("resolved"))
        .withColumn("hole_us", F.col("hole_end_us") - F.col("recv_ts_us"))
    )


def union_length(intervals: DataFrame, by: str, start: str, end: str) -> DataFrame:
    """Total length of the union of intervals for each value of ``by`` (touching ones merge; empty ones go)."""
    w = Window.partitionBy(by).orderBy(start, end)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    ok = intervals.where(F.col(end) > F.col(start)).withColumn("_far", F.max(end).over(before))
    # What an interval adds is what lies beyond everything before it.
    add = F.greatest(F.lit(0), F.col(end) - F.greatest(F.col(start), F.coalesce(F.col("_far"), F.col(start))))
    return ok.groupBy(by).agg(F.sum(add).alias("length"))


def coverage(tickers: DataFrame, book_events: DataFrame, trades: DataFrame, gaps: DataFrame) -> DataFrame:
    """Per ticker: counts, span, covered share (uptime) and hole time.

    hole_us is null without a book, 0 without holes. A span of 0 has uptime 1 without gaps,
    null with them.
    """
    span = spans(tickers, book_events, trades)
    h = holes(gaps, book_events, span).join(span.select("ticker", "span_start_us", F.col("span_end_us").alias("_e")), "ticker")
    clamped = h.select("ticker", F.greatest("recv_ts_us", "span_start_us").alias("a"), F.least("hole_end_us", "_e").alias("b"))
    hole = union_length(clamped, "ticker", "a", "b").withColumnRenamed("length", "_hole")
    per_gap = h.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_gaps"), F.expr("count_if(NOT resolved)").alias("n_unresolved"))
    events = book_events.groupBy("ticker").agg(F.countDistinct("event_idx").alias("n_events"), F.expr("count(DISTINCT CASE WHEN is_snapshot THEN event_idx END)").alias("n_snapshots"))
    tr = trades.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_trades"))
    out = span
    for x in (events, tr, per_gap, hole):
        out = out.join(x, "ticker", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    length = F.col("span_end_us") - F.col("span_start_us")
    hole_us = F.when(F.col("has_book"), F.coalesce("_hole", F.lit(0)))
    uptime = F.when(length > 0, 1 - F.coalesce("_hole", F.lit(0)).cast("double") / length.cast("double")).when((length == 0) & (F.coalesce("n_gaps", F.lit(0)) == 0), F.lit(1.0))
    return out.select("ticker", "has_book", "span_start_us", "span_end_us", length.alias("span_us"), n("n_events"), n("n_snapshots"), n("n_trades"), n("n_gaps"), n("n_unresolved"), hole_us.alias("hole_us"), F.when(F.col("has_book"), uptime).alias("uptime"))


def reasons() -> Column:
    """Why a session is incomplete, from its manifest row; empty if it is complete."""
    n = lambda c, what: F.when(F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(what)))
    return F.array_compact(F.array(n("read_errors", " unreadable lines"), n("raw", " undecoded messages")))


def accounting(cover: DataFrame, manifest: DataFrame, source_path: str) -> DataFrame:
    """One row per session: what it holds, how far it can be trusted, and why not.

    ``cover``: of ``coverage``; ``manifest``: of ``manifest_rows``. The last two columns are the
    span's ends as instants.
    """
    m = manifest.select(
        "ticker", "complete", reasons().alias("reasons"), (F.col("verify_matched") + F.col("verify_mismatch") + F.col("verify_skipped")).alias("verify_checks"),
        F.col("verify_mismatch").alias("verify_mismatches"), "underflows", F.col("book_events").alias("n_book_events"),
    )
    c = cover.withColumnRenamed("n_unresolved", "n_unresolved_gaps").drop("n_events", "n_snapshots").join(m, "ticker")
    return c.select(
        "ticker", F.lit(source_path).alias("source_path"), ticker_date(F.col("ticker")).alias("date"), "complete", "reasons", "has_book",
        "span_start_us", "span_end_us", "span_us", "n_gaps", "n_unresolved_gaps", "hole_us", "uptime",
        "verify_checks", "verify_mismatches", "underflows", "n_book_events", "n_trades",
        F.timestamp_micros("span_start_us").alias("span_start"), F.timestamp_micros("span_end_us").alias("span_end"),
    )
