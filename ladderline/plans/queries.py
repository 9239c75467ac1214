"""Registered queries over the driver's tables, one for each operator family."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import naming, units
from ..operators import asof, book, catalog, coverage, merge, sequence, trades, verify
from ..sources import adapter
from ..sources.scratch import saved

Query = Callable[[SparkSession, str], DataFrame]

#: Instants inside the adapter's session, for range queries.
T0, T1 = adapter.EPOCH_US + 600_000_000, adapter.EPOCH_US + 1_200_000_000


def _book(spark: SparkSession, d: str) -> DataFrame:
    # Written, like the tables of a processed capture: scans across segments read their input twice.
    return saved(book.flatten(saved(book.number_events(adapter.book_messages(spark, d)), "messages")), "book_events")


def _trades(spark: SparkSession, d: str) -> DataFrame:
    return adapter.trade_rows(spark, d)


def _gaps(spark: SparkSession, d: str) -> DataFrame:
    return adapter.gap_rows(spark, d)


def book_events_flatten(spark, d):
    return _book(spark, d)


def book_level_replay(spark, d):
    return book.replay_levels(_book(spark, d)).drop("qty_before", "last_idx")


def book_underflows(spark, d):
    return book.underflows(book.replay_levels(_book(spark, d)))


def book_top(spark, d):
    return book.book_top(_book(spark, d))


def book_top_dollars(spark, d):
    return book.with_dollars(book_top(spark, d)).select("ticker", "event_idx", "yes_bid", "yes_ask", "mid")


def two_sided_by_ticker(spark, d):
    return book.two_sided(book_top(spark, d))


def trades_tape(spark, d):
    return trades.tape(_trades(spark, d))


def trades_dedup(spark, d):
    return trades.dedup(_trades(spark, d)).drop("seq_class")


def trades_top10(spark, d):
    return trades.top_trades(_trades(spark, d))


def taker_pressure(spark, d):
    return trades.taker_pressure(_trades(spark, d))


def gap_markers(spark, d):
    g = _gaps(spark, d)
    tickers = g.select("ticker").distinct().withColumn("sid", F.expr("CAST(substring(ticker, -1, 1) AS BIGINT) % 2"))
    marks = g.select(F.expr("CAST(substring(ticker, -1, 1) AS BIGINT) % 2").alias("sid"), F.when(F.col("seq") % 5 == 0, "reconnect").otherwise("seq_jump").alias("kind"), "channel", "recv_ts_us", "last_seq", "observed_seq")
    return sequence.fan_out(marks, tickers).groupBy("ticker", "channel", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.min("recv_ts_us").alias("first_us"), F.max("recv_ts_us").alias("last_us"),
        F.min("last_seq").alias("least_last_seq"), F.max("observed_seq").alias("most_observed_seq"),
    )


def _frames(spark, d):
    """Frames of a connection per ticker; some seqs jump, repeat or are absent."""
    m = adapter.messages(spark, d).where("kind <> 'gap'")
    return m.selectExpr("ticker AS sid", "line_no", "kind", "CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN line_no - 1 WHEN event_id % 17 = 3 THEN line_no + 2 ELSE line_no END AS seq")


def seq_gap_detect(spark, d):
    return sequence.verdicts(_frames(spark, d))


def gap_holes(spark, d):
    b = _book(spark, d)
    g = _gaps(spark, d)
    span = coverage.spans(b.select("ticker").distinct(), b, _trades(spark, d))
    return coverage.holes(g.select("ticker", "recv_ts_us", "reason", "channel", "detail"), b, span)


def coverage_by_ticker(spark, d):
    b = _book(spark, d)
    return coverage.coverage(b.select("ticker").distinct(), b, _trades(spark, d), _gaps(spark, d))


def coverage_rollup_by_date(spark, d):
    c = coverage_by_ticker(spark, d).withColumn("date", naming.ticker_date(F.col("ticker")))
    return c.groupBy(F.col("date").cast("string").alias("date")).agg(F.round(F.avg("uptime"), 6).alias("mean_uptime"), F.sum("hole_us").alias("hole_us"), F.count(F.lit(1)).alias("n"))


def merged_stream(spark, d):
    s = merge.merged(_book(spark, d), _trades(spark, d), _gaps(spark, d))
    return s.select("ticker", "pos", "ts", "kind", "source", "event_idx", "side", "price_micro", "qty_centi", "n_levels", merge.levels_text(F.col("levels")).alias("levels"), "trade_id", "taker_book_side", "reason", "detail")


def order_violations(spark, d):
    """The adapter's clock never steps back, so every 29th message is set back by a minute here."""
    b = _book(spark, d).withColumn("recv_ts_us", F.expr("recv_ts_us - IF(event_idx % 29 = 7, 60000000, 0)"))
    return merge.order_violations(b, _gaps(spark, d))


def range_replay(spark, d):
    return merge.between(_book(spark, d), _trades(spark, d), _gaps(spark, d), T0, T1).drop("pos").withColumn("levels", merge.levels_text(F.col("levels")))


def book_at_instant(spark, d):
    return book.book_at(_book(spark, d), T0)


def event_kind_counts(spark, d):
    return merged_stream(spark, d).groupBy("kind", "source").agg(F.count(F.lit(1)).alias("n"))


def trade_book_asof(spark, d):
    t = trades.with_effective(_trades(spark, d)).select("ticker", "file_row", "eff_ts_us", "price_micro", "count_centi")
    return asof.asof_backward(t, saved(book_top(spark, d), "book_top"), "ticker", "eff_ts_us", "recv_ts_us", "event_idx", ["event_idx", "yes_bid_micro", "yes_ask_micro"])


def events_book_join(spark, d):
    b = _book(spark, d)
    return asof.events_with_top(b, book.book_top(b)).select("ticker", "file_row", "event_idx", "side", "price_micro", "yes_bid_micro", "yes_ask_micro", "mid_micro")


def _outcomes(spark, d, events=None, gaps=None):
    """Outcomes, written: differences of levels read them four times. events, gaps: if written already."""
    events = _book(spark, d) if events is None else events
    # Observations describe some of these messages, so their ladders are wanted beside those near in time.
    at = events.where("event_idx % 50 = 0 AND event_idx > 0").select("ticker", "event_idx", (F.col("recv_ts_us") + 1).alias("recv_ts_us"))
    told = events.select("ticker", "event_idx").where("event_idx % 50 IN (0, 47, 48, 49)")
    wanted = verify.near(events, at.distinct()).unionByName(told)
    # Read four times by the check: as a state, as an observation, before and after it.
    states = saved(book.book_states(events, wanted), "states")
    seen = saved(adapter.verify_rows(spark, d, states), "observed")
    return saved(verify.verify_outcomes(states, seen, _gaps(spark, d) if gaps is None else gaps), "outcomes")


def verify_outcomes(spark, d):
    return _outcomes(spark, d).select("ticker", "event_idx", "recv_ts_us", "outcome", "match_lag_us")


def verify_level_diff(spark, d):
    diff = verify.level_diff(_outcomes(spark, d))
    at = F.col("first_price_micro")
    return diff.withColumn("first_price", units.format_scaled(at, units.PRICE_SCALE))


def manifest_summary(spark, d):
    b, t, g = _book(spark, d), _trades(spark, d), _gaps(spark, d)
    m = adapter.messages(spark, d).groupBy("ticker").agg(F.count(F.lit(1)).alias("records"), F.min("recv_ts_us").alias("first_recv_us"), F.max("recv_ts_us").alias("last_recv_us"))
    rows = lambda df, n: df.groupBy("ticker").agg(F.count(F.lit(1)).alias(n))
    return m.join(rows(b, "book_events"), "ticker", "left").join(rows(t, "trades"), "ticker", "left").join(rows(g, "gaps"), "ticker", "left").join(two_sided_by_ticker(spark, d).select("ticker", "two_sided"), "ticker", "left")


def digest(spark, d):
    c = coverage_by_ticker(spark, d)
    u = book_underflows(spark, d).groupBy("ticker").agg(F.max("underflows").alias("n_underflows"))
    e = c.join(u, "ticker", "left").select(
        F.substring_index("ticker", "-", 1).alias("session"), "ticker", (F.col("n_gaps") < 40).alias("complete"), "n_gaps", F.lit(None).cast("bigint").alias("n_mismatches"), "n_underflows", "uptime"
    )
    return catalog.digest(e, 0.5)


def mid_summary(spark, d):
    return book_top(spark, d).where("mid_micro IS NOT NULL").groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.min("mid_micro").alias("min_mid"), F.max("mid_micro").alias("max_mid"))


def hourly_completeness(spark, d):
    m = adapter.markets(spark, d).withColumn("label", naming.hour_label(F.col("ticker"))).where("label IS NOT NULL")
    parts = m.select("series", F.expr("substring(label, -9, 7)").alias("day"), F.expr("substring(label, -2, 2)").alias("hour"))
    # Days of five weeks each share a row, so that full, partial and edge days all occur.
    wide = parts.withColumn("day", F.concat(F.substring("day", 1, 2), F.lpad((F.dayofyear(naming.ticker_date(F.concat(F.lit("-"), "day"))) / 35).cast("int").cast("string"), 2, "0")))
    return catalog.hourly_completeness(wide)


def category_rollup(spark, d):
    return catalog.category_rollup(adapter.series(spark, d))


def rank_series(spark, d):
    return catalog.rank_series(adapter.series(spark, d))


def top_24h(spark, d):
    return catalog.top_by(adapter.series(spark, d), "volume", 10, "ticker")


def cadence_classes(spark, d):
    m = adapter.markets(spark, d)
    minutes = F.floor((F.col("close_us") - F.col("open_us")) / 60_000_000)
    return m.groupBy(naming.cadence(minutes).alias("cadence"), naming.is_terminal(F.col("status")).alias("terminal")).agg(F.count(F.lit(1)).alias("n"))


def cohorts(spark, d):
    c = catalog.cohorts(adapter.markets(spark, d))
    return c.select("event", "open_us", "close_us", "n_markets", F.array_join("tickers", ",").alias("tickers"))


def arm_plan(spark, d):
    c = catalog.cohorts(adapter.markets(spark, d)).withColumn("_m", F.floor((F.col("close_us") - F.col("open_us")) / 60_000_000))
    k = F.expr("(open_us div 3600000000) % 30")
    c = c.select("event", naming.cadence(F.col("_m")).alias("cadence"), (k % 2 == 0).alias("windowed"), (k % 3 == 0).alias("clash_sub"), F.when(k % 5 == 0, F.col("open_us")).alias("start_us"), "open_us", "close_us", (k == 7).alias("in_flight"), (k == 11).alias("done"))
    return catalog.arm_plan(c, now_us=ARM_NOW, lead_us=600_000_000, max_units=3000)


#: 2000-01-01 in microseconds: inside the range of order dates.
ARM_NOW = 946684800000000
#: 1997-05-28 01:00.
LADDER_OPEN = 864777600000000 + 3_600_000_000


def largest_ladder(spark, d):
    return catalog.largest_ladder(adapter.markets(spark, d).where("event IS NOT NULL"), LADDER_OPEN)


def ladder_band(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet")
    s = p.selectExpr(
        "p_brand AS event", "p_partkey AS pos", "p_size AS strike",
        "CASE WHEN p_brand = 'Brand#1' THEN NULL WHEN p_brand = 'Brand#2' THEN NULL WHEN p_partkey % 4 = 0 THEN (p_partkey % 101) / 100D END AS price",
        "CASE WHEN p_brand = 'Brand#2' THEN 20.4D END AS anchor",
    )
    s = s.groupBy("event", "strike").agg(F.min("pos").alias("pos"), F.min("price").alias("price"), F.min("anchor").alias("anchor"))
    return catalog.ladder_band(s, 3).withColumn("strike", F.col("strike").cast("bigint"))


def parse_fixed_point(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    text = F.expr(
        """CASE l_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN concat('-', CAST(CAST(l_quantity AS BIGINT) AS STRING))
           WHEN 3 THEN '0.0800' WHEN 4 THEN '0.1234567' WHEN 5 THEN '5000' WHEN 6 THEN concat(CAST(CAST(l_quantity AS BIGINT) AS STRING), '.5')
           WHEN 7 THEN '1.' WHEN 8 THEN '-0' ELSE concat('0.', lpad(CAST(l_orderkey % 1000000 AS STRING), 6, '0')) END"""
    )
    t = li.select(text.alias("text"))
    p = t.select("text", units.parse_price(F.col("text")).alias("micro"), units.parse_error(F.col("text"), 6, units.U32_MAX).alias("price_error"), units.parse_delta(F.col("text")).alias("delta"), units.parse_error(F.col("text"), 2, units.I64_MAX, True).alias("delta_error"))
    return p.groupBy("text", "micro", "price_error", "delta", "delta_error").agg(F.count(F.lit(1)).alias("n"))


def ticker_dates(spark, d):
    m = adapter.markets(spark, d).select("ticker").distinct()
    return m.select("ticker", naming.ticker_date(F.col("ticker")).cast("string").alias("date"), naming.hour_label(F.col("ticker")).alias("label"))


def event_start(spark, d):
    m = adapter.markets(spark, d).select("series", "pos", "ticker")
    ev = m.select(F.concat("series", F.lit("-"), F.regexp_extract("ticker", r"-([^-]+)-", 1), F.lpad((F.col("pos") % 60).cast("string"), 2, "0")).alias("ev")).distinct()
    return ev.select(F.col("ev").alias("event"), naming.event_start_us(F.col("ev")).alias("start_us"))


def diagonal_union(spark, d):
    t, g = _trades(spark, d), _gaps(spark, d)
    u = t.select("ticker", "recv_ts_us", "price_micro", F.lit("trades").alias("source_path")).unionByName(g.select("ticker", "recv_ts_us", "reason", F.lit("gaps").alias("source_path")), allowMissingColumns=True)
    return u.groupBy("ticker", "source_path").agg(F.count(F.lit(1)).alias("n"), F.count("price_micro").alias("n_price"), F.count("reason").alias("n_reason"))


def settled_units(spark, d):
    m = adapter.markets(spark, d)
    # Some targets are on no list.
    targets = m.select(F.concat(F.lit("u"), F.col("pos") % 500).alias("unit"), F.expr("IF(pos % 9 = 4, concat(ticker, '-X'), ticker)").alias("ticker")).distinct()
    return catalog.settled(targets, m.select("ticker", "status", F.col("pos").alias("seen_us")))


def first_seen_markets(spark, d):
    return catalog.first_seen(adapter.markets(spark, d), "ticker", ("pos",)).select("ticker", "pos", "status")


def market_search(spark, d):
    m = catalog.search(adapter.markets(spark, d), "kxo1-", "ticker", "event")
    return catalog.close_window(m, ARM_NOW, ARM_NOW + 200 * 86_400_000_000).select("ticker", "pos", "close_us")


def name_functions(spark, d):
    s = spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", "s_name")
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_name", "p_brand")
    t = p.select(F.col("p_partkey").alias("k"), F.concat(F.lit(" "), "p_name", F.lit(" & "), "p_brand", F.lit("!")).alias("text")).unionByName(s.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("text")))
    return t.select("k", "text", naming.slug(F.col("text")).alias("slug"), naming.is_safe_segment(F.col("text")).alias("safe"), naming.session_name(F.when(F.col("k") % 3 == 0, F.lit("EV")), F.col("text"), F.concat(F.lit("id"), "k")).alias("session"))


def capture_report(spark, d):
    m = adapter.messages(spark, d).withColumn("channel", F.when(F.col("kind") == "trade", "trade").otherwise("orderbook"))
    return m.groupBy("ticker", "channel").agg(*[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("snapshot", "delta", "trade", "gap")])


def time_windows(spark, d):
    m = adapter.messages(spark, d).select("ticker", "recv_ts_us")
    return m.groupBy("ticker", (F.expr("(recv_ts_us - 1704067200000000) div 300000000") * 300_000_000 + adapter.EPOCH_US).alias("lo_us")).agg(F.count(F.lit(1)).alias("n"))


def pending_gaps(spark, d):
    s = merge.merged(_book(spark, d), _trades(spark, d), _gaps(spark, d))
    return merge.pending_gaps(s, T1).select("ticker", "ts", "seq", "reason")


def json_decode_outcomes(spark, d):
    """Envelopes rendered from messages, some of them spoiled, and what decoding makes of them.
    Every third snapshot is rendered as an observation of the book. Bad times, and numbers beyond
    their type, are among what is spoiled; a seq beyond 2^63 is not."""
    m = adapter.messages(spark, d).withColumn("kind", F.expr("IF(kind = 'snapshot' AND event_id % 3 = 0, 'verify', kind)"))
    ts = "date_format(timestamp_micros(recv_ts_us), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"
    level = """concat('{"price":', (1 + (event_id * 7 + k * 2) % 9) * 50000, ',"quantity":', CASE WHEN event_id % 31 = 1 THEN -1 ELSE 1000 + (event_id % 50) * 100 + k * 10 END, '}')"""
    levels = f"concat('[', array_join(transform(array(0, 1, 2), k -> {level}), ','), ']')"
    at = f"CASE WHEN event_id % 31 = 11 THEN 'noon' ELSE {ts} END"
    data = f"""CASE kind
      WHEN 'delta' THEN concat('{{"ticker":"', ticker, '","ts":"', {at}, '","side":"', CASE WHEN event_id % 31 = 1 THEN 'up' ELSE side END, '","price":', price_micro, ',"delta":', qty_centi, CASE WHEN event_id % 31 = 2 THEN ',"x":1' ELSE '' END, '}}')
      WHEN 'trade' THEN concat('{{"ticker":"', ticker, '","ts":"', {at}, '","price":', CASE WHEN event_id % 31 = 3 THEN '-1' ELSE price_micro END, ',"count":', qty_centi, ',"taker_side":"', side, '","taker_book_side":null}}')
      WHEN 'gap' THEN concat('{{"reason":"', CASE WHEN event_id % 31 = 4 THEN 'why' ELSE 'seq_jump' END, '","ticker":"', ticker, '","channel":"orderbook","detail":"d"}}')
      ELSE concat('{{"ticker":"', ticker, '","ts":"', {at}, '","yes":', {levels}, ',"no":', CASE WHEN event_id % 31 = 2 THEN '7' WHEN event_id % 2 = 0 THEN '[]' ELSE {levels} END, '}}') END"""
    text = f"""CASE WHEN event_id % 31 = 5 THEN 'not json' ELSE
      concat('{{"v":', CASE WHEN event_id % 31 = 6 THEN 3 ELSE 2 END, ',"recv_ts":"', CASE event_id % 31 WHEN 7 THEN '2026' WHEN 12 THEN replace({ts}, 'Z', '') ELSE {ts} END,
        '","seq":', CASE event_id % 31 WHEN 8 THEN '18446744073709551616' WHEN 9 THEN '18446744073709551615' WHEN 10 THEN '-1' ELSE CAST(line_no AS STRING) END,
        CASE WHEN event_id % 31 = 13 THEN ',"sid":"x"' ELSE '' END, ',"kind":"', kind, '","extra":0,"data":', {data}, '}}') END"""
    lines = m.selectExpr("ticker", "'orderbook' AS channel", "'f' AS file", "line_no", f"{text} AS text", "kind AS kind0")
    from ..sources import capture

    out = capture.decode(lines)
    size = lambda k: F.coalesce(F.size(f"{k}.yes"), F.lit(0)) + F.coalesce(F.size(f"{k}.no"), F.lit(0))
    good = F.col("error").isNull()
    n_levels = F.sum(F.when(good & F.col("kind0").isin("snapshot", "verify"), size("snapshot") + size("verify")))
    quantity = F.sum(F.when(good, F.aggregate(F.coalesce("snapshot.yes", "verify.yes"), F.lit(0).cast("bigint"), lambda a, x: a + x["quantity"].cast("bigint"))))
    return out.groupBy("kind0", F.substring_index("error", ":", 1).alias("error_class")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("delta.delta").alias("delta_sum"), F.sum("trade.price").alias("price_sum"), n_levels.alias("n_levels"), quantity.alias("yes_quantity"),
        F.count_if(good & (F.col("seq") == -1)).alias("n_wrapped"),
    )


def frame_decode_outcomes(spark, d):
    """Feed frames rendered from messages, some of them spoiled, and their outcomes."""
    m = adapter.messages(spark, d)
    dollars = "concat(price_micro div 1000000, '.', lpad(CAST(price_micro % 1000000 AS STRING), 6, '0'))"
    qty = "concat(CASE WHEN qty_centi < 0 THEN '-' ELSE '' END, abs(qty_centi) div 100, '.', lpad(CAST(abs(qty_centi) % 100 AS STRING), 2, '0'))"
    body = f"""CASE kind
      WHEN 'snapshot' THEN concat('{{"market_ticker":"', ticker, '"', CASE WHEN event_id % 3 = 0 THEN '' ELSE concat(',"yes_dollars_fp":[["', {dollars}, '","1.00"]]') END, '}}')
      WHEN 'trade' THEN concat('{{"market_ticker":"', ticker, '","yes_price_dollars":"', {dollars}, '","count_fp":"', {qty}, '","taker_outcome_side":"', side, '","taker_book_side":', CASE WHEN event_id % 29 = 1 THEN '"left"' ELSE 'null' END, '}}')
      ELSE concat('{{"market_ticker":"', ticker, '","price_dollars":', CASE WHEN event_id % 29 = 2 THEN '0.5' ELSE concat('"', {dollars}, '"') END, ',"delta_fp":"', {qty}, '","side":"', side, '","ts_ms":', CASE WHEN event_id % 29 = 4 THEN 9223372036854775807 ELSE recv_ts_us div 1000 END, '}}') END"""
    kind = "CASE kind WHEN 'snapshot' THEN 'orderbook_snapshot' WHEN 'trade' THEN 'trade' WHEN 'gap' THEN CASE WHEN event_id % 2 = 0 THEN 'ok' ELSE 'mystery' END ELSE 'orderbook_delta' END"
    text = f"CASE WHEN event_id % 29 = 3 THEN '{{broken' ELSE concat('{{\"type\":\"', {kind}, '\",\"seq\":', line_no, ',\"msg\":', {body}, '}}') END"
    from ..sources import wire

    out = wire.decode_frames(m.selectExpr("recv_ts_us", f"{text} AS text"))
    return out.groupBy("outcome", "channel").agg(F.count(F.lit(1)).alias("n"), F.sum("delta_centi").alias("delta_sum"), F.sum("price_micro").alias("price_sum"), F.sum(F.size("yes")).alias("n_yes"), F.sum(F.col("event_ts_us") - F.col("recv_ts_us")).alias("lag_us"))


_QUERIES = (
    book_events_flatten, book_level_replay, book_underflows, book_top, book_top_dollars, two_sided_by_ticker, trades_tape, trades_dedup, trades_top10,
    taker_pressure, gap_markers, seq_gap_detect, gap_holes, coverage_by_ticker, coverage_rollup_by_date, merged_stream, order_violations, range_replay,
    book_at_instant, pending_gaps, event_kind_counts, trade_book_asof, events_book_join, verify_outcomes, verify_level_diff, manifest_summary, digest,
    mid_summary, hourly_completeness, category_rollup, rank_series, top_24h, cadence_classes, cohorts, arm_plan, largest_ladder, ladder_band,
    parse_fixed_point, ticker_dates, event_start, diagonal_union, settled_units, first_seen_markets, market_search, name_functions, capture_report, time_windows,
    json_decode_outcomes, frame_decode_outcomes,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _QUERIES}

