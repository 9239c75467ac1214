"""Registered queries of the frame functions and planning rules, each beside its DuckDB SQL.

Inputs are derived from the driver's tables by columns, with every kind of bad value in them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import naming, units
from ..operators import book, catalog, coverage, validate, verify
from ..sources import adapter, process, wire
from ..sources.scratch import saved
from . import oracle
from . import queries as q

Query = Callable[[SparkSession, str], DataFrame]

_DAY = 86_400_000_000


def malformed_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the three tables, some of them spoiled by position, and what is wrong with them."""
    k = F.col("file_row") % 97
    spoil = lambda df, **c: df.withColumns({n: F.when(k == i, F.lit(v)).otherwise(F.col(n)).cast(df.schema[n].dataType) for n, (i, v) in c.items()})
    b = spoil(q._book(spark, d), side=(1, "up"), price_micro=(2, -1), event_idx=(4, None), recv_ts_us=(5, None), is_snapshot=(6, None))
    b = b.withColumn("qty_centi", F.when((k == 7) & F.col("is_snapshot"), F.lit(-5)).when((k == 8), F.lit(None)).otherwise(F.col("qty_centi")).cast("bigint"))
    t = spoil(q._trades(spark, d), count_centi=(1, None), taker_book_side=(2, "left"), recv_ts_us=(3, None), event_ts_us=(4, None), price_micro=(5, 1 << 32), taker_side=(7, "up"))
    g = spoil(q._gaps(spark, d), recv_ts_us=(1, None), reason=(2, None), detail=(3, None))
    return validate.malformed(b, t, g)


def _accounted(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Coverage and manifest of the adapter's session; some messages count as unreadable or undecoded."""
    # Each is counted, compared or scanned several times.
    m = saved(adapter.messages(spark, d), "records")
    b, t, g = q._book(spark, d), saved(q._trades(spark, d), "trades"), saved(q._gaps(spark, d), "gaps")
    m = m.withColumns({"channel": F.when(F.col("kind") == "trade", "trade").otherwise("orderbook"), "file": F.concat(F.expr("line_no div 500"), F.lit(".jsonl"))})
    tables = {"records": m, "read_errors": m.where("event_id % 1009 = 1 AND ticker < 'KXSIM-24JAN05'"), "raw": m.where("event_id % 1013 = 2 AND ticker < 'KXSIM-24JAN03'"), "trades": t, "gaps": g}
    cover = coverage.coverage(b.select("ticker").distinct(), b, t, g)
    return cover, process.manifest_rows(tables, b, saved(book.book_top(b), "book_top"), q._outcomes(spark, d, b, g), cover)


def coverage_accounting(spark: SparkSession, d: str) -> DataFrame:
    out = coverage.accounting(*_accounted(spark, d), "session")
    us = lambda c: F.unix_micros(c).alias(c)
    return out.select(*[c for c in out.columns if c not in ("date", "reasons", "span_start", "span_end")], F.col("date").cast("string").alias("date"), F.array_join("reasons", "; ").alias("reasons"), us("span_start"), us("span_end"))


def manifest_sink(spark: SparkSession, d: str) -> DataFrame:
    """Notes and lines per file of each session's manifest."""
    m = _accounted(spark, d)[1]
    files = F.array_join(F.transform("files", lambda f: F.concat_ws(" ", f["channel"], f["file"], f["records"].cast("string"))), ",")
    return m.select("ticker", "records", "read_errors", "raw", "trades", "gaps", "book_top", "book_events", "underflows", F.array_join("notes", "; ").alias("notes"), files.alias("files"))


def discover_order(spark: SparkSession, d: str) -> DataFrame:
    m = _quotes(spark, d).withColumn("page", F.expr("pos div 100"))
    return catalog.discover(m).select("pos", "position")


def mismatch_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Gaps of the stream and those that mismatches make, with their text."""
    return coverage.with_mismatch_gaps(q._gaps(spark, d), verify.with_detail(q._outcomes(spark, d)))


def _quotes(spark: SparkSession, d: str) -> DataFrame:
    """Open markets with quotes, some absent, and volumes as text, some no numbers."""
    return adapter.markets(spark, d).selectExpr(
        "series", "ticker", "event", "pos", "status", "open_us", "close_us", "(close_us - open_us) div 60000000 AS minutes", "CASE WHEN pos % 6 <> 0 THEN CAST(pos % 50 AS DOUBLE) END AS strike",
        "CASE WHEN pos % 3 <> 0 THEN (pos % 90) / 128D END AS bid", "CASE WHEN pos % 4 <> 0 THEN (pos % 90 + 2) / 128D END AS ask", "CASE WHEN pos % 5 <> 0 THEN (pos % 101) / 128D END AS last",
        "CASE pos % 7 WHEN 0 THEN NULL WHEN 1 THEN 'many' WHEN 2 THEN '' ELSE CAST(pos % 1000 AS STRING) END AS volume", "CASE pos % 8 WHEN 0 THEN NULL ELSE concat(pos % 100, '.5') END AS volume_24h",
    )


_QUOTES = oracle.MARKETS + """,
qu AS (
  SELECT series, ticker, event, pos, status, open_us, close_us, (close_us - open_us) // 60000000 AS minutes, CASE WHEN pos % 6 <> 0 THEN CAST(pos % 50 AS DOUBLE) END AS strike,
    CASE WHEN pos % 3 <> 0 THEN CAST(pos % 90 AS DOUBLE) / 128 END AS bid, CASE WHEN pos % 4 <> 0 THEN CAST(pos % 90 + 2 AS DOUBLE) / 128 END AS ask, CASE WHEN pos % 5 <> 0 THEN CAST(pos % 101 AS DOUBLE) / 128 END AS last,
    CASE WHEN pos % 7 < 3 THEN 0.0 ELSE CAST(pos % 1000 AS DOUBLE) END AS volume, CASE WHEN pos % 8 = 0 THEN 0.0 ELSE CAST(pos % 100 AS DOUBLE) + 0.5 END AS volume_24h
  FROM mk),
pr AS (SELECT *, coalesce((bid + ask) / 2, last) AS price FROM qu)"""


def market_numbers(spark: SparkSession, d: str) -> DataFrame:
    price = naming.price_proxy(F.col("bid"), F.col("ask"), F.col("last"))
    return _quotes(spark, d).select("pos", naming.number_or_zero(F.col("volume")).alias("volume"), price.alias("price"), naming.atm_distance(price).alias("distance"), naming.is_hourly(F.col("minutes")).alias("hourly"))


def min_volume(spark: SparkSession, d: str) -> DataFrame:
    return catalog.min_volume(_quotes(spark, d), 700).select("pos", "ticker")


def spot_anchor(spark: SparkSession, d: str) -> DataFrame:
    m = _quotes(spark, d).where("status = 'open'")
    return catalog.spot_anchor(m.withColumn("price", naming.price_proxy(F.col("bid"), F.col("ask"), F.col("last"))))


def series_sums(spark: SparkSession, d: str) -> DataFrame:
    return catalog.series_sums(_quotes(spark, d).where("status IN ('open', 'active')"))


def rest_trade_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Fetched trades as text, some with bad fields, and why they stay raw. A sum that a 64-bit
    column can't hold is null (times add up to that from some 5,400 trades on; the SQL ends there)."""
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    rows = li.selectExpr(
        "concat('T', l_orderkey % 9) AS ticker", "concat(l_orderkey, '-', l_linenumber) AS trade_id",
        "CASE l_orderkey % 11 WHEN 1 THEN NULL WHEN 2 THEN '0.12x' ELSE concat('0.', lpad(CAST(l_partkey % 100 AS STRING), 2, '0')) END AS yes_price_dollars",
        "CASE l_orderkey % 13 WHEN 1 THEN NULL WHEN 2 THEN '-3.00' ELSE concat(CAST(l_quantity AS BIGINT), '.50') END AS count_fp",
        "CASE l_orderkey % 17 WHEN 1 THEN NULL WHEN 2 THEN 'up' WHEN 3 THEN 'no' ELSE 'yes' END AS taker_outcome_side",
        "CASE l_orderkey % 19 WHEN 1 THEN 'left' WHEN 2 THEN 'bid' WHEN 3 THEN 'ask' END AS taker_book_side",
        "CASE l_orderkey % 23 WHEN 1 THEN NULL WHEN 2 THEN 'noon' WHEN 3 THEN '2024-01-01' WHEN 4 THEN '2024-01-01T00:00:07' ELSE concat('2024-01-01T00:', lpad(CAST(l_orderkey % 60 AS STRING), 2, '0'), ':07.25Z') END AS created_time",
    )
    out = wire.rest_trades(rows)
    good = F.col("error").isNull()
    total = lambda c: units.sum_or_null(F.when(good, F.col(c))).alias(f"{c}_sum")
    return out.groupBy("ticker", "error").agg(F.count(F.lit(1)).alias("n"), total("price_micro"), total("count_centi"), total("event_ts_us"), F.count("taker_book_side").alias("n_book_side"))


def unfinished_tickers(spark: SparkSession, d: str) -> DataFrame:
    """Markets that are on no list of finished ones."""
    m = adapter.markets(spark, d)
    done = m.where(naming.is_terminal(F.col("status"))).select("ticker").distinct()
    return catalog.not_in(m.select("ticker", "series").distinct(), done, "ticker")


def discovery_windows(spark: SparkSession, d: str) -> DataFrame:
    w = catalog.discovery_window(F.col("open_us"), F.col("pos") % 5)
    return adapter.markets(spark, d).select("pos", "open_us").withColumn("w", w).select("pos", "w.lo_us", "w.hi_us")


def boundary_times(spark: SparkSession, d: str) -> DataFrame:
    m = adapter.messages(spark, d).select("ticker", "line_no", "recv_ts_us")
    return m.select("ticker", "line_no", catalog.next_boundary(F.col("recv_ts_us")).alias("next_us"), catalog.seconds_to_midnight(F.col("recv_ts_us")).alias("to_midnight_s"))


#: Hour-wide chunks of a range whose end is inside an hour.
_LO, _HI, _STEP = adapter.EPOCH_US, adapter.EPOCH_US + 100 * 3_600_000_000 + 7, 3_600_000_000


def chunk_counts(spark: SparkSession, d: str) -> DataFrame:
    """Messages in each chunk of a time range, a range join by equality on the chunk's number."""
    n = adapter.messages(spark, d).groupBy(F.expr(f"(recv_ts_us - {_LO}) div {_STEP}").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    c = catalog.time_chunks(spark, _LO, _HI, _STEP).withColumn("k", F.expr(f"(lo_us - {_LO}) div {_STEP}"))
    return c.join(n, "k", "left").select("lo_us", "hi_us", F.coalesce("n", F.lit(0)).alias("n"))


def session_quality(spark: SparkSession, d: str) -> DataFrame:
    return catalog.session_quality(_accounted(spark, d)[1])


def backfill_report(spark: SparkSession, d: str) -> DataFrame:
    """Trades fetched in pages of 100 orders; some come twice, some are raw."""
    li = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    got = li.selectExpr("concat(l_orderkey, '-', CASE WHEN l_linenumber = 2 THEN 1 ELSE l_linenumber END) AS trade_id", "CASE WHEN l_orderkey % 29 = 0 THEN 'bad' END AS error")
    return catalog.backfill_report(li.select(F.expr("l_orderkey div 100").alias("page")).distinct(), got)


def earliest_close(spark: SparkSession, d: str) -> DataFrame:
    return catalog.earliest_close(adapter.markets(spark, d).where("status = 'open'"))


def team_match(spark: SparkSession, d: str) -> DataFrame:
    """An event that is there, and codes where none is predicted."""
    m = adapter.markets(spark, d).select("pos", "ticker", "event")
    first = m.where("pos = 1").select("event").first()
    exact = catalog.team_match(m, first and first["event"], ["XX"]).withColumn("by", F.lit("event"))
    return exact.unionByName(catalog.team_match(m, "gone", ["kxo3", "JAN"]).withColumn("by", F.lit("codes"))).select("by", "pos")


def instants(spark: SparkSession, d: str) -> DataFrame:
    """Seconds, dates and times as text to instants; until a date means until its end."""
    o = spark.read.parquet(f"{d}/orders.parquet")
    t = o.selectExpr(
        """CASE o_orderkey % 5 WHEN 0 THEN concat(' ', CAST(o_orderkey AS STRING), ' ') WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd')
           WHEN 2 THEN concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T06:30:00Z') WHEN 3 THEN 'soon' END AS text"""
    ).distinct()
    return t.select("text", naming.instant_s(F.col("text")).alias("at_s"), naming.until_s(F.col("text")).alias("until_s"))


_V = oracle.VERIFY
_SIDES = """,
      sd AS (SELECT ticker, i, 'yes' AS side, cy AS a, ry AS b FROM oc WHERE outcome = 'mismatch' UNION ALL SELECT ticker, i, 'no', cn, rn FROM oc WHERE outcome = 'mismatch'),
      xa AS (SELECT ticker, i, side, l.price AS p, l.quantity AS q FROM (SELECT ticker, i, side, unnest(a) AS l FROM sd)),
      xb AS (SELECT ticker, i, side, l.price AS p, l.quantity AS q FROM (SELECT ticker, i, side, unnest(b) AS l FROM sd)),
      df AS (SELECT coalesce(xa.ticker, xb.ticker) AS ticker, coalesce(xa.i, xb.i) AS i, coalesce(xa.side, xb.side) AS side, coalesce(xa.p, xb.p) AS p, xa.q AS o, xb.q AS r
        FROM xa FULL JOIN xb ON xa.ticker = xb.ticker AND xa.i = xb.i AND xa.side = xb.side AND xa.p = xb.p WHERE xa.q IS DISTINCT FROM xb.q),
      fd AS (SELECT ticker, i, side, count(*) AS n, min(p) AS p, arg_min({'o': o, 'r': r}, p) AS z FROM df GROUP BY ALL),
      tx AS (SELECT ticker, i, side, concat(n, ' level(s) differ (first at ', p // 1000000, '.', lpad(CAST(p % 1000000 AS VARCHAR), 6, '0'), ': ours ',
        CASE WHEN z.o IS NULL THEN 'absent' ELSE concat(z.o // 100, '.', lpad(CAST(z.o % 100 AS VARCHAR), 2, '0')) END, ' vs rest ',
        CASE WHEN z.r IS NULL THEN 'absent' ELSE concat(z.r // 100, '.', lpad(CAST(z.r % 100 AS VARCHAR), 2, '0')) END, ')') AS t FROM fd),
      mm AS (SELECT o.ticker, o.i, o.ts, concat('yes: ', coalesce(y.t, '0 level(s) differ'), '; no: ', coalesce(n.t, '0 level(s) differ')) AS detail
        FROM oc o LEFT JOIN tx y ON y.ticker = o.ticker AND y.i = o.i AND y.side = 'yes' LEFT JOIN tx n ON n.ticker = o.ticker AND n.i = o.i AND n.side = 'no' WHERE o.outcome = 'mismatch')"""

_MANIFEST = """,
      ma AS (SELECT ticker, count(*) FILTER (event_id % 1009 = 1 AND ticker < 'KXSIM-24JAN05') AS re, count(*) FILTER (event_id % 1013 = 2 AND ticker < 'KXSIM-24JAN03') AS raw FROM msg GROUP BY ticker)"""

SQL: dict[str, str] = {
    "malformed_rows": f"""WITH {oracle.BOOK}{oracle._TRADE_BODY}{oracle._GAP_BODY}
      SELECT 'book_events' AS "table", ticker, file_row, CASE k WHEN 1 THEN 'side is up' WHEN 2 THEN 'price_micro out of range: -1' WHEN 4 THEN 'column event_idx is null' WHEN 5 THEN 'column recv_ts_us is null'
        WHEN 6 THEN 'column is_snapshot is null' WHEN 7 THEN 'qty_centi is negative: -5' ELSE 'delta without side, price or quantity' END AS detail
      FROM (SELECT *, file_row % 97 AS k FROM be) WHERE k IN (1, 2, 4, 5, 6) OR (k = 7 AND is_snapshot) OR (k = 8 AND NOT is_snapshot)
      UNION ALL SELECT 'trades', ticker, file_row, CASE WHEN k = 1 THEN 'column count_centi is null' WHEN k = 3 THEN 'column recv_ts_us is null' WHEN k = 4 THEN 'column event_ts_us is null' WHEN k = 2 THEN 'taker_book_side is left'
        WHEN k = 5 THEN 'price_micro out of range: 4294967296' WHEN count_centi < 0 THEN concat('count_centi is negative: ', count_centi) ELSE 'taker_side is up' END
      FROM (SELECT *, file_row % 97 AS k FROM tr) WHERE k IN (1, 2, 3, 4, 5, 7) OR count_centi < 0
      UNION ALL SELECT 'gaps', ticker, file_row, CASE k WHEN 1 THEN 'column recv_ts_us is null' WHEN 2 THEN 'column reason is null' ELSE 'column detail is null' END FROM (SELECT *, file_row % 97 AS k FROM gp) WHERE k IN (1, 2, 3)""",
    "coverage_accounting": f"""WITH {oracle.TOP}{oracle._TRADE_BODY}{oracle._GAP_BODY}{oracle._COVER_BODY}{oracle._VERIFY_BODY}{_MANIFEST}
      SELECT c.ticker, 'session' AS source_path, CAST({oracle._date('c.ticker')} AS VARCHAR) AS date, re = 0 AND raw = 0 AS complete,
        concat_ws('; ', CASE WHEN re > 0 THEN concat(re, ' unreadable lines') END, CASE WHEN raw > 0 THEN concat(raw, ' undecoded messages') END) AS reasons, has_book,
        span_start_us, span_end_us, span_us, n_gaps, n_unresolved AS n_unresolved_gaps, hole_us, uptime,
        (SELECT count(*) FROM oc WHERE oc.ticker = c.ticker) AS verify_checks, (SELECT count(*) FROM oc WHERE oc.ticker = c.ticker AND outcome = 'mismatch') AS verify_mismatches,
        (SELECT count(*) FROM lvb WHERE lvb.ticker = c.ticker AND NOT is_snapshot AND qty_before + qty_centi < 0) AS underflows, (SELECT count(*) FROM be WHERE be.ticker = c.ticker) AS n_book_events, n_trades,
        span_start_us AS span_start, span_end_us AS span_end
      FROM cov c JOIN ma ON ma.ticker = c.ticker""",
    "manifest_sink": f"""WITH {oracle.TOP}{oracle._TRADE_BODY}{oracle._GAP_BODY}{oracle._VERIFY_BODY}{_MANIFEST},
      ln AS (SELECT ticker, CASE WHEN kind = 'trade' THEN 'trade' ELSE 'orderbook' END AS channel, concat(line_no // 500, '.jsonl') AS file FROM msg
        UNION ALL SELECT ticker, CASE WHEN kind = 'trade' THEN 'trade' ELSE 'orderbook' END, concat(line_no // 500, '.jsonl') FROM msg WHERE event_id % 1009 = 1 AND ticker < 'KXSIM-24JAN05'),
      fl AS (SELECT ticker, string_agg(concat(channel, ' ', file, ' ', n), ',' ORDER BY channel, file) AS files FROM (SELECT ticker, channel, file, count(*) AS n FROM ln GROUP BY ALL) GROUP BY ticker),
      nu AS (SELECT ma.ticker, re, raw, (SELECT count(*) FROM gp WHERE gp.ticker = ma.ticker) AS gaps, (SELECT count(*) FROM oc WHERE oc.ticker = ma.ticker AND outcome = 'mismatch') AS mi,
        (SELECT count(*) FROM lvb WHERE lvb.ticker = ma.ticker AND NOT is_snapshot AND qty_before + qty_centi < 0) AS un FROM ma)
      SELECT nu.ticker, (SELECT count(*) FROM msg WHERE msg.ticker = nu.ticker) AS records, re AS read_errors, raw, (SELECT count(*) FROM tr WHERE tr.ticker = nu.ticker) AS trades, gaps,
        (SELECT count(*) FROM top WHERE top.ticker = nu.ticker) AS book_top, (SELECT count(*) FROM be WHERE be.ticker = nu.ticker) AS book_events, un AS underflows,
        concat_ws('; ', CASE WHEN gaps > 0 THEN concat(gaps, ' gaps are recorded: holes are expected there') END, CASE WHEN raw > 0 THEN concat(raw, ' undecoded messages are kept in raw') END,
          CASE WHEN re > 0 THEN concat(re, ' unreadable lines are kept in read_errors') END, CASE WHEN mi > 0 THEN concat(mi, ' observations differ from the replayed book: see verify, and the verify_mismatch gaps') END,
          CASE WHEN un > 0 THEN concat(un, ' changes took a level below zero in replay') END,
          CASE WHEN re = 0 AND raw = 0 THEN 'every record is in the tables: the capture can go once they are verified' ELSE 'the tables are INCOMPLETE: keep the capture until the above is settled' END) AS notes, files
      FROM nu JOIN fl ON fl.ticker = nu.ticker""",
    "discover_order": f"WITH {_QUOTES} SELECT pos, row_number() OVER (ORDER BY volume DESC, pos // 100, pos) AS position FROM pr",
    "mismatch_gaps": f"""WITH {_V}{_SIDES},
      al AS (SELECT ticker, recv_ts_us, seq, last_seq, observed_seq, reason, channel, detail, 0 AS s, file_row FROM gp UNION ALL SELECT ticker, ts, NULL, NULL, NULL, 'verify_mismatch', 'orderbook', detail, 1, i FROM mm)
      SELECT ticker, recv_ts_us, seq, last_seq, observed_seq, reason, channel, detail, row_number() OVER (PARTITION BY ticker ORDER BY recv_ts_us, s, file_row) - 1 AS gap_no FROM al""",
    "market_numbers": f"WITH {_QUOTES} SELECT pos, volume, price, abs(price - 0.5) AS distance, minutes BETWEEN 50 AND 70 AS hourly FROM pr",
    "min_volume": f"WITH {_QUOTES} SELECT pos, ticker FROM pr WHERE volume >= 700",
    "spot_anchor": f"WITH {_QUOTES} SELECT series, arg_min(strike, {{'a': abs(price - 0.5), 'b': pos}}) AS strike FROM pr WHERE status = 'open' AND minutes BETWEEN 50 AND 70 AND strike IS NOT NULL AND price IS NOT NULL GROUP BY series",
    "series_sums": f"WITH {_QUOTES} SELECT series, count(*) AS n_open, sum(volume) AS volume, sum(volume_24h) AS volume_24h FROM pr WHERE status IN ('open', 'active') GROUP BY series",
    "rest_trade_outcomes": """WITH t AS (
        SELECT concat('T', l_orderkey % 9) AS ticker, l_orderkey % 60 AS mi, l_partkey % 100 * 10000 AS price, CAST(l_quantity AS BIGINT) * 100 + 50 AS cnt, l_orderkey % 19 AS b,
          CASE WHEN l_orderkey % 11 IN (1, 2) THEN 'missing or bad yes_price_dollars' WHEN l_orderkey % 13 IN (1, 2) THEN 'missing or bad count_fp' WHEN l_orderkey % 17 IN (1, 2) THEN 'missing or bad taker_outcome_side'
            WHEN l_orderkey % 19 = 1 THEN 'missing or bad taker_book_side' WHEN l_orderkey % 23 IN (1, 2, 3, 4) THEN 'missing or bad created_time' END AS error FROM lineitem)
      SELECT ticker, error, count(*) AS n, CAST(sum(CASE WHEN error IS NULL THEN price END) AS BIGINT) AS price_micro_sum, CAST(sum(CASE WHEN error IS NULL THEN cnt END) AS BIGINT) AS count_centi_sum,
        CAST(sum(CASE WHEN error IS NULL THEN 1704067207250000 + mi * 60000000 END) AS BIGINT) AS event_ts_us_sum, count(*) FILTER (b IN (1, 2, 3)) AS n_book_side FROM t GROUP BY ALL""",
    "unfinished_tickers": f"WITH {oracle.MARKETS} SELECT DISTINCT ticker, series FROM mk WHERE ticker NOT IN (SELECT ticker FROM mk WHERE {oracle._TERMINAL.format(s='status')})",
    "discovery_windows": f"WITH {oracle.MARKETS} SELECT pos, open_us - 7200000000 AS lo_us, open_us + (pos % 5 + 96) * 3600000000 AS hi_us FROM mk",
    "boundary_times": f"WITH {oracle.MSG} SELECT ticker, line_no, (recv_ts_us // 3600000000 + 1) * 3600000000 AS next_us, ((recv_ts_us // {_DAY} + 1) * {_DAY} - recv_ts_us) // 1000000 AS to_midnight_s FROM msg",
    "chunk_counts": f"""WITH {oracle.MSG}, c AS (SELECT {_LO} + k * {_STEP} AS lo_us, least({_LO} + (k + 1) * {_STEP}, {_HI}) AS hi_us FROM range(0, 101) r(k))
      SELECT lo_us, hi_us, (SELECT count(*) FROM msg WHERE recv_ts_us >= lo_us AND recv_ts_us < lo_us + {_STEP}) AS n FROM c""",
    "session_quality": f"WITH {oracle.MSG}{oracle._GAP_BODY}{_MANIFEST} SELECT (SELECT count(*) FROM gp) AS gaps, count(*) FILTER (re > 0 OR raw > 0) AS incomplete FROM ma",
    "backfill_report": """WITH t AS (SELECT concat(l_orderkey, '-', CASE WHEN l_linenumber = 2 THEN 1 ELSE l_linenumber END) AS id, l_orderkey % 29 = 0 AS bad, l_orderkey // 100 AS page FROM lineitem)
      SELECT count(*) AS fetched, count(DISTINCT id) FILTER (NOT bad) AS written, count(*) FILTER (bad) AS raw, count(*) FILTER (NOT bad) - count(DISTINCT id) FILTER (NOT bad) AS duplicates, count(DISTINCT page) AS pages FROM t""",
    "earliest_close": f"WITH {oracle.MARKETS} SELECT min(close_us) AS close_us FROM mk WHERE status = 'open'",
    "team_match": f"""WITH {oracle.MARKETS} SELECT 'event' AS "by", pos FROM mk WHERE event = (SELECT event FROM mk WHERE pos = 1)
      UNION ALL SELECT 'codes', pos FROM mk WHERE contains(concat_ws(' ', event, ticker), 'KXO3') AND contains(concat_ws(' ', event, ticker), 'JAN')""",
    "instants": """WITH t AS (SELECT DISTINCT o_orderkey % 5 AS k, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey END AS s, CASE WHEN o_orderkey % 5 IN (1, 2) THEN date_trunc('day', o_orderdate) END AS dt FROM orders),
      x AS (SELECT CASE k WHEN 0 THEN concat(' ', s, ' ') WHEN 1 THEN strftime(dt, '%Y-%m-%d') WHEN 2 THEN concat(strftime(dt, '%Y-%m-%d'), 'T06:30:00Z') WHEN 3 THEN 'soon' END AS text,
        CASE k WHEN 0 THEN s WHEN 1 THEN CAST(epoch(dt) AS BIGINT) WHEN 2 THEN CAST(epoch(dt) AS BIGINT) + 23400 END AS at_s, k FROM t)
      SELECT text, CAST(at_s AS BIGINT) AS at_s, CAST(at_s + CASE WHEN k = 1 THEN 86400 ELSE 0 END AS BIGINT) AS until_s FROM x""",
}

_QUERIES = (
    malformed_rows, coverage_accounting, manifest_sink, mismatch_gaps, discover_order, market_numbers, min_volume, spot_anchor, series_sums, rest_trade_outcomes, unfinished_tickers, discovery_windows,
    boundary_times, chunk_counts, session_quality, backfill_report, earliest_close, team_match, instants,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
