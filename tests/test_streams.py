"""Streams: equal to the batch forms over the same records, whatever the micro-batches; timers; restarts."""

import json
import time

import pytest
from pyspark.sql import functions as F

from ladderline.operators import book, sequence, verify
from ladderline.plans import queries
from ladderline.sources import adapter
from ladderline.streaming import replay


def test_streams_agree_with_batch(spark, sf_dir, tmp_path):
    m = adapter.book_messages(spark, sf_dir).selectExpr("*", "'f' AS file")
    m.write.parquet(str(tmp_path / "m"))
    s = replay.book_top_stream(spark.readStream.schema(m.schema).parquet(str(tmp_path / "m")))
    q = s.writeStream.format("memory").queryName("tops").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = book.book_top(book.flatten(book.number_events(adapter.book_messages(spark, sf_dir))))
    assert sorted(map(str, spark.table("tops").select(*batch.columns).collect())) == sorted(map(str, batch.collect()))

    f = queries._frames(spark, sf_dir)
    f.write.parquet(str(tmp_path / "f"))
    s = replay.seq_verdict_stream(spark.readStream.schema(f.schema).parquet(str(tmp_path / "f")))
    q = s.writeStream.format("memory").queryName("seqs").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    cols = ["sid", "line_no", "verdict"]
    assert sorted(map(str, spark.table("seqs").select(*cols).collect())) == sorted(map(str, sequence.verdicts(f).select(*cols).collect()))


def _run(df, name, tmp_path):
    q = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"c_{name}")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    return df.sparkSession.table(name)


def _read(spark, path):
    return spark.readStream.schema(spark.read.parquet(str(path)).schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def _records(spark, sf_dir):
    """Messages, observations and gaps of the adapter in one order, and what the batch form makes of them."""
    m = adapter.book_messages(spark, sf_dir)
    states = book.book_states(book.flatten(book.number_events(m)))
    observed, gaps = adapter.verify_rows(spark, sf_dir, states), queries._gaps(spark, sf_dir)
    want = verify.verify_outcomes(states, observed, gaps).where("outcome <> 'truncated'")
    place = book.number_events(m).select("ticker", "event_idx", "line_no")
    cols = ["ticker", "line_no", "recv_ts_us", "kind", "yes", "no", "side", "price_micro", "delta_centi"]
    some = m.selectExpr("ticker", "2 * line_no AS line_no", *cols[2:])
    seen = observed.join(place, ["ticker", "event_idx"]).selectExpr("ticker", "2 * line_no + 1 AS line_no", "recv_ts_us", "'verify' AS kind", "yes", "no")
    holes = gaps.selectExpr("ticker", "2 * seq AS line_no", "recv_ts_us", "'gap' AS kind")
    rows = some.unionByName(seen, allowMissingColumns=True).unionByName(holes, allowMissingColumns=True)
    return rows.withColumn("file", F.lit("f")), verify.verify_outcomes(states, observed, gaps)


NAMES = ["ticker", "event_idx", "recv_ts_us", "outcome", "match_lag_us"]


@pytest.mark.parametrize("parts", [1, 5])
def test_streamed_checks_agree_with_batch(spark, sf_dir, tmp_path, parts):
    rows, want = _records(spark, sf_dir)
    for i in range(parts):  # the state crosses micro-batches, observations wait across them
        rows.where(F.least(F.expr("line_no div 40"), F.lit(parts - 1)) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "r"))
    got = _run(replay.verify_stream(_read(spark, tmp_path / "r"), delay="1 hour"), f"checks{parts}", tmp_path)
    assert sorted(map(str, got.select(NAMES).collect())) == sorted(map(str, want.where("outcome <> 'truncated'").select(NAMES).collect()))
    assert got.count() > 5 and got.where("settled_by = 'timer'").isEmpty()


def test_streamed_checks_of_long_tickers(spark, tmp_path):
    """Five times as many records a ticker, in small batches, with lags to both sides."""
    rows, want = _records(spark, "/root/testdata/sf0.01")
    rows, want = (x.where("ticker = 'KXSIM-24JAN0312-T2'") for x in (rows, want))
    for i in range(6):
        rows.where(F.expr("line_no div 450") == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "r"))
    got = _run(replay.verify_stream(_read(spark, tmp_path / "r"), delay="1 hour"), "long", tmp_path).collect()
    assert sorted(tuple(r[c] for c in NAMES) for r in got) == sorted(tuple(r[c] for c in NAMES) for r in want.where("outcome <> 'truncated'").collect())
    assert {"matched", "mismatch", "skipped_gap"} <= {r.outcome for r in got} and any((r.match_lag_us or 0) < 0 for r in got)


SCHEMA = "ticker string, file string, line_no bigint, recv_ts_us bigint, kind string, yes array<struct<price:bigint,quantity:bigint>>, no array<struct<price:bigint,quantity:bigint>>, side string, price_micro bigint, delta_centi bigint"
S = 1_000_000


def _snap(t, n, at, levels, kind="snapshot"):
    return (t, "f", n, at * S, kind, levels, [], None, None, None)


def _delta(t, n, at, price, change):
    return (t, "f", n, at * S, "delta", None, None, "yes", price, change)


def _land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))
    time.sleep(1.1)  # files are taken in the order of their times


def test_a_timer_settles_the_observation_of_a_silent_ticker(spark, tmp_path):
    at = tmp_path / "r"
    _land(spark, at, [_snap("A", 1, 10, [(5, 100)]), _snap("A", 2, 12, [(5, 7)], "verify"), _snap("B", 1, 10, [(5, 1)])])
    # A batch runs under the watermark that the batches before it have set.
    _land(spark, at, [_delta("B", 2, 200, 5, 1)])
    _land(spark, at, [_delta("B", 3, 201, 5, 1)])
    _land(spark, at, [_delta("A", 3, 300, 6, 10), _snap("A", 4, 301, [(5, 100), (6, 10)], "verify"), _delta("A", 5, 302, 6, -10), _snap("A", 6, 303, [(5, 100), (6, 10)], "verify")])
    _land(spark, at, [_delta("B", 4, 9000, 5, 1)])
    _land(spark, at, [_delta("B", 5, 9000, 5, 1)])
    # Silent for longer than idle_us: A's book is gone, and its numbering begins anew.
    _land(spark, at, [_delta("A", 7, 9000, 8, 3), _snap("A", 8, 9001, [(8, 3)], "verify"), _snap("A", 9, 9002, [(8, 4)], "verify")])
    _land(spark, at, [_delta("B", 6, 9100, 5, 1)])
    got = _run(replay.verify_stream(_read(spark, at), delay="1 second", idle_us=1000 * S), "silent", tmp_path).collect()
    assert sorted((r.recv_ts_us // S, r.event_idx, r.outcome, r.match_lag_us, r.settled_by) for r in got) == [
        (12, 0, "mismatch", None, "timer"), (301, 1, "matched", 0, "record"), (303, 2, "matched", -3 * S, "record"),
        (9001, 0, "matched", 0, "record"), (9002, 0, "mismatch", None, "timer"),
    ]


def test_a_match_inside_the_window_cancels_the_timer(spark, tmp_path):
    at = tmp_path / "r"
    _land(spark, at, [_snap("A", 1, 10, [(5, 100)]), _snap("A", 2, 12, [(5, 107)], "verify")])
    _land(spark, at, [_delta("A", 3, 16, 5, 7), _snap("A", 4, 30, [(9, 9)], "verify"), ("A", "f", 5, 31 * S, "gap", None, None, None, None, None)])
    _land(spark, at, [_delta("A", 6, 500, 5, 1)])
    got = _run(replay.verify_stream(_read(spark, at), delay="1 second"), "cancelled", tmp_path).collect()
    assert sorted((r.recv_ts_us // S, r.outcome, r.match_lag_us, r.settled_by) for r in got) == [(12, "matched", 4 * S, "record"), (30, "skipped_gap", None, "record")]


def test_a_restart_goes_on_where_the_stream_stopped(spark, sf_dir, tmp_path):
    """Two runs over one checkpoint give what one run gives, each row once."""
    rows, want = _records(spark, sf_dir)
    for i in range(3):
        rows.where(F.least(F.expr("line_no div 50"), F.lit(2)) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "r"))
        out = replay.verify_stream(_read(spark, tmp_path / "r"), delay="1 hour").writeStream.format("parquet").option("path", str(tmp_path / "out"))
        out.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(240)
    got = spark.read.parquet(str(tmp_path / "out")).select(NAMES).collect()
    assert sorted(map(str, got)) == sorted(map(str, want.where("outcome <> 'truncated'").select(NAMES).collect()))


def test_batches_write_changed_levels_only(spark, tmp_path):
    """A deep book costs a batch what it changes: the state has a row a level, and few are rewritten."""
    at = tmp_path / "r"
    deep = [(p, 1) for p in range(1, 400)]
    _land(spark, at, [_snap("A", 1, 1, deep)])
    _land(spark, at, [_delta("A", 2, 2, 7, 5)])
    m = _read(spark, at).withColumns({"event_ts_us": F.col("recv_ts_us"), "seq": F.lit(None).cast("bigint")})
    q = replay.book_top_stream(m).writeStream.format("memory").queryName("deep").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    ops = [p["stateOperators"][0] for p in q.recentProgress if p["numInputRows"]]
    assert ops[-1]["numRowsUpdated"] <= 4 and ops[0]["numRowsUpdated"] > 300
    assert [(r.event_idx, r.yes_bid_micro, r.yes_levels, r.yes_total_centi) for r in spark.table("deep").orderBy("event_idx").collect()] == [(0, 399, 399, 399), (1, 399, 399, 404)]


def test_landed_records_lie_by_ticker_channel_and_day(spark, tmp_path):
    """Capture files to landed JSON lines: the file bound is the back-pressure, the sink's log keeps a restart from writing twice."""
    line = lambda seq, ts: json.dumps({"v": 2, "recv_ts": ts, "seq": seq, "kind": "trade", "data": {"ticker": "KX-A", "ts": ts, "price": 5, "count": 1, "taker_side": "yes"}})
    base = tmp_path / "cap"
    for ticker, day, n in (("KX-A", "2026-07-01", 2), ("KX-A", "2026-07-02", 1), ("bad name!", "2026-07-01", 1)):
        d = base / ticker / "trade"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"{day}.jsonl").write_text("".join(line(i, f"{day}T00:00:0{i}Z") + "\n" for i in range(n)))
    for _ in range(2):
        q = replay.landing_sink(replay.capture_stream(spark, str(base), files_per_trigger=1), str(tmp_path / "out"), str(tmp_path / "c")).start()
        q.awaitTermination(240)
        batches = [p["numInputRows"] for p in q.recentProgress]
        assert all(n <= 1 for n in batches)
    got = spark.read.json(str(tmp_path / "out"))
    assert sorted((r.ticker, r.channel, str(r.day), r.seq) for r in got.collect()) == [
        ("KX-A", "trade", "2026-07-01", 0), ("KX-A", "trade", "2026-07-01", 1), ("KX-A", "trade", "2026-07-02", 0), ("_unsafe", "trade", "2026-07-01", 0),
    ]


def test_streamed_lookups_agree_with_batch(spark, sf_dir, tmp_path):
    """Trades and books in shuffled micro-batches, trades often before the book they need."""
    from ladderline.operators import asof

    t, top = queries._trades(spark, sf_dir).where("seq IS NOT NULL").withColumn("eff_ts_us", F.col("recv_ts_us")), queries.book_top(spark, sf_dir)
    for i in range(3):
        t.where(F.pmod(F.hash("file_row"), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
        top.where(F.pmod(F.hash("event_idx"), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "b"))
    # A later record of each ticker moves time on, so that every trade is settled.
    end = top.groupBy("ticker").agg(F.lit(adapter.EPOCH_US + 10**11).alias("recv_ts_us")).withColumn("event_idx", F.lit(10**9).cast("bigint"))
    for n in (1, 2):
        time.sleep(1.1)
        end.withColumn("recv_ts_us", F.col("recv_ts_us") + n).coalesce(1).write.mode("append").parquet(str(tmp_path / "b"))
    tops = spark.readStream.schema(top.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "b"))
    got = _run(replay.trade_book_stream(_read(spark, tmp_path / "t"), tops, delay="1 day"), "asof", tmp_path)
    got = got.select("ticker", F.get_json_object("row", "$.file_row").cast("bigint").alias("file_row"), "event_idx", "yes_bid_micro", "yes_ask_micro")
    want = asof.asof_backward(t, top, "ticker", "eff_ts_us", "recv_ts_us", "event_idx", ["event_idx", "yes_bid_micro", "yes_ask_micro"]).select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 100


def test_streamed_trades_merge_in_any_order(spark, sf_dir, tmp_path):
    from ladderline.operators import trades

    t = queries._trades(spark, sf_dir)
    for i in (2, 0, 1):  # fetched copies before, with and after those of the stream
        t.where(F.pmod(F.hash("file_row", "ticker"), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    for _ in range(2):  # nothing new the second time
        replay.merged_trades_stream(_read(spark, tmp_path / "t"), str(tmp_path / "out"), str(tmp_path / "c")).start().awaitTermination(240)
    got = replay.compacted_trades(spark, str(tmp_path / "out"))
    want = trades.dedup(t).select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_streamed_gap_markers(spark, tmp_path):
    f = spark.createDataFrame([("c", 1, "snapshot", 10, "orderbook", 5), ("c", 2, "delta", 12, "orderbook", 6), ("d", 1, "delta", 3, "trade", 7), ("d", 2, "delta", 9, "trade", 8)], "sid string, line_no bigint, kind string, seq bigint, channel string, recv_ts_us bigint")
    f.write.parquet(str(tmp_path / "f"))
    r = spark.createDataFrame([("c", 20)], "sid string, recv_ts_us bigint")
    r.write.parquet(str(tmp_path / "r"))
    tickers = spark.createDataFrame([("c", "A"), ("c", "B"), ("d", "C")], "sid string, ticker string")
    read = lambda name, df: spark.readStream.schema(df.schema).parquet(str(tmp_path / name))
    got = _run(replay.gap_marker_stream(read("f", f), read("r", r), tickers), "marks", tmp_path)
    assert sorted((x.ticker, x.kind, x.channel, x.recv_ts_us) for x in got.collect()) == [
        ("A", "reconnect", "orderbook", 20), ("A", "reconnect", "trade", 20), ("A", "seq_jump", "orderbook", 6),
        ("B", "reconnect", "orderbook", 20), ("B", "reconnect", "trade", 20), ("B", "seq_jump", "orderbook", 6), ("C", "seq_jump", "trade", 8),
    ]
