"""A capture tree from JSON lines to processed tables, and what datasets make of them."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ladderline.sources import capture, dataset
from ladderline.sources.process import process_capture
from ladderline.sources.scratch import saved

TS = "2026-07-03T10:00:{:02d}.000000Z"


def _line(kind, sec, data, seq=None, v=2, **more):
    return json.dumps({"v": v, "recv_ts": TS.format(sec), "seq": seq, "sid": 1, "kind": kind, "data": data} | more)


def _tree(base, extra=()):
    ob, tr = base / "KX-26JUL03-T1" / "orderbook", base / "KX-26JUL03-T1" / "trade"
    ob.mkdir(parents=True)
    tr.mkdir()
    snap = {"ticker": "KX-26JUL03-T1", "ts": TS.format(1), "yes": [{"price": 450000, "quantity": 100}], "no": [{"price": 540000, "quantity": 200}]}
    delta = {"ticker": "KX-26JUL03-T1", "ts": TS.format(2), "side": "yes", "price": 460000, "delta": 500}
    day1 = [_line("snapshot", 1, snap, 1), "", _line("delta", 2, delta, 2, note="extra top keys are fine"), *extra]
    (ob / "2026-07-03.jsonl").write_text("\n".join(day1) + "\n")
    (ob / "2026-07-04.jsonl").write_text(_line("delta", 9, delta | {"delta": 100}, 3) + "\n")
    (tr / "2026-07-03.jsonl").write_text(_line("trade", 3, {"ticker": "KX-26JUL03-T1", "ts": TS.format(3), "price": 450000, "count": 5, "taker_side": "yes", "taker_book_side": None, "trade_id": "x"}, 4) + "\n")
    return str(base)


BAD = [
    "not json", _line("delta", 3, {}, v=3), _line("delta", 3, {"ticker": "a", "ts": TS.format(1), "side": "up", "price": 1, "delta": 1}),
    _line("delta", 3, {"ticker": "a", "ts": TS.format(1), "side": "yes", "price": 1, "delta": 1, "more": 1}), _line("delta", 3, {"ticker": "a", "side": "yes", "price": 1, "delta": 1}),
    _line("nonsense", 3, {}), _line("delta", 3, {"ticker": "a", "ts": TS.format(1), "side": "yes", "price": 4294967296, "delta": 1}),
]


def test_strict_decode_keeps_every_bad_line(spark, tmp_path):
    d = capture.decode(capture.capture_lines(spark, _tree(tmp_path, BAD)))
    rows = d.where("error IS NOT NULL").orderBy("line_no").collect()
    assert [r.line_no for r in rows] == list(range(4, 4 + len(BAD)))
    assert rows[1].error.startswith("schema:") and all(r.error.startswith("json parse:") for r in rows if r.line_no != 5)
    assert d.where("error IS NULL").count() == 4


def test_unknown_ticker_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        capture.capture_lines(spark, _tree(tmp_path), ["absent"])


def test_process_and_load(spark, tmp_path):
    m = process_capture(spark, _tree(tmp_path / "in"), str(tmp_path / "out")).first()
    assert (m.records, m.read_errors, m.complete, m.trades, m.book_top, m.two_sided) == (4, 0, True, 1, 3, True)
    ds = dataset.MarketDataset(spark, str(tmp_path / "out"))
    top = {r.event_idx: (r.yes_bid_micro, r.yes_total_centi, r.yes_levels) for r in ds.table("book_top").collect()}
    # The second day goes on with the first day's book.
    assert top[2] == (460000, 700, 2)
    assert [r.kind for r in ds.events().orderBy("pos").collect()] == ["snapshot", "delta", "trade", "delta"]
    assert ds.book_at(2**60).count() == 3 and ds.coverage().first().uptime == 1.0
    assert ds.catalog(since="2026-07-03", until="2026-07-03").count() == 1 and ds.catalog(since="2026-07-04").count() == 0
    with pytest.raises(dataset.InvalidRange):
        ds.between(2, 1)
    with pytest.raises(dataset.MissingTable):
        ds.table("raw")


def test_accounting_and_malformed_rows(spark, tmp_path):
    process_capture(spark, _tree(tmp_path / "in", BAD[:2]), str(tmp_path / "out"))
    ds = dataset.MarketDataset(spark, str(tmp_path / "out"), allow_incomplete=True)
    c = ds.coverage().first()
    assert len(c) == 20 and (c.complete, c.reasons, str(c.date)) == (False, ["2 unreadable lines"], "2026-07-03")
    assert (c.n_book_events, c.n_trades, c.underflows, c.verify_checks, c.verify_mismatches, c.source_path) == (4, 1, 0, 0, 0, str(tmp_path / "out"))
    bad = ds.table("trades").selectExpr("*").withColumn("taker_side", F.lit("up"))
    bad.write.partitionBy("ticker").parquet(str(tmp_path / "bad"))
    os.rename(tmp_path / "out" / "trades", tmp_path / "trades")
    os.rename(tmp_path / "bad", tmp_path / "out" / "trades")
    for read in (ds.events, lambda **k: ds.between(0, 1 << 60, **k)):
        with pytest.raises(dataset.MalformedRow, match="trades, KX-26JUL03-T1, row 3: taker_side is up$"), dataset.typed():
            read().collect()
    assert ds.events(strict=False).count() == 4


def test_index_of_many_datasets(spark, tmp_path):
    for name, bad in (("a", []), ("b", BAD[:1])):
        process_capture(spark, _tree(tmp_path / "in" / name, bad), str(tmp_path / "all" / name))
    for name in ("2026-07-03.tar.gz", "2026-07-05.live.tar.gz", "other.tar.gz", "2026-07-06.tar", "2026-99-99.tar.gz"):
        (tmp_path / "all" / name).write_bytes(b"x")
    ix = dataset.DatasetIndex(spark, str(tmp_path / "all"))
    got = [(r.path.rsplit("/", 1)[1], r.complete, r.reasons, r.book_events, str(r.date)) for r in ix.entries().collect()]
    assert got == [("a", True, [], 4, "2026-07-03"), ("b", False, ["1 unreadable lines"], 4, "2026-07-03")]
    assert ix.entries(complete=False).count() == 1 and ix.entries(since="2026-07-04").count() == 0 and ix.entries(ticker="x").count() == 0
    assert [r.ticker for r in ix.tickers().collect()] == ["KX-26JUL03-T1"]
    assert [str(r.date) for r in ix.tar_entries().collect()] == ["2026-07-03", "2026-07-05"] and ix.tar_entries(until="2026-07-04").count() == 1
    m = spark.read.json(str(tmp_path / "all" / "b" / "manifest")).first()
    assert [(f.channel, f.file, f.records) for f in m.files] == [("orderbook", "2026-07-03.jsonl", 3), ("orderbook", "2026-07-04.jsonl", 1), ("trade", "2026-07-03.jsonl", 1)]
    assert m.notes[0].startswith("1 unreadable") and "INCOMPLETE" in m.notes[-1]
    assert spark.read.json(str(tmp_path / "all" / "b" / "read_errors")).first().raw == "not json"


def test_command_line(spark, tmp_path, capsys):
    from ladderline.__main__ import main

    source = _tree(tmp_path / "cap")
    assert main(["--in", source, "--tickers", "KX-26JUL03-T1", "--format", "feather"]) == 0
    assert json.loads(capsys.readouterr().out)["records"] == 4
    assert main(["--head", f"{source}_processed/trades.feather", "--rows", "1"]) == 0
    schema, n, row = capsys.readouterr().out.strip().split("\n")
    assert "price_micro:bigint" in schema and n == "1 rows" and json.loads(row)["trade_id"] == "x"
    assert main(["--head", f"{source}_processed/book_events"]) == 0 and "4 rows" in capsys.readouterr().out


def test_incomplete_is_refused(spark, tmp_path):
    assert not process_capture(spark, _tree(tmp_path / "in", BAD[:1]), str(tmp_path / "out")).first().complete
    with pytest.raises(dataset.IncompleteData):
        dataset.MarketDataset(spark, str(tmp_path / "out")).events()
    ok = dataset.MarketDataset(spark, str(tmp_path / "out"), allow_incomplete=True)
    assert ok.events().count() == 4 and ok.catalog().first().reasons == ["1 unreadable lines"]


def _spoil(spark, out, table, change):
    """Replace a table of a dataset with a changed copy."""
    rows = change(spark.read.schema(dataset.TABLES[table]).parquet(f"{out}/{table}"))
    rows.write.partitionBy("ticker").parquet(f"{out}-{table}")
    os.rename(f"{out}/{table}", f"{out}-{table}-old")
    os.rename(f"{out}-{table}", f"{out}/{table}")


def _session(spark, tmp_path, sf_dir):
    """Tables of the adapter's tickers, as process_capture lays them out, with a manifest."""
    from ladderline.operators import coverage, trades
    from ladderline.plans import queries
    from ladderline.sources import process

    out = str(tmp_path / "d")
    b, t, g = (saved(x, "x") for x in (queries._book(spark, sf_dir), queries._trades(spark, sf_dir), queries._gaps(spark, sf_dir)))
    none = spark.createDataFrame([], "ticker string, recv_ts_us bigint, outcome string, detail string, event_idx bigint")
    process.write_table(b, f"{out}/book_events", "file_row")
    process.write_table(process.keyframes(b), f"{out}/keyframes", "recv_ts_us")
    process.write_table(trades.tape(t), f"{out}/trades", "file_row")
    process.write_table(coverage.with_mismatch_gaps(g, none), f"{out}/gaps", "gap_no")
    b.select("ticker").distinct().selectExpr("ticker", "1 AS schema_version", "ticker NOT LIKE '%-T3' AS complete", "0 AS read_errors", "0 AS raw").write.json(f"{out}/manifest")
    return out, b, t, g


def _same(a, b):
    return sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(a.columns)).collect()))


def test_ranges_read_from_the_last_snapshots_on(spark, tmp_path, sf_dir):
    from ladderline.operators import book, merge
    from ladderline.plans.queries import T0, T1

    out, b, t, g = _session(spark, tmp_path, sf_dir)
    ds = dataset.MarketDataset(spark, out, allow_incomplete=True)
    for at in (T0, T1, T1 + 10**9, 0):
        assert _same(ds.book_at(at), book.book_at(b, at))
    assert _same(ds.between(T0, T1), merge.between(b, t, g, T0, T1))
    # The bound, for one ticker, is its last snapshot before the instant; before any, all counts.
    one = dataset.MarketDataset(spark, out, tickers=[b.where("ticker NOT LIKE '%-T3'").first().ticker])
    mine = b.where(F.col("ticker") == one.tickers[0])
    want = mine.where(f"is_snapshot AND recv_ts_us < {T1}").agg(F.max("recv_ts_us")).first()[0]
    assert one._opens_us(T1) == want and one._opens_us(0) is None
    plan = one.book_at(T1)._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual(recv_ts_us,{want})" in plan and "PartitionFilters: [isnotnull(ticker" in plan
    assert _same(one.book_at(T1), book.book_at(mine, T1))
    # Without the index everything is read, with the same result.
    os.rename(f"{out}/keyframes", f"{out}-keyframes")
    assert ds._opens_us(T1) is None and _same(ds.book_at(T1), book.book_at(b, T1))


def test_files_and_row_groups_are_in_order(spark, tmp_path, sf_dir):
    import pyarrow.parquet as pq

    out, b, _, _ = _session(spark, tmp_path, sf_dir)
    for d in sorted((tmp_path / "d" / "book_events").glob("ticker=*")):
        rows = [pq.read_table(str(f), columns=["file_row"]).column("file_row").to_pylist() for f in sorted(d.glob("*.parquet"))]
        assert sum(rows, []) == sorted(sum(rows, []))


def test_one_ticker_loads_beside_an_incomplete_one(spark, tmp_path, sf_dir):
    out, b, _, _ = _session(spark, tmp_path, sf_dir)
    bad = b.where("ticker LIKE '%-T3'").first().ticker
    good = b.where("ticker NOT LIKE '%-T3'").first().ticker
    with pytest.raises(dataset.IncompleteData, match=bad):
        dataset.MarketDataset(spark, out).events()
    with pytest.raises(dataset.IncompleteData):
        dataset.MarketDataset(spark, out, tickers=[good, bad]).events()
    with pytest.raises(dataset.UnknownTicker, match="KX-NONE"):
        dataset.MarketDataset(spark, out, tickers=[good, "KX-NONE"])
    ds = dataset.MarketDataset(spark, out, tickers=[good])
    assert {r.ticker for r in ds.events().select("ticker").distinct().collect()} == {good}
    # Faults of tickers that aren't asked for are nobody's business.
    _spoil(spark, out, "book_events", lambda df: df.withColumn("side", F.when(F.col("ticker") == bad, "left").otherwise(F.col("side"))))
    assert ds.events().count() > 0
    ds = dataset.MarketDataset(spark, out, allow_incomplete=True)
    for read in (ds.events, lambda: ds.book_at(1 << 60), lambda: ds.between(0, 1 << 60)):
        with pytest.raises(dataset.MalformedRow, match=f"book_events, {bad}, row .*: side is left"), dataset.typed():
            read().count()


def test_a_step_back_ends_the_query_that_reads_it(spark, tmp_path, sf_dir):
    out, _, _, _ = _session(spark, tmp_path, sf_dir)
    _spoil(spark, out, "book_events", lambda df: df.withColumn("recv_ts_us", F.expr("recv_ts_us - IF(event_idx % 29 = 7, 60000000, 0)")))
    ds = dataset.MarketDataset(spark, out, allow_incomplete=True)
    for read in (ds.events, lambda: ds.between(0, 1 << 60)):
        with pytest.raises(dataset.OrderViolation, match="steps back"), dataset.typed():
            read().count()
    assert ds.events(strict=False).count() > 0
    with pytest.raises(ZeroDivisionError), dataset.typed():
        1 / 0


def test_coverage_without_a_gaps_table_is_unknown(spark, tmp_path, sf_dir):
    out, _, _, _ = _session(spark, tmp_path, sf_dir)
    cols = {c: F.lit(0) for c in ("verify_matched", "verify_mismatch", "verify_skipped", "underflows", "book_events")}
    m = spark.read.json(f"{out}/manifest").withColumns(cols)
    m.write.json(f"{out}-m")
    os.rename(f"{out}/manifest", f"{out}-m-old")
    os.rename(f"{out}-m", f"{out}/manifest")
    os.rename(f"{out}/gaps", f"{out}-gaps")
    rows = dataset.MarketDataset(spark, out).coverage().collect()
    assert rows and all((r.n_gaps, r.hole_us, r.uptime) == (None, None, None) and r.n_trades > 0 and r.span_us > 0 for r in rows)


def test_lines_that_would_end_a_job_are_read_errors(spark):
    """Times without zone or of another form, numbers beyond their type: rows of errors, one by one."""
    line = lambda **k: json.dumps({"v": 2, "recv_ts": "2026-07-03T00:00:00.1234567Z", "kind": "delta", "data": {"ticker": "K", "ts": "2026-07-03T01:00:00+01:00", "side": "yes", "price": 5, "delta": 1}} | k)
    data = lambda **k: {"data": {"ticker": "K", "ts": "2026-07-03T00:00:00Z", "side": "yes", "price": 5, "delta": 1} | k}
    gap = lambda **k: {"kind": "gap", "data": {"reason": "seq_jump", "ticker": "K", "channel": "trade", "detail": ""} | k}
    cases = [
        (line(), None), (line(seq=(1 << 64) - 1), None), (line(seq=1 << 64), "seq"), (line(seq=-1), "seq"), (line(seq=1.5), "seq"), (line(seq=10**60), "seq"), (line(seq=None), None),
        (line(sid="x"), "sid"), (line(sid=1 << 63), "sid"), (line(v=70000), "field v"), (line(recv_ts="2026"), "recv_ts"), (line(recv_ts="2026-07-03T00:00:00"), "recv_ts"),
        (line(recv_ts="2026-13-03T00:00:00Z"), "recv_ts"), (line(recv_ts=5), "recv_ts"), (line(**data(ts="noon")), "ts"), (line(**data(ts="2026-07-03")), "ts"), (line(**data(delta=1 << 63)), "delta"), (line(**data(price=5.5)), "price"),
        (line(kind="snapshot", data={"ticker": "K", "ts": "2026-07-03T00:00:00Z", "yes": [{"price": 5, "quantity": 1.5}], "no": []}), "level"),
        (line(**gap(last_seq=5, observed_seq=(1 << 63) + 1)), None), (line(**gap(last_seq=-5)), "last_seq"), (line(kind="raw", data={"error": "e"}), "payload"), (line(kind="raw", data={"error": "e", "payload": None}), None),
    ]
    rows = spark.createDataFrame([("K", "c", "f", i, t) for i, (t, _) in enumerate(cases)], "ticker string, channel string, file string, line_no bigint, text string")
    got = {r.line_no: r for r in capture.decode(rows).collect()}
    for i, (text, want) in enumerate(cases):
        assert (got[i].error is None) if want is None else (got[i].error is not None and want in got[i].error), (text, got[i].error)
    assert (got[0].recv_ts_us, got[1].seq) == (1783036800123456, -1)
    t = capture.tables(capture.decode(rows))
    assert [(r.last_seq, r.observed_seq) for r in t["gaps"].collect()] == [(5, -(2**63) + 1)]
    assert t["messages"].where("line_no = 0").first().event_ts_us == 1783036800000000 and t["read_errors"].count() == sum(w is not None for _, w in cases)


def test_line_numbers_across_splits(spark, tmp_path):
    """A file in many splits keeps its numbers: long, short and blank lines, with and without a last line feed."""
    want = set()
    for ticker, end in (("KX-A", "\n"), ("KX-B", ""), ("KX-C", "\r\n")):
        lines = [("x" * (i * 37 % 90) if i % 5 else "  " if i % 2 else "") + (f" {i}" if i % 5 else "") for i in range(400)]
        d = tmp_path / "in" / ticker / "orderbook"
        d.mkdir(parents=True)
        (d / "2026-07-01.jsonl").write_text(("\r\n" if end == "\r\n" else "\n").join(lines) + end, newline="")
        want |= {(ticker, n + 1, t) for n, t in enumerate(lines) if t.strip()}
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("777b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "10b")
            df = capture.capture_lines(spark, str(tmp_path / "in"))
            assert size != "777b" or spark.read.text(str(tmp_path / "in" / "*" / "*")).rdd.getNumPartitions() > 8
            got = [(r.ticker, r.line_no, r.text) for r in df.collect()]
            assert len(got) == len(want) and set(got) == want
            one = capture.capture_lines(spark, str(tmp_path / "in"), ["KX-B"]).collect()
            assert {(r.ticker, r.line_no, r.text) for r in one} == {w for w in want if w[0] == "KX-B"}
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
