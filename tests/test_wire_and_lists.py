import json

import pytest

from ladderline.operators import catalog
from ladderline.sources import lists, wire


def _decode(spark, *frames):
    df = spark.createDataFrame([(i, 5_000_001, f if isinstance(f, str) else json.dumps(f)) for i, f in enumerate(frames)], "i bigint, recv_ts_us bigint, text string")
    return wire.decode_frames(df).orderBy("i").collect()


def test_frames(spark):
    t = "KX-1"
    snap = {"type": "orderbook_snapshot", "sid": 3, "seq": 9, "msg": {"market_ticker": t, "yes_dollars_fp": [["0.0800", "300.00"]], "no_dollars_fp": None}}
    delta = {"type": "orderbook_delta", "seq": 10, "msg": {"market_ticker": t, "price_dollars": "0.96", "delta_fp": "-5.25", "side": "no", "ts_ms": 7}}
    trade = {"type": "trade", "msg": {"market_ticker": t, "yes_price_dollars": "0.5", "count_fp": "4.68", "taker_outcome_side": "yes", "taker_book_side": None, "trade_id": "x"}}
    r = _decode(spark, snap, delta, trade, {"type": "ok"}, {"type": "error", "msg": {"msg": "no"}}, {"type": "new"}, {}, "{", {"type": "trade"})
    assert [x.outcome for x in r] == ["snapshot", "delta", "trade", "control", "error", "raw", "raw", "raw", "raw"]
    assert (r[0].sid, r[0].seq, r[0].yes[0].price, r[0].yes[0].quantity, r[0].no, r[0].event_ts_us) == (3, 9, 80000, 30000, [], 5_000_001)
    assert (r[1].price_micro, r[1].delta_centi, r[1].event_ts_us) == (960000, -525, 7000)
    assert (r[2].count_centi, r[2].taker_book_side, r[2].trade_id, r[2].channel) == (468, None, "x", "trade")


@pytest.mark.parametrize("change", [{"price_dollars": 0.5}, {"price_dollars": "0.1234567"}, {"side": "up"}, {"delta_fp": "abc"}, {"market_ticker": None}])
def test_bad_deltas_are_kept_raw(spark, change):
    good = {"market_ticker": "K", "price_dollars": "0.5", "delta_fp": "1", "side": "yes"}
    (r,) = _decode(spark, {"type": "orderbook_delta", "msg": good | change})
    assert r.outcome == "raw" and r.error and json.loads(r.payload_json)["side"] and r.ticker == (None if "market_ticker" in change else "K")


def test_bad_levels(spark):
    make = lambda lv: {"type": "orderbook_snapshot", "msg": {"market_ticker": "K", "yes_dollars_fp": lv}}
    r = _decode(spark, make("x"), make([["0.1"]]), make([[0.1, "1"]]), make([["0.1", "1"]]), make([]))
    assert [x.outcome for x in r] == ["raw"] * 3 + ["snapshot"] * 2


def test_rest(spark):
    rows = [("K", "a", "4.68", "0.45", "yes", None, "2026-07-03T10:00:00Z"), ("K", "b", "4.68", "0.45", "maybe", None, "2026-07-03T10:00:00Z"), ("K", "c", "4.68", "0.45", "no", "ask", "then")]
    r = wire.rest_trades(spark.createDataFrame(rows, "ticker string, trade_id string, count_fp string, yes_price_dollars string, taker_outcome_side string, taker_book_side string, created_time string")).orderBy("trade_id").collect()
    assert (r[0].price_micro, r[0].count_centi, r[0].seq, r[0].error) == (450000, 468, None, None) and r[1].error and r[2].error
    body = {"orderbooks": [{"ticker": "A", "orderbook_fp": {"yes_dollars": [["0.5", "2"]], "no_dollars": []}}, {"ticker": "B"}, {"orderbook_fp": {}}]}
    b = wire.rest_books(spark.createDataFrame([(json.dumps(body),)], "text string")).collect()
    assert [x.error for x in b] == [None, "missing orderbook_fp", "missing ticker"] and b[0].yes[0].price == 500000


def test_lists(spark, tmp_path):
    good = {"id": "m1", "series": "S", "teams": ["AAA"], "start_utc": "2026-07-03T10:00:00Z"}
    lines = ["﻿" + json.dumps(good), "", json.dumps(good | {"id": "m2", "teams": []}), json.dumps(good | {"more": 1}), "{"]
    (tmp_path / "s.jsonl").write_text("\n".join(lines), encoding="utf-8")
    e = lists.schedule(spark, str(tmp_path / "s.jsonl"))
    assert sorted(str(r.reject) for r in e.collect()) == ["None", "malformed", "malformed", "unresolvable"]
    assert [r.id for r in lists.arm_order(e, 0, 15).collect()] == ["m1"] and lists.arm_order(e, 2**60, 15).count() == 0
    (tmp_path / "p.jsonl").write_text('{"ticker":"A"}\n{"ticker":"A"}\n{"tick')
    assert [r.ticker for r in lists.done_tickers(spark, str(tmp_path / "p.jsonl")).collect()] == ["A"]
    (tmp_path / "m.jsonl").write_text('{"ticker":"A","close_time":"1970-01-01T00:00:01Z"}\n{"ticker":"B"}\n')
    assert lists.markets(spark, str(tmp_path / "m.jsonl"), 0).count() == 1 and lists.markets(spark, str(tmp_path / "m.jsonl")).count() == 2
    assert [lists.duration_s(x) for x in ("300", "90s", "5m", " 1h", "2d")] == [300, 90, 300, 3600, 172800]
    for bad in ("", "5x", "-1", "99999999999999999999d"):
        with pytest.raises(ValueError):
            lists.duration_s(bad)


def test_team_match_and_ladder(spark):
    m = spark.createDataFrame([("E-AB", "E-AB-A"), ("E-CD", "E-CD-C"), (None, "X")], "event string, ticker string")
    assert [r.event for r in catalog.team_match(m, "E-CD", ["A"]).collect()] == ["E-CD"]
    assert [r.event for r in catalog.team_match(m, "gone", ["ab", "E-"]).collect()] == ["E-AB"]
    s = spark.createDataFrame([("e", i, 10.0 * i, None, None) for i in range(7)], "event string, pos bigint, strike double, price double, anchor double")
    assert [r.strike for r in catalog.ladder_band(s, 1).orderBy("strike").collect()] == [20.0, 30.0, 40.0]
    assert catalog.ladder_band(s, 0).count() == 7
