"""Runs over a capture that grows: equal to a run over all of it, without touching what did not change."""

import json
import os

import pytest

from ladderline.sources import dataset, process
from ladderline.sources.process import process_capture, process_new

TS = "2026-07-{:02d}T10:00:{:02d}.000000Z"
TABLES = ("book_events", "keyframes", "book_top", "trades", "gaps", "verify", "raw")


def _line(kind, day, sec, data, seq=None):
    return json.dumps({"v": 2, "recv_ts": TS.format(day, sec), "seq": seq, "sid": 1, "kind": kind, "data": data})


def _book(kind, t, day, sec, yes, no=()):
    levels = lambda of: [{"price": p, "quantity": q} for p, q in of]
    return _line(kind, day, sec, {"ticker": t, "ts": TS.format(day, sec), "yes": levels(yes), "no": levels(no)})


def _delta(t, day, sec, by, seq):
    return _line("delta", day, sec, {"ticker": t, "ts": TS.format(day, sec), "side": "yes", "price": 450000, "delta": by}, seq)


def _trade(t, day, sec, trade_id):
    return _line("trade", day, sec, {"ticker": t, "ts": TS.format(day, sec), "price": 450000, "count": 5, "taker_side": "yes", "trade_id": trade_id}, 50 + sec)


def _put(base, t, channel, day, lines):
    folder = base / t / channel
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"2026-07-{day:02d}.jsonl").write_text("\n".join(lines) + "\n")


def _day_3(base):
    for t in ("KX-26JUL03-T1", "KX-26JUL03-T2"):
        # The last check of the day can't be settled before the next day's records.
        _put(base, t, "orderbook", 3, [_book("snapshot", t, 3, 1, [(450000, 100)], [(540000, 200)]), _delta(t, 3, 2, 7, 2), _book("verify", t, 3, 3, [(450000, 999)])])
        _put(base, t, "trade", 3, [_trade(t, 3, 3, "x")])


def _day_4(base):
    t = "KX-26JUL03-T1"
    _put(base, t, "orderbook", 4, [_delta(t, 4, 1, -50, 3), _line("gap", 4, 2, {"reason": "seq_jump", "ticker": t, "channel": "orderbook", "detail": "d"}), "not json", _line("raw", 4, 3, {"error": "e", "payload": "p"})])
    _put(base, t, "trade", 4, [_trade(t, 4, 3, "y")])
    _put(base, "KX-26JUL04-T3", "orderbook", 4, [_delta("KX-26JUL04-T3", 4, 1, 5, 1)])


def _rows(spark, out):
    got = {}
    for name in TABLES:
        if os.path.exists(f"{out}/{name}"):
            df = spark.read.parquet(f"{out}/{name}")
            got[name] = sorted(map(str, df.select(*sorted(df.columns)).collect()))
    got["manifest"] = sorted(map(str, spark.read.schema(process.MANIFEST).json(f"{out}/manifest").collect()))
    got["read_errors"] = sorted(map(str, spark.read.json(f"{out}/read_errors").collect())) if os.path.exists(f"{out}/read_errors") else []
    return got


def _stamps(out):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(out) for f in names}


def test_days_one_by_one_equal_all_at_once(spark, tmp_path, monkeypatch):
    cap, out, whole = tmp_path / "cap", str(tmp_path / "out"), str(tmp_path / "whole")
    _day_3(cap)
    process_new(spark, str(cap), out)
    first = _stamps(out)
    assert {r.verify_skipped for r in spark.read.json(f"{out}/manifest").collect()} == {1}
    # Nothing new: nothing is written, and the manifest comes back.
    assert process_new(spark, str(cap), out).count() == 2 and _stamps(out) == first

    _day_4(cap)

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(process, "_conclude", dies)
        process_new(spark, str(cap), out)
    # What a killed run has written doesn't count: the next one does it again.
    got = process_new(spark, str(cap), out)
    assert {r.ticker: (r.verify_mismatch, r.verify_skipped, r.read_errors, r.raw) for r in got.collect()} == {
        "KX-26JUL03-T1": (1, 0, 1, 1), "KX-26JUL03-T2": (0, 1, 0, 0), "KX-26JUL04-T3": (0, 0, 0, 0),
    }
    second = _stamps(out)
    same = {f for f in first if "/ticker=KX-26JUL03-T2/" in f and not f.endswith(".crc")}
    assert len(same) >= 5 and all(second.get(f) == first[f] for f in same)
    process_capture(spark, str(cap), whole)
    assert _rows(spark, out) == _rows(spark, whole)
    assert dataset.MarketDataset(spark, out, allow_incomplete=True).events().count() == dataset.MarketDataset(spark, whole, allow_incomplete=True).events().count() == 11


def test_exchanged_and_lost_files(spark, tmp_path):
    cap, out, whole = tmp_path / "cap", str(tmp_path / "out"), str(tmp_path / "whole")
    _day_3(cap)
    _day_4(cap)
    process_new(spark, str(cap), out)
    # Another file of that name without trades of use: the ticker's folder of trades goes.
    t = "KX-26JUL03-T2"
    _put(cap, t, "trade", 3, ["not a trade, but longer than the line which was here before: " + "-" * 400])
    process_new(spark, str(cap), out)
    process_capture(spark, str(cap), whole)
    assert _rows(spark, out) == _rows(spark, whole) and not os.path.exists(f"{out}/trades/ticker={t}")

    # Gone to an archive: tables stay. With new records beside, they can't be made again.
    before = _rows(spark, out)
    os.remove(cap / t / "orderbook" / "2026-07-03.jsonl")
    assert process_new(spark, str(cap), out).count() == 3 and _rows(spark, out) == before
    _put(cap, t, "orderbook", 5, [_delta(t, 5, 1, 1, 9)])
    with pytest.raises(ValueError, match=f"gone or shorter than before: {t};"):
        process_new(spark, str(cap), out)
    assert _rows(spark, out) == before
