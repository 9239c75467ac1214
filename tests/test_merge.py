"""The literal mixed session: merge order, dedup, ranges, gaps and holes."""

import pytest

from ladderline.operators import book, coverage, merge, sequence, trades, verify

B = "ticker string, event_idx bigint, recv_ts_us bigint, event_ts_us bigint, seq bigint, sid bigint, is_snapshot boolean, side string, price_micro bigint, qty_centi bigint, file_row bigint"
ROWS = [
    (1, 1000000, 1, True, "yes", 450000, 1000), (1, 1000000, 1, True, "no", 540000, 800), (2, 1100000, 2, False, "yes", 450000, -200), (3, 1200000, 3, False, "no", 530000, 400),
    (4, 1500000, 5, True, "yes", 455000, 900), (4, 1500000, 5, True, "no", 535000, 700), (5, 1700000, 6, False, "yes", 455000, 300), (6, 1900000, 7, False, "no", 535000, -100),
]
TRADES = [
    (1150000, 1140000, 2, 450000, 500, "yes", "bid", "t1"), (1800000, 1790000, 6, 455000, 250, "no", "ask", "t2"),
    (9000000000, 1140000, None, 451000, 500, "yes", None, "t1"), (9000000000, 1350000, None, 452000, 100, "no", None, "t3"),
]


@pytest.fixture(scope="module")
def session(spark):
    b = spark.createDataFrame([("A", i, t, t, s, None, snap, side, p, q, n) for n, (i, t, s, snap, side, p, q) in enumerate(ROWS)], B)
    t = spark.createDataFrame([("A", *r, n) for n, r in enumerate(TRADES)], "ticker string, recv_ts_us bigint, event_ts_us bigint, seq bigint, price_micro bigint, count_centi bigint, taker_side string, taker_book_side string, trade_id string, file_row bigint")
    g = spark.createDataFrame([("A", 1300000, 4, "seq_jump", "orderbook", "seq jumped 3 -> 5", 0)], "ticker string, recv_ts_us bigint, seq bigint, reason string, channel string, detail string, file_row bigint")
    return b, t, g


def test_dedup_takes_position_and_fields_from_different_copies(session):
    got = {r.trade_id: r for r in trades.dedup(session[1]).collect()}
    assert len(got) == 3
    assert (got["t1"].eff_ts_us, got["t1"].price_micro, got["t1"].source, got["t1"].taker_book_side) == (1150000, 451000, "ws", "bid")
    assert got["t3"].source == "rest_backfill" and got["t3"].eff_ts_us == 1350000


def test_merge_order(session):
    rows = merge.merged(*session).orderBy("pos").collect()
    kinds = [(r.ts, r.kind) for r in rows]
    assert kinds.index((1300000, "gap")) < kinds.index((1350000, "trade")) < kinds.index((1500000, "snapshot"))
    assert [r.ts for r in rows] == sorted(r.ts for r in rows) and len(rows) == 10


def test_between_opens_with_the_gap_and_the_book(session):
    rows = merge.between(*session, 1400000, 10**12).orderBy("lead", "pos").collect()
    assert [(r.lead, r.kind, r.event_idx) for r in rows[:2]] == [(0, "gap", 0), (1, "snapshot", -1)]
    assert rows[1].n_levels == 3
    with pytest.raises(ValueError):
        merge.between(*session, 5, 5)


def _fold(rows):
    """Top of book after each book message of a stream, by its ticker and event_idx."""
    books, out = {}, {}
    for r in rows:
        b = books.setdefault(r.ticker, {})
        if r.kind == "snapshot":
            b.clear()
            b.update({(x.side, x.price_micro): x.qty_centi for x in r.levels})
        elif r.kind == "delta":
            key = (r.side, r.price_micro)
            b[key] = max(0, b.get(key, 0) + r.qty_centi)
            if not b[key]:
                del b[key]
        else:
            continue
        best = {s: max((p for side, p in b if side == s), default=None) for s in ("yes", "no")}
        out[r.ticker, r.event_idx] = (best["yes"], None if best["no"] is None else 1_000_000 - best["no"], sum(q for (s, _), q in b.items() if s == "yes"), len(b))
    return out


def test_the_stream_rebuilds_the_book(spark, sf_dir):
    from ladderline.plans import queries

    b, t, g = queries._book(spark, sf_dir), queries._trades(spark, sf_dir), queries._gaps(spark, sf_dir)
    want = {(r.ticker, r.event_idx): (r.yes_bid_micro, r.yes_ask_micro, r.yes_total_centi, r.yes_levels + r.no_levels) for r in book.book_top(b).collect()}
    assert _fold(merge.merged(b, t, g).orderBy("ticker", "pos").collect()) == want
    part = _fold(merge.between(b, t, g, queries.T0, queries.T1).orderBy("ticker", "lead", "pos").collect())
    inside = {k: v for k, v in part.items() if k[1] >= 0}
    assert inside and all(want[k] == v for k, v in inside.items())


def test_book_at_is_strict(session):
    at = lambda t: {(r.side, r.price_micro): r.qty_centi for r in book.book_at(session[0], t).collect()}
    assert at(1100000) == {("yes", 450000): 1000, ("no", 540000): 800}
    assert at(1100001)[("yes", 450000)] == 800


def test_order_violation(session, spark):
    b, _, g = session
    assert merge.order_violations(b, g).count() == 0
    assert merge.order_violations(b.withColumn("recv_ts_us", b.recv_ts_us - (b.event_idx == 3).cast("bigint") * 500000), g).count() == 1


def test_holes_and_uptime(spark, session):
    b, t, _ = session
    g = spark.createDataFrame([("A", 1200000, 1, "seq_jump", "orderbook", "", 0), ("A", 1300000, 2, "seq_jump", "orderbook", "", 1), ("A", 1800000, 3, "reconnect", "trade", "", 2), ("A", 9000000, 4, "reconnect", "trade", "", 3)], "ticker string, recv_ts_us bigint, seq bigint, reason string, channel string, detail string, file_row bigint")
    c = coverage.coverage(b.select("ticker").distinct(), b, t, g).first()
    # 1.2 .. 1.5 s (two gaps, one union) and 1.8 .. 1.9 s (to the end of the span).
    assert (c.hole_us, c.span_us, c.n_gaps, c.n_unresolved) == (400000, 900000, 4, 2)
    assert c.uptime == pytest.approx(1 - 4 / 9)
    span = coverage.spans(b.select("ticker").distinct(), b, t)
    assert [r.hole_us for r in coverage.holes(g, b, span).orderBy("recv_ts_us").collect()] == [300000, 200000, 100000, None]


def test_sequence_verdicts(spark):
    rows = [(1, "snapshot", 10), (2, "delta", 11), (3, "delta", 11), (4, "delta", 14), (5, "delta", None), (6, "delta", 15), (7, "snapshot", None), (8, "delta", 3), (9, "delta", 5)]
    f = spark.createDataFrame([("c", *r) for r in rows], "sid string, line_no bigint, kind string, seq bigint")
    assert [r.verdict for r in sequence.verdicts(f).orderBy("line_no").collect()] == ["accept", "accept", "duplicate", "gap", "accept", "accept", "accept", "accept", "gap"]


def test_verify_outcomes(spark):
    lv = "array<struct<price:bigint,quantity:bigint>>"
    s = spark.createDataFrame([("A", 0, 0, 0, [(1, 1)], []), ("A", 1, 0, 1_000_000, [(1, 2)], []), ("A", 2, 0, 2_000_000, [(1, 3)], []), ("A", 3, 0, 30_000_000, [(1, 4)], [])], f"ticker string, event_idx bigint, epoch bigint, recv_ts_us bigint, yes {lv}, no {lv}")
    g = spark.createDataFrame([], "ticker string, recv_ts_us bigint")

    def verdict(i, ts, book_, gaps=g):
        o = spark.createDataFrame([("A", i, ts, book_, [])], f"ticker string, event_idx bigint, recv_ts_us bigint, yes {lv}, no {lv}")
        r = verify.verify_outcomes(s, o, gaps).first()
        return r.outcome, r.match_lag_us

    assert verdict(1, 1_000_001, [(1, 2)]) == ("matched", 0)
    assert verdict(1, 1_000_001, [(1, 1)]) == ("matched", -1_000_001)
    assert verdict(1, 1_000_001, [(1, 3)]) == ("matched", 999_999)
    assert verdict(2, 2_000_001, [(9, 9)]) == ("mismatch", None)
    assert verdict(3, 30_000_001, [(9, 9)]) == ("truncated", None)
    late = spark.createDataFrame([("A", 500_000)], "ticker string, recv_ts_us bigint")
    assert verdict(1, 1_000_001, [(1, 2)], late) == ("skipped_gap", None)
