"""Book replay against a dictionary that is updated message by message."""

import random

import pytest

from ladderline.operators import book


def _messages(seed, n=300, tickers=2):
    rnd, rows = random.Random(seed), []
    for t in range(tickers):
        for i in range(n):
            ts = 1_000_000 + i * 1000
            if rnd.random() < 0.06:
                side = lambda: [(rnd.randint(1, 9) * 50000, rnd.choice([0, 5, 100, 300])) for _ in range(rnd.randint(0, 4))]
                rows.append((f"T{t}", i, ts, ts, i, None, "snapshot", side(), side(), None, None, None))
            else:
                rows.append((f"T{t}", i, ts, ts, i, None, "delta", None, None, rnd.choice(["yes", "no"]), rnd.randint(1, 9) * 50000, rnd.randint(-200, 200)))
    return rows


SCHEMA = "ticker string, line_no bigint, recv_ts_us bigint, event_ts_us bigint, seq bigint, sid bigint, kind string, yes array<struct<price:bigint,quantity:bigint>>, no array<struct<price:bigint,quantity:bigint>>, side string, price_micro bigint, delta_centi bigint"


def _fold(rows):
    tops, under, books = {}, {}, {}
    for r in sorted(rows):
        b = books.setdefault(r[0], {"yes": {}, "no": {}})
        if r[6] == "snapshot":
            b["yes"], b["no"] = dict(r[7]), dict(r[8])
        else:
            left = b[r[9]].get(r[10], 0) + r[11]
            under[r[0]] = under.get(r[0], 0) + (left < 0)
            if left > 0:
                b[r[9]][r[10]] = left
            else:
                b[r[9]].pop(r[10], None)
        y, n = b["yes"], b["no"]
        yb, nb = max(y, default=None), max(n, default=None)
        tops[r[0], r[1]] = (yb, y.get(yb, 0), None if nb is None else max(0, 1_000_000 - nb), n.get(nb, 0), sum(y.values()), sum(n.values()), len(y), len(n))
    return tops, under, books


@pytest.mark.parametrize("seed", [1, 2])
def test_top_and_underflows_match_a_fold(spark, seed):
    rows = _messages(seed)
    events = book.flatten(book.number_events(spark.createDataFrame(rows, SCHEMA))).cache()
    tops, under, books = _fold(rows)
    got = {(r.ticker, r.event_idx): (r.yes_bid_micro, r.yes_bid_sz_centi, r.yes_ask_micro, r.yes_ask_sz_centi, r.yes_total_centi, r.no_total_centi, r.yes_levels, r.no_levels) for r in book.book_top(events).collect()}
    assert got == tops
    bad = {r.ticker: r.n for r in book.underflows(book.replay_levels(events)).groupBy("ticker").agg({"underflows": "max"}).toDF("ticker", "n").collect()}
    assert bad == {t: n for t, n in under.items() if n}
    at = {(r.ticker, r.side, r.price_micro): r.qty_centi for r in book.book_at(events, 10**12).collect()}
    assert at == {(t, s, p): q for t, b in books.items() for s in b for p, q in b[s].items() if q > 0}


def test_partitions_do_not_change_the_result(spark):
    events = spark.createDataFrame(_messages(3), SCHEMA)
    out = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(sorted(map(str, book.book_top(book.flatten(book.number_events(events))).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[0] == out[1]


def test_known_top(spark):
    rows = [("A", 0, 1, 1, 0, None, "snapshot", [(450000, 8003183)], [(540000, 8427534)], None, None, None)]
    r = book.book_top(book.flatten(book.number_events(spark.createDataFrame(rows, SCHEMA)))).first()
    assert (r.yes_ask_micro, r.mid_micro, r.spread_micro) == (460000, 455000, 10000)


def test_empty_snapshot_still_counts(spark):
    rows = [("A", 0, 1, 1, 0, None, "snapshot", [], [], None, None, None)]
    events = book.flatten(book.number_events(spark.createDataFrame(rows, SCHEMA)))
    assert events.count() == 1 and events.first().side is None
    r = book.book_top(events).first()
    assert (r.yes_bid_micro, r.yes_levels, r.imbalance) == (None, 0, None)
