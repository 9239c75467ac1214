"""Scans and folds cut into segments give what one segment gives, with one ticker over all tasks."""

import random

import pytest
from pyspark.sql import functions as F

from ladderline.operators import asof, book, fold, merge, scan, verify
from ladderline.plans import queries
from ladderline.sources import adapter
from ladderline.sources.scratch import saved

SCHEMA = "ticker string, line_no bigint, recv_ts_us bigint, event_ts_us bigint, seq bigint, sid bigint, kind string, yes array<struct<price:bigint,quantity:bigint>>, no array<struct<price:bigint,quantity:bigint>>, side string, price_micro bigint, delta_centi bigint"


def _messages(spark, seed):
    """Four tickers of unlike length; snapshots that are empty, repeat a price or hold quantity 0; deltas that go below 0."""
    rnd, rows = random.Random(seed), []
    for ticker, n in (("A", 300), ("B", 7), ("C", 1), ("D", 40)):
        for i in range(n):
            if rnd.random() < 0.04:
                side = lambda: [(rnd.randrange(1, 9), rnd.choice([0, 5, 9])) for _ in range(rnd.randrange(4))]
                rows.append((ticker, i, 10 * i, 10 * i, i, 1, "snapshot", side(), side(), None, None, None))
            else:
                rows.append((ticker, i, 10 * i, 10 * i, i, 1, "delta", None, None, rnd.choice(["yes", "no"]), rnd.randrange(1, 9), rnd.choice([-6, -3, 2, 4])))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _all(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("seed,segment", [(1, 1), (2, 5), (3, 64), (4, 13)])
def test_books_in_segments(spark, monkeypatch, seed, segment):
    m = _messages(spark, seed)
    plain = book.flatten(book.number_events(m)).cache()
    forms = (book.book_top, book.book_states, book.replay_levels, book.with_epoch)
    want = [_all(plain)] + [_all(f(plain)) for f in forms]
    monkeypatch.setattr(scan, "SEGMENT", segment)
    cut = book.flatten(book.number_events(m))
    assert [_all(cut)] + [_all(f(cut)) for f in forms] == want


def test_fold_equals_the_walks_of_levels(spark):
    """The ladder after each message is that of the level histories in force."""
    events = book.flatten(book.number_events(_messages(spark, 9))).cache()
    live = book.replay_levels(events).where("qty_after > 0 OR is_snapshot").withColumn("_end", F.coalesce("next_idx", F.col("last_idx") + 1))
    rows = live.select("ticker", F.explode(F.expr("sequence(event_idx, _end - 1)")).alias("event_idx"), "side", "price_micro", "qty_after").collect()
    want = {}
    for r in rows:
        want.setdefault((r.ticker, r.event_idx), {})[(r.side, r.price_micro)] = r.qty_after
    for s in book.book_states(events).collect():
        got = {("yes", x.price): x.quantity for x in s.yes} | {("no", x.price): x.quantity for x in s.no}
        assert got == want.get((s.ticker, s.event_idx), {}), s


def test_only_wanted_ladders_are_built(spark):
    events = book.flatten(book.number_events(_messages(spark, 5)))
    wanted = spark.createDataFrame([("A", 17), ("A", 17), ("B", 0)], "ticker string, event_idx bigint")
    got = book.book_states(events, wanted).collect()
    assert len(got) == events.select("ticker", "event_idx").distinct().count()
    assert {(r.ticker, r.event_idx) for r in got if r.yes is not None} == {("A", 17), ("B", 0)}


def test_streams_and_lookups_in_segments(spark, sf_dir, monkeypatch):
    b, t, g = queries._book(spark, sf_dir), queries._trades(spark, sf_dir), queries._gaps(spark, sf_dir)
    look = lambda: asof.asof_backward(t, b, "ticker", "event_ts_us", "recv_ts_us", "file_row", ["event_idx", "price_micro"])
    t = t.withColumnsRenamed({"price_micro": "p"})
    want = [_all(merge.merged(b, queries._trades(spark, sf_dir), g)), _all(look())]
    monkeypatch.setattr(scan, "SPAN_US", 40_000_000)
    assert [_all(merge.merged(b, queries._trades(spark, sf_dir), g)), _all(look())] == want


def test_lookups_of_ties_nulls_and_empty_sides(spark, monkeypatch):
    left = spark.createDataFrame([("A", 1, 5), ("A", 2, 10), ("A", 3, 90), ("B", 4, 7), (None, 5, 12), ("A", 6, None)], "k string, n int, t bigint")
    right = spark.createDataFrame([("A", 10, 1, "x"), ("A", 10, 2, "y"), ("B", 8, 1, "z"), (None, 11, 1, "w")], "k string, s bigint, o int, v string")
    for span in (3, 1000):
        monkeypatch.setattr(scan, "SPAN_US", span)
        got = {r.n: r.v for r in asof.asof_backward(left, right, "k", "t", "s", "o", ["v"]).collect()}
        assert {n: got[n] for n in (1, 2, 3, 4, 5)} == {1: None, 2: "y", 3: "y", 4: None, 5: "w"} and len(got) == 6
        assert asof.asof_backward(left, right.limit(0), "k", "t", "s", "o", ["v"]).where("v IS NOT NULL").isEmpty()


def test_one_ticker_lies_in_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(scan, "SEGMENT", 500)
    m = spark.range(40_000).selectExpr(
        "'A' AS ticker", "id AS line_no", "id * 10 AS recv_ts_us", "id * 10 AS event_ts_us", "id AS seq", "1L AS sid", "IF(id = 3, 'snapshot', 'delta') AS kind",
        "CAST(NULL AS array<struct<price:bigint,quantity:bigint>>) AS yes", "CAST(NULL AS array<struct<price:bigint,quantity:bigint>>) AS no", "'yes' AS side", "id % 50 AS price_micro", "1L AS delta_centi",
    )
    rows = fold.in_segments(book.flatten(book.number_events(m))).groupBy(F.spark_partition_id()).count().collect()
    sizes = sorted(r["count"] for r in rows)
    assert len(sizes) == 4 and sizes[-1] < 2 * sizes[1]
    last = book.book_top(book.flatten(book.number_events(m))).where("event_idx = 39999").first()
    assert (last.yes_bid_micro, last.yes_levels, last.yes_total_centi) == (49, 50, 39_996)


def test_near_names_all_that_a_check_needs(spark, sf_dir):
    b = saved(queries._book(spark, sf_dir), "b")
    full = saved(book.book_states(b), "full")
    seen = saved(adapter.verify_rows(spark, sf_dir, full), "seen")
    gaps = saved(queries._gaps(spark, sf_dir), "gaps")
    some = saved(book.book_states(b, verify.near(b, seen)), "some")
    assert some.where("yes IS NULL").count() > 0
    assert _all(verify.verify_outcomes(some, seen, gaps)) == _all(verify.verify_outcomes(full, seen, gaps))
