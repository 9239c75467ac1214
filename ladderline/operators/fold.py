"""Books by folding their changes once, in order.

Rows of a ticker are cut into segments of messages; a segment's rows, sorted, run through one pass
over Arrow batches that holds nothing but the ladder. Where a ticker has several segments, each
begins with the ladder that those before it leave. That needs no fold: the changes of a level in a
segment act on its quantity as q -> max(q + S, M), with S their sum and M = S - min of the running
sums, and such maps compose by sums and maxima. A snapshot makes the map constant. So the cost is
rows, whatever the depth of the book or the length of an epoch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scan

_LADDER = pa.list_(pa.struct([("price", pa.int64()), ("quantity", pa.int64())]))
_ROW = ("ticker", "_seg", "_lane", "event_idx", "recv_ts_us", "event_ts_us", "seq", "is_snapshot", "side", "price_micro", "qty_centi", "_want")


def opening_levels(rows: DataFrame) -> DataFrame:
    """(ticker, _seg, side, price_micro, qty_centi): the ladder with which each segment begins.

    rows: book events with ``_seg``. Only tickers of several segments take part.
    """
    ends = rows.groupBy("ticker").agg(F.max("_seg").alias("_last"))
    segs = rows.groupBy("ticker", "_seg").agg(F.max(F.when(F.col("is_snapshot"), F.col("event_idx"))).alias("_snap"))
    segs = segs.join(ends.where("_last > 0"), "ticker")
    by = Window.partitionBy("ticker").orderBy("_seg")
    # A segment with a snapshot begins a generation; the ladder of one lasts to the first segment of the next.
    segs = segs.withColumn("_gen", F.count("_snap").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    stop = F.lead("_first").over(Window.partitionBy("ticker").orderBy("_gen"))
    gens = segs.groupBy("ticker", "_gen").agg(F.min("_seg").alias("_first"), F.first("_last").alias("_last")).select("ticker", "_gen", F.coalesce(stop, F.col("_last")).alias("_stop"))

    r = rows.where("side IS NOT NULL").join(segs.select("ticker", "_seg", "_snap", "_gen"), ["ticker", "_seg"]).where("_snap IS NULL OR event_idx >= _snap")
    level = Window.partitionBy("ticker", "_seg", "side", "price_micro").orderBy("event_idx", "file_row")
    # Of a price that repeats inside a snapshot the last row counts.
    r = r.withColumn("_next", F.lead("event_idx").over(level)).where("NOT is_snapshot OR _next IS NULL OR _next <> event_idx")
    r = r.withColumn("_run", F.sum("qty_centi").over(level.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    m = r.groupBy("ticker", "_gen", "_seg", "side", "price_micro").agg(
        F.sum("qty_centi").alias("_s"), (F.sum("qty_centi") - F.min("_run")).alias("_m"), F.count_if(~F.col("is_snapshot")).alias("_d")
    )
    g = Window.partitionBy("ticker", "_gen", "side", "price_micro").orderBy("_seg")
    so_far = g.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = m.withColumns({"_t": F.sum("_s").over(so_far), "_changes": F.sum("_d").over(so_far), "_until": F.lead("_seg").over(g)})
    m = m.withColumn("qty_centi", F.col("_t") + F.greatest(F.lit(0), F.max(F.col("_m") - F.col("_t")).over(so_far)))
    # An empty level of a snapshot stands until something changes it.
    m = m.where("qty_centi > 0 OR _changes = 0").join(gens, ["ticker", "_gen"]).withColumn("_to", F.coalesce("_until", "_stop")).where("_to > _seg")
    return m.select("ticker", F.explode(F.expr("sequence(_seg + 1, _to)")).alias("_seg"), "side", "price_micro", F.col("qty_centi").cast("bigint").alias("qty_centi"))


def in_segments(book_events: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Book events in the order of a fold, before each segment the ladder it begins with.

    wanted: (ticker, event_idx) of messages whose ladders are asked for.
    """
    rows = book_events.withColumn("_seg", scan.by_position("event_idx"))
    # One number, by a scan of one column: where no ticker has a second segment, none has an opening ladder.
    most = rows.agg(F.max("_seg")).first()[0]
    open_ = opening_levels(rows).withColumns({"_lane": F.lit(0), "is_snapshot": F.lit(False)}) if most else None
    rows = rows.withColumn("_lane", F.lit(1))
    if wanted is None:
        rows = rows.withColumn("_want", F.lit(False))
    else:
        mark = wanted.select("ticker", "event_idx").distinct().withColumn("_want", F.lit(True))
        rows = rows.join(mark, ["ticker", "event_idx"], "left").withColumn("_want", F.coalesce("_want", F.lit(False)))
    both = rows if open_ is None else rows.unionByName(open_, allowMissingColumns=True)
    n = int(book_events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both.repartition(n, "ticker", "_seg").sortWithinPartitions("ticker", "_seg", "_lane", "event_idx", "file_row").select(*_ROW)


class Side:
    """Levels of a side by price, with their best, total and number."""

    __slots__ = ("levels", "best", "total")

    def __init__(self):
        self.levels, self.best, self.total = {}, None, 0

    def put(self, price: int, quantity: int) -> None:
        self.total += quantity - self.levels.get(price, 0)
        self.levels[price] = quantity
        if self.best is None or price > self.best:
            self.best = price

    def change(self, price: int, by: int) -> None:
        left = self.levels.get(price, 0) + by
        if left > 0:
            self.put(price, left)
        elif price in self.levels:
            self.total -= self.levels.pop(price)
            if price == self.best:
                self.best = max(self.levels, default=None)

    def figures(self) -> tuple:
        """Best price, its quantity, total, number; nulls for an empty side."""
        if self.best is None:
            return None, None, None, None
        return self.best, self.levels[self.best], self.total, len(self.levels)

    def ladder(self) -> tuple[list[int], list[int]]:
        """Prices, ascending, and their quantities."""
        prices = sorted(self.levels)
        return prices, [self.levels[p] for p in prices]


def _column(values: tuple, type_: pa.DataType) -> pa.Array:
    """Values as an Arrow array; ladders by their flat prices and quantities."""
    if type_ != _LADDER:
        return pa.array(values, type_)
    there = [v for v in values if v is not None]
    flat = [np.fromiter(chain.from_iterable(v[i] for v in there), np.int64) for i in (0, 1)]
    ends = np.cumsum([0, *[0 if v is None else len(v[0]) for v in values]]).astype(np.int32)
    none = pa.array([v is None for v in values], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(x) for x in flat], ["price", "quantity"]), type=_LADDER, mask=none)


def folded(batches: Iterator[pa.RecordBatch], emit: Callable[[Side, Side, bool], tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """One row per message: its ticker, event_idx, times, seq, kind, then what ``emit`` makes of both sides.

    batches: rows of ``in_segments``. Memory: one ladder and one batch.
    """
    place, message, yes, no, out = None, None, Side(), Side(), []

    def batch() -> pa.RecordBatch:
        cols = zip(*out, strict=True) if out else [()] * len(types)
        return pa.RecordBatch.from_arrays([_column(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    for b in batches:
        for ticker, seg, lane, idx, recv, event, seq, snap, side, price, qty, want in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if lane == 1 and message is not None and (ticker, idx) == message[:2]:
                pass
            else:
                if message is not None:
                    out.append((*message[:-1], *emit(yes, no, message[-1])))
                    message = None
                if (ticker, seg) != place:
                    place, yes, no = (ticker, seg), Side(), Side()
                if lane == 1:
                    message = (ticker, idx, recv, event, seq, "snapshot" if snap else "delta", want)
                    if snap:
                        yes, no = Side(), Side()
            if side is None:
                continue
            s = yes if side == "yes" else no
            if snap or lane == 0:
                s.put(price, qty)
            else:
                s.change(price, qty)
        yield batch()
        out = []
    if message is not None:
        out.append((*message[:-1], *emit(yes, no, message[-1])))
        yield batch()


_KEY = {"ticker": pa.string(), "event_idx": pa.int64(), "recv_ts_us": pa.int64(), "event_ts_us": pa.int64(), "seq": pa.int64(), "event": pa.string()}
_KEY_SQL = "ticker string, event_idx bigint, recv_ts_us bigint, event_ts_us bigint, seq bigint, event string"
_TOP = ("yb", "ybs", "yt", "yl", "nb", "nbs", "nt", "nl")


def best_levels(book_events: DataFrame) -> DataFrame:
    """Per message: yb, nb (best prices), ybs, nbs (their quantities), yt, nt (totals), yl, nl (numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit = lambda yes, no, _: (*yes.figures(), *no.figures())
        return folded(batches, emit, [*_KEY, *_TOP], [*_KEY.values(), *[pa.int64()] * len(_TOP)])

    return in_segments(book_events).mapInArrow(run, _KEY_SQL + "".join(f", {c} bigint" for c in _TOP))


def ladders(book_events: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per message: yes and no, arrays of price and quantity, ascending; null where it isn't wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit = lambda yes, no, want: (yes.ladder(), no.ladder()) if want else (None, None)
        return folded(batches, emit, [*_KEY, "yes", "no"], [*_KEY.values(), _LADDER, _LADDER])

    level = "array<struct<price:bigint,quantity:bigint>>"
    return in_segments(book_events, wanted).mapInArrow(run, f"{_KEY_SQL}, yes {level}, no {level}")
