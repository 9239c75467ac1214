"""Row checks of processed tables: what a reader must not take for data.

Each check gives the first fault of a row as text, null where there is none. Rows are never
dropped or mended: callers refuse the table, or list the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest price in micro-dollars that the format holds (unsigned 32 bits).
MOST_PRICE = (1 << 32) - 1


def _null(name: str) -> Column:
    return F.when(F.col(name).isNull(), F.lit(f"column {name} is null"))


def _word(name: str, *words: str) -> Column:
    c = F.col(name)
    return F.when(c.isNotNull() & ~c.isin(*words), F.concat(F.lit(f"{name} is "), c))


def _price(name: str = "price_micro") -> Column:
    c = F.col(name)
    return F.when((c < 0) | (c > MOST_PRICE), F.concat(F.lit(f"{name} out of range: "), c.cast("string")))


def _negative(when: Column, name: str) -> Column:
    return F.when(when & (F.col(name) < 0), F.concat(F.lit(f"{name} is negative: "), F.col(name).cast("string")))


def book_fault() -> Column:
    """Sides are yes or no, prices unsigned 32-bit; snapshots have no negative quantity, deltas
    have a side, a price and a quantity. A snapshot row without side is an empty snapshot."""
    snap = F.col("is_snapshot")
    whole = F.col("side").isNotNull() & F.col("price_micro").isNotNull() & F.col("qty_centi").isNotNull()
    return F.coalesce(
        _word("side", "yes", "no"), _price(), _null("event_idx"), _null("recv_ts_us"), _null("is_snapshot"),
        _negative(snap & whole, "qty_centi"), F.when(~snap & ~whole, F.lit("delta without side, price or quantity")),
    )


def trade_fault() -> Column:
    required = ("count_centi", "recv_ts_us", "event_ts_us", "price_micro", "taker_side")
    return F.coalesce(*[_null(c) for c in required], _word("taker_book_side", "bid", "ask"), _price(), _negative(F.lit(True), "count_centi"), _word("taker_side", "yes", "no"))


def gap_fault() -> Column:
    return F.coalesce(*[_null(c) for c in ("recv_ts_us", "reason", "detail")])


def malformed(book_events: DataFrame, trades: DataFrame, gaps: DataFrame) -> DataFrame:
    """(table, ticker, file_row, detail) of every row with a fault. One scan of each table."""
    parts = [
        df.select(F.lit(name).alias("table"), "ticker", "file_row", fault.alias("detail")).where("detail IS NOT NULL")
        for name, df, fault in (("book_events", book_events, book_fault()), ("trades", trades, trade_fault()), ("gaps", gaps, gap_fault()))
    ]
    return reduce(DataFrame.unionByName, parts)


def checked(df: DataFrame, table: str, fault: Column) -> DataFrame:
    """The same rows, of which a faulty one ends the query where it is read (see ``sources.dataset.typed``)."""
    said = F.concat(F.lit(f"MalformedRow: {table}, "), F.coalesce("ticker", F.lit("null")), F.lit(", row "), F.coalesce(F.col("file_row").cast("string"), F.lit("null")), F.lit(": "), fault)
    return df.withColumn("ticker", F.when(fault.isNull(), F.col("ticker")).otherwise(F.raise_error(said).cast("string")))
