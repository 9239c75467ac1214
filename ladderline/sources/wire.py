"""Frames of the feed and answers of the REST interface, decoded to records.

Decimals arrive as strings and become scaled whole numbers; anything that doesn't decode is
kept as a ``raw`` outcome with its reason, its payload and the ticker as far as it is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import rfc3339_us
from ..functions.units import parse_delta, parse_price, parse_qty

#: Frame types of the feed, by outcome and channel.
DATA = {"orderbook_snapshot": "orderbook", "orderbook_delta": "orderbook", "trade": "trade"}
CONTROL = ("subscribed", "ok")
#: The last millisecond that counts as a time (year 262142); the first lies as far before 1970.
LAST_MS = 8_210_266_876_799_999


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _is(v: Column, path: str, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(_get(v, path, "variant")) == kind, F.lit(False))


def _text(v: Column, key: str) -> Column:
    """A string field; null if it is absent or not a string."""
    return F.when(_is(v, f"$.{key}", "STRING"), _get(v, f"$.{key}", "string"))


def _levels(v: Column, key: str) -> tuple[Column, Column]:
    """(error, levels) of a list of [price, size] strings; absent or null is an empty side."""
    there = _get(v, f"$.{key}", "variant")
    none = there.isNull() | (F.schema_of_variant(there) == "VOID")
    pairs = _get(v, f"$.{key}", "array<array<variant>>")
    text = F.transform(pairs, lambda p: F.transform(F.slice(p, 1, 2), lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))))
    lv = F.transform(text, lambda p: F.struct(parse_price(F.get(p, F.lit(0))).alias("price"), parse_qty(F.get(p, F.lit(1))).alias("quantity")))
    bad = F.exists(lv, lambda x: x["price"].isNull() | x["quantity"].isNull())
    error = F.when(none, None).when(pairs.isNull(), F.lit(f"{key}: not a list of levels")).when(bad, F.lit(f"{key}: bad level"))
    empty = F.array().cast("array<struct<price:bigint,quantity:bigint>>")
    return error, F.when(none, empty).otherwise(lv)


def decode_frames(frames: DataFrame) -> DataFrame:
    """Frames (text, recv_ts_us, other columns) with outcome, channel, ticker, error and fields.

    outcome: snapshot, delta, trade, control, error (from the server) or raw. Records carry the
    exchange's time if the frame has one (``ts_ms``), else the receive time.
    """
    v, m = F.col("_v"), F.col("_m")
    f = frames.withColumn("_v", F.try_parse_json("text"))
    f = f.withColumn("_m", _get(v, "$.msg", "variant")).withColumn("type", _text(v, "type"))
    ticker = _text(m, "market_ticker")
    ye, yes = _levels(m, "yes_dollars_fp")
    ne, no = _levels(m, "no_dollars_fp")
    side, taker = _text(m, "side"), _text(m, "taker_outcome_side")
    bs = _get(m, "$.taker_book_side", "variant")
    no_bs = bs.isNull() | (F.schema_of_variant(bs) == "VOID")
    book_side = _text(m, "taker_book_side")
    dp, dd = parse_price(_text(m, "price_dollars")), parse_delta(_text(m, "delta_fp"))
    tp, tc = parse_price(_text(m, "yes_price_dollars")), parse_qty(_text(m, "count_fp"))
    need = lambda ok, name: F.when(~F.coalesce(ok, F.lit(False)), F.lit(f"missing or bad {name}"))
    who = need(ticker.isNotNull(), "market_ticker")
    snap_error = F.coalesce(who, ye, ne)
    delta_error = F.coalesce(who, need(side.isin("yes", "no"), "side"), need(dp.isNotNull(), "price_dollars"), need(dd.isNotNull(), "delta_fp"))
    trade_error = F.coalesce(who, need(tp.isNotNull(), "yes_price_dollars"), need(tc.isNotNull(), "count_fp"), need(taker.isin("yes", "no"), "taker_outcome_side"), need(no_bs | book_side.isin("bid", "ask"), "taker_book_side"))
    kind = F.col("type")
    error = (
        F.when(v.isNull(), F.lit("invalid JSON frame")).when(kind.isNull(), F.lit("frame missing string 'type'"))
        .when(kind.isin(*DATA) & m.isNull(), F.lit("frame missing 'msg' object"))
        .when(kind == "orderbook_snapshot", snap_error).when(kind == "orderbook_delta", delta_error).when(kind == "trade", trade_error)
        .when(kind.isin(*CONTROL, "error"), None).otherwise(F.concat(F.lit("unknown frame type "), kind))
    )
    f = f.withColumn("error", error)
    outcome = F.when(F.col("error").isNotNull(), "raw").when(kind.isin(*CONTROL), "control").when(kind == "error", "error").when(kind == "orderbook_snapshot", "snapshot").when(kind == "orderbook_delta", "delta").otherwise("trade")
    ms = F.when(_is(m, "$.ts_ms", "BIGINT"), _get(m, "$.ts_ms", "bigint"))
    ts = F.coalesce(F.when(ms.between(-LAST_MS, LAST_MS), F.try_multiply(ms, F.lit(1000))), F.col("recv_ts_us"))
    number = lambda k: F.when(_is(v, f"$.{k}", "BIGINT"), _get(v, f"$.{k}", "bigint"))
    is_ = lambda k, c: F.when(F.col("outcome") == k, c)
    channel = F.coalesce(*[F.when(kind == k, F.lit(c)) for k, c in DATA.items()])
    return f.withColumn("outcome", outcome).select(
        *frames.columns, "type", "outcome", channel.alias("channel"), ticker.alias("ticker"), "error",
        number("sid").alias("sid"), F.when(number("seq") >= 0, number("seq")).alias("seq"),
        F.when(F.col("outcome") == "snapshot", F.col("recv_ts_us")).when(F.col("outcome").isin("delta", "trade"), ts).alias("event_ts_us"),
        is_("snapshot", yes).alias("yes"), is_("snapshot", no).alias("no"),
        F.coalesce(is_("delta", side), is_("trade", taker)).alias("side"), F.coalesce(is_("delta", dp), is_("trade", tp)).alias("price_micro"),
        is_("delta", dd).alias("delta_centi"), is_("trade", tc).alias("count_centi"), is_("trade", book_side).alias("taker_book_side"), is_("trade", _text(m, "trade_id")).alias("trade_id"),
        F.when(F.col("outcome").isin("raw", "error"), F.coalesce(F.to_json(m), F.to_json(v), F.col("text"))).alias("payload_json"),
    )


def rest_trades(rows: DataFrame) -> DataFrame:
    """Fetched trades (all string columns) to trade rows; ``error`` says why a row is raw."""
    price, count = parse_price(F.col("yes_price_dollars")), parse_qty(F.col("count_fp"))
    ts = rfc3339_us(F.col("created_time"))
    need = lambda ok, name: F.when(~F.coalesce(ok, F.lit(False)), F.lit(f"missing or bad {name}"))
    side, book = F.col("taker_outcome_side"), F.col("taker_book_side")
    error = F.coalesce(need(price.isNotNull(), "yes_price_dollars"), need(count.isNotNull(), "count_fp"), need(side.isin("yes", "no"), "taker_outcome_side"), need(book.isNull() | book.isin("bid", "ask"), "taker_book_side"), need(ts.isNotNull(), "created_time"))
    none = F.lit(None).cast("bigint")
    return rows.select("ticker", "trade_id", ts.alias("event_ts_us"), none.alias("seq"), none.alias("sid"), price.alias("price_micro"), count.alias("count_centi"), side.alias("taker_side"), book.alias("taker_book_side"), error.alias("error"))


def rest_books(bodies: DataFrame) -> DataFrame:
    """Order books of REST answers (text): one row each, with levels or an error and its payload."""
    books = bodies.withColumn("_b", F.explode(F.coalesce(F.try_variant_get(F.try_parse_json("text"), "$.orderbooks", "array<variant>"), F.array().cast("array<variant>"))))
    b = F.col("_b")
    ye, yes = _levels(b, "orderbook_fp.yes_dollars")
    ne, no = _levels(b, "orderbook_fp.no_dollars")
    ticker = _text(b, "ticker")
    error = F.coalesce(F.when(ticker.isNull(), F.lit("missing ticker")), F.when(_get(b, "$.orderbook_fp", "variant").isNull(), F.lit("missing orderbook_fp")), ye, ne)
    ok = error.isNull()
    return books.select(*[c for c in bodies.columns if c != "text"], ticker.alias("ticker"), error.alias("error"), F.when(ok, yes).alias("yes"), F.when(ok, no).alias("no"), F.when(~ok, F.to_json(b)).alias("payload_json"))
