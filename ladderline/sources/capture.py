"""Captures: append-only JSONL, one envelope a line, below <base>/<ticker>/<channel>/<day>.jsonl.

An envelope is ``{"v", "recv_ts", "seq"?, "sid"?, "kind", "data"}``. Decoding is strict where
it matters and drops nothing: a line that can't be used becomes a row of ``read_errors`` with
its line number, class of error and text. Keys at the top that are not known are ignored;
unknown keys inside ``data`` are errors.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.naming import rfc3339_us
from ..functions.units import I64_MAX, U32_MAX
from ..operators import scan

#: The newest envelope version, the largest number of its fields, the words of its vocabularies.
ENVELOPE_VERSION = 2
U16_MAX, U64_MAX = (1 << 16) - 1, (1 << 64) - 1
SIDES, BOOK_SIDES = ("yes", "no"), ("bid", "ask")
GAP_REASONS = ("seq_jump", "reconnect", "verify_mismatch")
CHANNELS = ("orderbook", "trade")

#: Numbers beyond 64 bits, or with a fraction, must be told from good ones: hence decimals.
_LEVELS = "ARRAY<STRUCT<price: BIGINT, quantity: DECIMAL(38,9)>>"
#: Per kind: schema of data, required keys, optional keys.
KINDS: dict[str, tuple[str, tuple[str, ...], tuple[str, ...]]] = {
    "snapshot": (f"ticker STRING, ts STRING, yes {_LEVELS}, no {_LEVELS}", ("ticker", "ts", "yes", "no"), ()),
    "verify": (f"ticker STRING, ts STRING, yes {_LEVELS}, no {_LEVELS}", ("ticker", "ts", "yes", "no"), ()),
    "delta": ("ticker STRING, ts STRING, side STRING, price BIGINT, delta BIGINT", ("ticker", "ts", "side", "price", "delta"), ()),
    "trade": (
        "ticker STRING, ts STRING, price BIGINT, count DECIMAL(38,9), taker_side STRING, taker_book_side STRING, trade_id STRING",
        ("ticker", "ts", "price", "count", "taker_side"), ("taker_book_side", "trade_id"),
    ),
    "gap": (
        "reason STRING, ticker STRING, channel STRING, last_seq DECIMAL(38,9), observed_seq DECIMAL(38,9), detail STRING",
        ("reason", "ticker", "channel", "detail"), ("last_seq", "observed_seq"),
    ),
    "raw": ("raw_type STRING, ticker STRING, error STRING, payload STRING", ("error", "payload"), ("raw_type", "ticker")),
}


def capture_files(spark: SparkSession, base: str) -> DataFrame:
    """ticker, channel, file, folder (the ticker's), bytes and modified (time) of each file, from listings alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").load(base)
    part = lambda i: F.regexp_extract("path", r"^(.*/([^/]+))/([^/]+)/([^/]+\.jsonl)$", i)
    return files.select(part(2).alias("ticker"), part(3).alias("channel"), part(4).alias("file"), part(1).alias("folder"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def capture_lines(spark: SparkSession, base: str | list[str], tickers: list[str] | None = None) -> DataFrame:
    """ticker, channel, file, line_no (from 1) and text of every line that is not blank.

    base: the capture's folder, or those of some tickers, which alone are listed then.

    Files are read in splits. A line's place in its split comes from the order in which the scan
    gives rows, and the lines of the splits before it, counted by a scan of their own, are added: a
    row a split, so a ticker-day of any size is many tasks. Blank lines count in the numbers.
    Tickers asked for but absent are an error.
    """
    files = spark.read.format("text").option("lineSep", "\n").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").load(base)
    path = F.col("_metadata.file_path")
    at = files.select(
        F.regexp_extract(path, r"([^/]+)/([^/]+)/([^/]+)\.jsonl$", 1).alias("ticker"), F.regexp_extract(path, r"([^/]+)/([^/]+)\.jsonl$", 1).alias("channel"),
        F.regexp_extract(path, r"([^/]+\.jsonl)$", 1).alias("file"), path.alias("_path"), F.col("_metadata.file_block_start").alias("_block"), F.col("value"),
    )
    if tickers:
        found = {r[0] for r in at.select("ticker").where(F.col("ticker").isin(*tickers)).distinct().collect()}
        if missing := sorted(set(tickers) - found):
            raise ValueError(f"no capture of {', '.join(missing)}")
        at = at.where(F.col("ticker").isin(*tickers))
    at = at.withColumn("_place", F.monotonically_increasing_id())
    splits = at.groupBy("_path", "_block").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select(F.col("_path").alias("_of"), F.col("_block").alias("_start"), (before - F.col("_first") + 1).alias("_shift"))
    # A row for each split of the input: some 100 bytes for each 128 MB.
    lines = at.join(F.broadcast(splits), (F.col("_path") == F.col("_of")) & (F.col("_block") == F.col("_start")))
    text = F.regexp_replace("value", "\r$", "")
    return lines.select("ticker", "channel", "file", (F.col("_place") + F.col("_shift")).cast("bigint").alias("line_no"), text.alias("text")).where(F.trim("text", F.lit(" \t\r")) != "")


def _levels_bad(c: Column) -> Column:
    return F.coalesce(F.exists(c, lambda l: l.isNull() | l["price"].isNull() | l["quantity"].isNull() | ~l["price"].between(0, U32_MAX) | ~_whole(l["quantity"], I64_MAX)), F.lit(False))


def _whole(c: Column, most: int | Decimal) -> Column:
    return c.between(0, F.lit(most)) & (c == F.floor(c))


def _u64(c: Column) -> Column:
    """An unsigned 64-bit number as the signed one of the same bits, which tables hold; null if it is no such number."""
    most = Decimal(U64_MAX)
    signed = F.when(c > I64_MAX, c - F.lit(most) - 1).otherwise(c)
    return F.when(_whole(c, most), signed.try_cast("bigint"))


def _unusable(keys: Column, text: Column, name: str, value: Column) -> Column:
    """Whether an optional field is there, isn't null, and its value (null: none) can't be used."""
    return F.array_contains(keys, name) & F.get_json_object(text, f"$.{name}").isNotNull() & value.isNull()


def _data_error(kind: str, data: Column, text: Column) -> Column:
    """Null where data of that kind is well formed, else what is wrong with it."""
    _, need, may = KINDS[kind]
    keys = F.json_object_keys(text)
    known = F.array(*[F.lit(k) for k in need + may])
    # A key present with a null, or with a value of another type, parses to null.
    lost = [k for k in need if k not in ("payload",)]
    e = F.when(keys.isNull(), F.lit("schema: data is not an object")).when(F.size(F.array_except(keys, known)) > 0, F.concat(F.lit("schema: unknown field "), F.element_at(F.array_except(keys, known), 1)))
    for k in lost:
        e = e.when(data[k].isNull(), F.lit(f"schema: missing or bad field {k}"))
    if "payload" in need:  # which may be null, but not absent
        e = e.when(~F.array_contains(keys, "payload"), F.lit("schema: missing or bad field payload"))
    if "ts" in need:
        e = e.when(rfc3339_us(data["ts"]).isNull(), F.lit("schema: bad field ts"))
    if kind in ("snapshot", "verify"):
        e = e.when(_levels_bad(data["yes"]) | _levels_bad(data["no"]), F.lit("schema: bad level"))
    if kind in ("delta", "trade"):
        e = e.when(~data["price"].between(0, U32_MAX), F.lit("schema: bad field price"))
    if kind == "delta":
        e = e.when(~data["side"].isin(*SIDES), F.lit("schema: bad field side"))
    if kind == "trade":
        e = e.when(~data["taker_side"].isin(*SIDES), F.lit("schema: bad field taker_side")).when(~F.coalesce(data["taker_book_side"], F.lit("bid")).isin(*BOOK_SIDES), F.lit("schema: bad field taker_book_side"))
        e = e.when(~_whole(data["count"], I64_MAX), F.lit("schema: bad field count"))
    if kind == "gap":
        for k in ("last_seq", "observed_seq"):
            e = e.when(_unusable(keys, text, k, _u64(data[k])), F.lit(f"schema: bad field {k}"))
        e = e.when(~data["reason"].isin(*GAP_REASONS), F.lit("schema: bad field reason")).when(~data["channel"].isin(*CHANNELS), F.lit("schema: bad field channel"))
    return e


def decode(lines: DataFrame) -> DataFrame:
    """Lines with ``error`` (null: fine), the envelope's fields, and one struct per kind.

    Times are RFC 3339 with a zone; seq is unsigned, and kept as the signed number of the same bits.
    """
    top = F.from_json("text", "v BIGINT, recv_ts STRING, seq DECIMAL(38,9), sid BIGINT, kind STRING, data STRING")
    d = lines.withColumn("_keys", F.json_object_keys(F.col("text"))).withColumn("_e", top)
    # from_json gives strings for objects, re-rendered; the payload of raw data stays JSON text.
    d = d.withColumns({k: F.when(F.col("_e.kind") == k, F.from_json(F.col("_e.data"), s)) for k, (s, _, _) in KINDS.items()})
    recv, seq = rfc3339_us(F.col("_e.recv_ts")), _u64(F.col("_e.seq"))
    error = (
        F.when(F.col("_keys").isNull(), F.lit("json parse: not a JSON object"))
        .when(F.col("_e.v").isNull() | ~F.col("_e.v").between(0, U16_MAX), F.lit("json parse: missing or bad field v"))
        .when(F.col("_e.v") > ENVELOPE_VERSION, F.concat(F.lit("schema: envelope version "), F.col("_e.v")))
        .when(recv.isNull(), F.lit("json parse: missing or bad field recv_ts"))
        .when(~F.coalesce(F.col("_e.kind").isin(*KINDS), F.lit(False)), F.lit("json parse: unknown kind"))
        .when(_unusable(F.col("_keys"), F.col("text"), "seq", seq), F.lit("json parse: bad field seq"))
        .when(_unusable(F.col("_keys"), F.col("text"), "sid", F.col("_e.sid")), F.lit("json parse: bad field sid"))
    )
    for k in KINDS:
        error = error.when(F.col("_e.kind") == k, F.regexp_replace(_data_error(k, F.col(k), F.col("_e.data")), "^schema", "json parse"))
    return d.select(
        *lines.columns, error.alias("error"), F.col("_e.v").alias("v"), recv.alias("recv_ts_us"), seq.alias("seq"),
        F.col("_e.sid").alias("sid"), F.col("_e.kind").alias("kind"), *KINDS,
    )


def _in_order(rows: DataFrame) -> DataFrame:
    """pos: place of a record in the ticker's capture (order book files, then trade files, by day).

    A million lines of a file are a segment, so a ticker's capture is many tasks.
    """
    segment = F.struct(F.when(F.col("channel") == "orderbook", 0).otherwise(1).alias("lane"), "channel", "file", scan.by_position("line_no").alias("part"))
    return scan.numbered(rows, "ticker", [F.col("line_no")], segment, "pos")


def _us(c: str) -> Column:
    return rfc3339_us(F.col(c))


def tables(decoded: DataFrame) -> dict[str, DataFrame]:
    """messages (book), trades, gaps, raw, verify and read_errors of decoded lines.

    ``messages`` is what ``operators.book.number_events`` takes, ordered by ``line_no`` (the
    place in the capture, across days and files).
    """
    errors = decoded.where("error IS NOT NULL").select("ticker", "channel", "file", "line_no", "error", F.col("text").alias("raw"))
    ok = _in_order(decoded.where("error IS NULL"))
    base = ["ticker", F.col("pos").alias("line_no"), "recv_ts_us"]
    lv = lambda c: F.transform(F.col(c), lambda l: F.struct(l["price"].alias("price"), l["quantity"].try_cast("bigint").alias("quantity")))
    messages = ok.where("kind IN ('snapshot', 'delta')").select(
        *base, F.coalesce(_us("snapshot.ts"), _us("delta.ts"), F.col("recv_ts_us")).alias("event_ts_us"), "seq", "sid", "kind",
        lv("snapshot.yes").alias("yes"), lv("snapshot.no").alias("no"), "delta.side", F.col("delta.price").alias("price_micro"), F.col("delta.delta").alias("delta_centi"),
    )
    trades = ok.where("kind = 'trade'").select(
        "ticker", "recv_ts_us", F.coalesce(_us("trade.ts"), F.col("recv_ts_us")).alias("event_ts_us"), "seq", F.col("trade.price").alias("price_micro"),
        F.col("trade.count").try_cast("bigint").alias("count_centi"), "trade.taker_side", "trade.taker_book_side", "trade.trade_id", F.col("pos").alias("file_row"),
    )
    gaps = ok.where("kind = 'gap'").select("ticker", "recv_ts_us", "seq", "gap.reason", "gap.channel", _u64(F.col("gap.last_seq")).alias("last_seq"), _u64(F.col("gap.observed_seq")).alias("observed_seq"), "gap.detail", F.col("pos").alias("file_row"))
    raw = ok.where("kind = 'raw'").select("ticker", "recv_ts_us", "seq", "channel", "raw.raw_type", F.col("raw.ticker").alias("raw_ticker"), "raw.error", F.col("raw.payload").alias("payload_json"))
    obs = ok.where("kind = 'verify'").select(*base, lv("verify.yes").alias("yes"), lv("verify.no").alias("no"))
    return {"messages": messages, "trades": trades, "gaps": gaps, "raw": raw, "verify": obs, "read_errors": errors, "records": ok.select("ticker", "channel", "file", "kind", "recv_ts_us")}
