"""Structured Streaming forms: capture source, book replay, checks, sequence gaps, landing sink.

The batch operators are the reference for these; what only the end of input decides (a hole
that no snapshot closes, an observation without later state) is left to the batch form.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import book, sequence, trades
from ..operators.verify import WINDOW_US
from ..sources import capture
from .state import AsOf, BookTop, Checks, use_rocksdb


def capture_stream(spark: SparkSession, base: str, files_per_trigger: int = 100) -> DataFrame:
    """Decoded envelopes of JSONL files as they land; the file bound is the back-pressure."""
    lines = (
        spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").option("maxFilesPerTrigger", files_per_trigger)
        .load(base)
        .select(
            F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/([^/]+)/([^/]+)\.jsonl$", 1).alias("ticker"),
            F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/([^/]+)\.jsonl$", 1).alias("channel"),
            F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+\.jsonl)$", 1).alias("file"),
            F.posexplode(F.split("value", "\n")).alias("p", "text"),
        )
        .select("ticker", "channel", "file", (F.col("p") + 1).cast("bigint").alias("line_no"), "text")
        .where(F.trim("text", F.lit(" \t\r")) != "")
    )
    return capture.decode(lines)


_TOP = "ticker string, event_idx bigint, line_no bigint, recv_ts_us bigint, event_ts_us bigint, seq bigint, event string, yb bigint, ybs bigint, nb bigint, nbs bigint, yt bigint, nt bigint, yl bigint, nl bigint, underflows bigint"


def book_top_stream(messages: DataFrame) -> DataFrame:
    """The rows of ``book_top``, with line_no and underflows so far, as messages arrive.

    Messages of a ticker are taken in line order inside a micro-batch; files must land in capture
    order. State per ticker: its ladder, one entry a level, of which a batch writes those that
    changed, and the number of messages and of underflows so far.
    """
    use_rocksdb(messages.sparkSession)
    got = messages.groupBy("ticker").transformWithState(BookTop(), _TOP, "Append", "None")
    return book.top_rows(got, "line_no", "underflows")


_VERDICT = "sid string, line_no bigint, kind string, channel string, recv_ts_us bigint, seq bigint, last_seq bigint, verdict string"


def seq_verdict_stream(frames: DataFrame) -> DataFrame:
    """Sequence verdicts of frames (sid, line_no, kind, seq, and where there are any channel and
    recv_ts_us, which are passed on); state is the last seq of a connection."""
    absent = {"channel": "string", "recv_ts_us": "bigint"}
    frames = frames.withColumns({c: F.lit(None).cast(t) for c, t in absent.items() if c not in frames.columns})
    names = [f.split()[0] for f in _VERDICT.split(", ")]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = []
        for r in pd.concat(list(batches)).sort_values("line_no").itertuples():
            seq = None if pd.isna(r.seq) else int(r.seq)
            one = (key[0], r.line_no, r.kind, r.channel, r.recv_ts_us, seq)
            if r.kind == "snapshot":
                # A snapshot sets the baseline, even to none.
                rows.append((*one, None, "accept"))
                last = seq
                continue
            verdict = "accept" if seq is None or last is None or seq == last + 1 else "duplicate" if seq == last else "gap"
            rows.append((*one, last, verdict))
            last = last if seq is None else seq
        state.update((last,))
        yield pd.DataFrame(rows, columns=names).astype({"recv_ts_us": "Int64", "seq": "Int64", "last_seq": "Int64"})

    return frames.groupBy("sid").applyInPandasWithState(step, _VERDICT, "last_seq bigint", "append", GroupStateTimeout.NoTimeout)


def gap_marker_stream(frames: DataFrame, reconnects: DataFrame, tickers: DataFrame) -> DataFrame:
    """Gap markers as they happen: seq jumps of a stream of frames and reconnects (sid, recv_ts_us) of
    another, fanned out to the tickers of the connection (a static table)."""
    jumps = seq_verdict_stream(frames).where("verdict = 'gap'").select("sid", F.lit("seq_jump").alias("kind"), "channel", "recv_ts_us", "last_seq", F.col("seq").alias("observed_seq"))
    none = F.lit(None).cast("bigint")
    again = reconnects.select("sid", F.lit("reconnect").alias("kind"), F.lit(None).cast("string").alias("channel"), "recv_ts_us", none.alias("last_seq"), none.alias("observed_seq"))
    return sequence.fan_out(jumps.unionByName(again), tickers)


_CHECK = "ticker string, event_idx bigint, recv_ts_us bigint, outcome string, match_lag_us bigint, settled_by string"


def verify_stream(records: DataFrame, window_us: int = WINDOW_US, delay: str = "1 minute", idle_us: int = 86_400_000_000) -> DataFrame:
    """Verdicts on observations as soon as they are certain: by a state up to a window before or after,
    by a gap, by the next observation, by the first book message beyond the window or, where a
    ticker falls silent, by a timer at the end of the window (``settled_by`` record or timer).

    records: the columns of ``book_top_stream``'s input, kinds verify (yes, no) and gap too. Time is
    receive time, and its watermark runs ``delay`` behind: records later than that are dropped by
    Spark, so it must exceed what tickers' files lag behind each other. State per ticker is its
    ladder, a log of the changes of one window, and one observation; it goes when the ticker has
    been silent for ``idle_us``, and one that speaks again begins anew. An observation without any
    book message before it gives no row. What the batch form calls truncated is settled here as
    soon as other tickers' records have moved time beyond the window, and waits until then.
    """
    use_rocksdb(records.sparkSession)
    timed = records.withColumn("_at", F.timestamp_micros("recv_ts_us")).withWatermark("_at", delay)
    return timed.groupBy("ticker").transformWithState(Checks(window_us, idle_us), _CHECK, "Append", "EventTime")


def trade_book_stream(trades_: DataFrame, tops: DataFrame, take: tuple[str, ...] = ("event_idx", "yes_bid_micro", "yes_ask_micro"), delay: str = "1 minute") -> DataFrame:
    """Trades (ticker, eff_ts_us and more) with ``take`` (whole numbers) of the last row of ``tops``
    (ticker, recv_ts_us, event_idx, ...) at or before them: the batch form is ``asof_backward``.

    Both are streams, of any order up to ``delay``: a trade waits until the watermark has passed its
    time, by when all books it could need have come. Its columns are in ``row``, as JSON. State per
    ticker: trades that wait, books since the watermark, and the one before it.
    """
    use_rocksdb(trades_.sparkSession)
    none = F.lit(None).cast("bigint")
    left = trades_.select("ticker", F.col("eff_ts_us").alias("ts"), none.alias("o"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"), *[none.alias(c) for c in take])
    right = tops.select("ticker", F.col("recv_ts_us").alias("ts"), F.col("event_idx").alias("o"), F.lit(None).cast("string").alias("row"), *[F.col(c).cast("bigint").alias(c) for c in take])
    both = left.unionByName(right).withColumn("_at", F.timestamp_micros("ts")).withWatermark("_at", delay)
    schema = "ticker string, ts bigint, row string, " + ", ".join(f"{c} bigint" for c in take)
    return both.groupBy("ticker").transformWithState(AsOf(take), schema, "Append", "EventTime")


def merged_trades_stream(trades_: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    """Merge stream and fetched copies as they come, hours apart or in any order.

    The merge is ``trades.dedup`` itself: an aggregation whose state is a row a trade, in update
    mode. Each batch appends the trades that it changed, under its number, so a batch that runs
    again replaces its own rows; ``compacted_trades`` reads the newest of each.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    merged = trades.dedup(trades_)
    return merged.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def compacted_trades(spark: SparkSession, out: str) -> DataFrame:
    """The merged trades: of a trade_id the version with most copies, of rows without one all."""
    rows = spark.read.parquet(out).drop("batch")
    cols = [c for c in rows.columns if c not in ("ticker", "trade_id")]
    newest = rows.where("trade_id IS NOT NULL").groupBy("ticker", "trade_id").agg(F.max_by(F.struct(*cols), "copies").alias("r"))
    return newest.select("ticker", "trade_id", "r.*").select(rows.columns).unionByName(rows.where("trade_id IS NULL"))


def landing_sink(decoded: DataFrame, out: str, checkpoint: str):
    """Append decoded records as JSON lines by ticker, channel and receive day; names that can't be
    path segments go to ``_unsafe``. Exactly once through the sink's own log."""
    from ..functions.naming import is_safe_segment

    rows = decoded.withColumns({
        "ticker": F.when(is_safe_segment(F.col("ticker")), F.col("ticker")).otherwise("_unsafe"),
        "day": F.date_format(F.timestamp_micros("recv_ts_us"), "yyyy-MM-dd"),
    })
    return rows.writeStream.format("json").partitionBy("ticker", "channel", "day").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True)
