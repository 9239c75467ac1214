"""An order-book session derived from the `events` table, for queries over the driver's data.

Every event is one capture message: a snapshot, delta, trade or gap of one of eight tickers.
The tables have the columns of processed captures, plus ``ticker`` and ``file_row``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EPOCH_US = 1704067200000000
REST_RECV_US = 1800000000000000

#: Microseconds of a zone-less timestamp, whatever the session's zone.
_US = (
    "unix_date(CAST(ts AS DATE)) * 86400000000 + (hour(ts) * 3600 + minute(ts) * 60) * 1000000L"
    " + CAST(extract(SECOND FROM ts) * 1000000 AS BIGINT)"
)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ticker, line_no, recv_ts_us, kind, side, price_micro, qty_centi and the event's id and user."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    e = e.withColumn("us", F.expr(_US))
    order = Window.partitionBy("ticker").orderBy("us", "event_id")
    return (
        e.selectExpr(
            "event_id", "user_id", "us",
            "concat('KXSIM-24JAN', lpad(CAST(user_id % 8 + 1 AS STRING), 2, '0'), '12-T', user_id % 8) AS ticker",
            f"{EPOCH_US} + (us - {EPOCH_US}) div 1000 AS recv_ts_us",
            """CASE WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 'snapshot'
                    WHEN event_type = 'purchase' THEN 'trade'
                    WHEN event_type = 'error' AND event_id % 7 = 0 THEN 'gap' ELSE 'delta' END AS kind""",
            "CASE WHEN event_id % 2 = 0 THEN 'yes' ELSE 'no' END AS side",
            "(1 + (event_id * 7 + user_id) % 9) * 50000 AS price_micro",
            "CAST(round(value * 100) AS BIGINT) * CASE WHEN event_type IN ('click', 'error') THEN -1 ELSE 1 END AS qty_centi",
        )
        .withColumn("line_no", (F.row_number().over(order) - 1).cast("bigint"))
        .drop("us")
    )


def book_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot and delta messages as decoded captures hold them: levels in arrays."""
    level = "named_struct('price', (1 + (event_id * 7 + k * 2) % 9) * 50000, 'quantity', 1000 + (event_id % 50) * 100 + k * 10L)"
    levels = f"CASE WHEN kind = 'snapshot' THEN transform(array(0, 1, 2), k -> {level}) END"
    m = messages(spark, sf_dir).where("kind IN ('snapshot', 'delta')")
    return m.selectExpr(
        "ticker", "line_no", "recv_ts_us", "recv_ts_us AS event_ts_us", "line_no AS seq", "CAST(NULL AS BIGINT) AS sid", "kind",
        f"{levels} AS yes", f"{levels} AS no", "side", "price_micro", "qty_centi AS delta_centi",
    )


def trade_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as captured (stream copies) and as fetched later (copies without seq)."""
    m = messages(spark, sf_dir).where("kind = 'trade'")
    common = ["ticker", "event_id", "recv_ts_us + 1200000 AS event_ts_us", "price_micro", "qty_centi AS count_centi", "side AS taker_side"]
    ws = m.where("event_id % 11 <> 0").selectExpr(
        *common, "recv_ts_us", "line_no AS seq", "CASE WHEN event_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS taker_book_side",
        "CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat('t', event_id) END AS trade_id",
    )
    rest = m.where("event_id % 3 = 0 OR event_id % 11 = 0").selectExpr(
        *common, f"{REST_RECV_US} AS recv_ts_us", "CAST(NULL AS BIGINT) AS seq", "CAST(NULL AS STRING) AS taker_book_side", "concat('t', event_id) AS trade_id"
    )
    file = Window.partitionBy("ticker").orderBy(F.col("seq").isNull(), "event_id")
    return ws.unionByName(rest).withColumn("file_row", (F.row_number().over(file) - 1).cast("bigint")).drop("event_id")


def gap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir).where("kind = 'gap'")
    file = Window.partitionBy("ticker").orderBy("line_no")
    return m.selectExpr(
        "ticker", "line_no", "recv_ts_us", "line_no AS seq", "'seq_jump' AS reason", "'orderbook' AS channel",
        "line_no - 1 AS last_seq", "line_no + 1 AS observed_seq", "concat('seq jumped ', line_no - 1, ' -> ', line_no + 1) AS detail",
    ).withColumn("file_row", (F.row_number().over(file) - 1).cast("bigint")).drop("line_no")


def verify_rows(spark: SparkSession, sf_dir: str, levels: DataFrame) -> DataFrame:
    """Independent observations of the book: every 50th book event, one microsecond after it.

    The state is that of 0 to 3 book events earlier; every fifth has an extra level.
    ``levels`` is (ticker, event_idx, recv_ts_us, yes, no) with arrays of (price, quantity).
    """
    pick = levels.where("event_idx % 50 = 0 AND event_idx > 0").selectExpr("ticker", "event_idx", "recv_ts_us + 1 AS recv_ts_us", "event_idx - (event_idx div 50) % 4 AS src")
    src = levels.selectExpr("ticker", "event_idx AS src", "yes", "no")
    odd = "(event_idx div 50) % 5 = 4"
    return pick.join(src, ["ticker", "src"]).selectExpr(
        "ticker", "event_idx", "recv_ts_us",
        f"CASE WHEN {odd} THEN array_sort(concat(yes, array(named_struct('price', 990000L, 'quantity', 7L)))) ELSE yes END AS yes", "no",
    )


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market metadata out of `orders`: names with date and hour, cadences, statuses."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    stamp = "concat('KXO', o_custkey % 20, '-', upper(date_format(o_orderdate, 'yyMMMdd')), lpad(CAST(o_orderkey % 24 AS STRING), 2, '0'))"
    o = o.selectExpr(
        "o_orderkey AS pos", "concat('KXO', o_custkey % 20) AS series", f"concat({stamp}, '-T', o_orderkey % 7) AS ticker",
        f"CASE WHEN o_orderkey % 11 <> 0 THEN {stamp} END AS event",
        "CASE o_orderstatus WHEN 'F' THEN 'finalized' WHEN 'O' THEN 'active' ELSE IF(o_orderkey % 3 = 0, 'closed', 'open') END AS status",
        "unix_date(CAST(o_orderdate AS DATE)) * 86400000000 + (o_orderkey % 24) * 3600000000 AS open_us",
        "element_at(array(60L, 1440L, 10000L, 20000L, 200L + o_custkey % 7), CAST(o_orderkey % 5 + 1 AS INT)) AS minutes",
        "o_totalprice AS volume",
    )
    return o.withColumn("close_us", F.expr("open_us + minutes * 60000000"))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series (brands) with category (type) and traded volume."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_brand", "p_type")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_partkey", "l_quantity")
    vol = li.groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("v"))
    return p.join(vol, p.p_partkey == vol.l_partkey).groupBy(F.col("p_type").alias("category"), F.concat_ws("-", "p_brand", "p_type").alias("ticker")).agg(F.sum("v").alias("volume"))
