"""From a capture folder to processed tables with a manifest."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..operators import book, coverage, scan, verify
from ..operators.asof import asof_backward
from ..operators.trades import tape
from . import capture
from .arrow_files import write_arrow
from .scratch import saved

#: Fixed value: version of the processed tables, which readers compare.
SCHEMA_VERSION = 1


def write_table(df: DataFrame, path: str, order: str, level: int = 3, replace: bool = True) -> None:
    """Parquet, ZSTD, in a folder a ticker, in the order of that column inside it: over files, whose
    names go by it, and in each file. So row groups are intervals, and ranges of time skip most.

    replace: whether the table becomes these rows; else only the tickers that have some are replaced.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = df.repartitionByRange(n, "ticker", order).sortWithinPartitions("ticker", order)
    _over(sorted_, replace).option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)


def _over(df: DataFrame, replace: bool) -> DataFrameWriter:
    return df.write.mode("overwrite").option("partitionOverwriteMode", "static" if replace else "dynamic").partitionBy("ticker")


def keyframes(book_events: DataFrame) -> DataFrame:
    """(ticker, event_idx, recv_ts_us) of every snapshot, and of each ticker that begins with a change
    its first row, without event_idx: up to the first snapshot all of its history counts."""
    snap = book_events.where("is_snapshot").select("ticker", "event_idx", "recv_ts_us").distinct()
    first = book_events.groupBy("ticker").agg(F.min_by(F.struct("is_snapshot", "recv_ts_us"), "file_row").alias("f")).where("NOT f.is_snapshot")
    return snap.unionByName(first.select("ticker", F.lit(None).cast("bigint").alias("event_idx"), "f.recv_ts_us"))


def _notes() -> Column:
    """What to know about a session's tables, as sentences."""
    n = lambda c, text: F.when(F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(f" {text}")))
    whole = F.when(F.col("complete"), F.lit("every record is in the tables: the capture can go once they are verified")).otherwise(
        F.lit("the tables are INCOMPLETE: keep the capture until the above is settled")
    )
    return F.array_compact(F.array(
        n("gaps", "gaps are recorded: holes are expected there"), n("raw", "undecoded messages are kept in raw"), n("read_errors", "unreadable lines are kept in read_errors"),
        n("verify_mismatch", "observations differ from the replayed book: see verify, and the verify_mismatch gaps"), n("underflows", "changes took a level below zero in replay"), whole,
    ))


def manifest_rows(t: dict[str, DataFrame], events: DataFrame, top: DataFrame, outcomes: DataFrame, cover: DataFrame) -> DataFrame:
    """One row per ticker: counts, extent, completeness, trust figures.

    complete means: no unreadable line and no undecoded message, and nothing else. files has
    the lines of each file, unreadable ones too; notes what a reader should know.
    """
    count = lambda df, name: df.groupBy("ticker").agg(F.count(F.lit(1)).alias(name))
    m = t["records"].groupBy("ticker").agg(F.count(F.lit(1)).alias("records"), F.min("recv_ts_us").alias("first_recv_ts_us"), F.max("recv_ts_us").alias("last_recv_ts_us"))
    m = m.join(count(t["read_errors"], "read_errors"), "ticker", "full")
    for name in ("trades", "gaps", "raw"):
        m = m.join(count(t[name], name), "ticker", "left")
    m = m.join(book.two_sided(top).select("ticker", F.col("n_events").alias("book_top"), "two_sided"), "ticker", "left")
    v = outcomes.groupBy("ticker").agg(*[F.count_if(F.col("outcome") == o).alias(f"verify_{o}") for o in ("matched", "mismatch")], F.count_if(F.col("outcome").isin("skipped_gap", "truncated")).alias("verify_skipped"))
    under = book.underflows(book.replay_levels(events)).groupBy("ticker").agg(F.count(F.lit(1)).alias("underflows"))
    m = m.join(count(events, "book_events"), "ticker", "left").join(under, "ticker", "left")
    m = m.join(v, "ticker", "left").join(cover.select("ticker", "span_us", "hole_us", "uptime"), "ticker", "left")
    m = m.fillna(0, ["records", "read_errors", "trades", "gaps", "raw", "book_top", "book_events", "underflows", "verify_matched", "verify_mismatch", "verify_skipped"])
    lines = t["records"].select("ticker", "channel", "file").unionByName(t["read_errors"].select("ticker", "channel", "file"))
    per_file = lines.groupBy("ticker", "channel", "file").agg(F.count(F.lit(1)).alias("records"))
    files = per_file.groupBy("ticker").agg(F.array_sort(F.collect_list(F.struct("channel", "file", "records"))).alias("files"))
    m = m.withColumn("complete", (F.col("read_errors") == 0) & (F.col("raw") == 0)).withColumn("schema_version", F.lit(SCHEMA_VERSION))
    return m.withColumn("notes", _notes()).join(files, "ticker", "left")


#: Columns of the manifest.
MANIFEST = (
    "ticker string, records bigint, first_recv_ts_us bigint, last_recv_ts_us bigint, read_errors bigint, trades bigint, gaps bigint, raw bigint, book_top bigint, two_sided boolean,"
    " book_events bigint, underflows bigint, verify_matched bigint, verify_mismatch bigint, verify_skipped bigint, span_us bigint, hole_us bigint, uptime double, complete boolean,"
    " schema_version int, notes array<string>, files array<struct<channel:string,file:string,records:bigint>>"
)
#: Folders of a dataset that hold a folder a ticker, and the column that orders each.
ORDER = {
    "book_events": "file_row", "keyframes": "recv_ts_us", "book_top": "event_idx", "trades": "file_row", "gaps": "gap_no",
    "raw": "recv_ts_us", "verify": "recv_ts_us",
}
_MAY_LACK = ("raw", "verify")


def process_capture(spark: SparkSession, in_dir: str, out_dir: str, tickers: list[str] | None = None) -> DataFrame:
    """Write book_events, book_top, trades, gaps (and raw, verify, read_errors where there are
    any) and the manifest below ``out_dir``; return the manifest. What was there goes."""
    files = saved(capture.capture_files(spark, in_dir), "files")
    if tickers:
        files = files.where(F.col("ticker").isin(*tickers))
    _forget(spark, out_dir)
    rows = _process(capture.capture_lines(spark, in_dir, tickers), out_dir, True)
    return _conclude(out_dir, rows, files)


def process_new(spark: SparkSession, in_dir: str, out_dir: str) -> DataFrame:
    """Bring the tables below ``out_dir`` up to a capture that has grown; return the whole manifest.

    The result is that of ``process_capture``. Only tickers with a file that is new, or of another
    size or time than at the last run, are read, and only their folders written, wholly: records of
    a later day change numbers and verdicts of earlier ones, in that ticker and in no other. Files
    are listed before they are read, and their sizes noted after everything else is written; so
    what grows meanwhile, or a run that is killed, makes the next run do those tickers again. A
    rerun over the same files writes nothing.

    A ticker of which no file changed keeps its tables, also when files of it are gone (they may be
    in an archive). With changed files beside ones that are gone or shorter than before its tables
    can't be made again: that is an error, and nothing is written.
    """
    files = saved(capture.capture_files(spark, in_dir), "files")
    if not (_exists(spark, f"{out_dir}/sources") and _exists(spark, f"{out_dir}/manifest")):
        _forget(spark, out_dir)
        return _conclude(out_dir, _process(capture.capture_lines(spark, in_dir), out_dir, True), files)
    known, before = spark.read.schema(files.schema).parquet(f"{out_dir}/sources"), spark.read.schema(MANIFEST).json(f"{out_dir}/manifest")
    at = ["ticker", "channel", "file"]
    redone = saved(files.join(known, [*at, "bytes", "modified"], "left_anti").select("ticker").distinct(), "redone")
    if redone.isEmpty():
        return before
    lost = known.join(files.select(*at, F.col("bytes").alias("_now")), at, "left").where("_now IS NULL OR _now < bytes").join(redone, "ticker", "left_semi")
    if bad := [r[0] for r in lost.select("ticker").distinct().limit(5).collect()]:
        raise ValueError(f"files are gone or shorter than before: {', '.join(bad)}; process_capture makes tables of what is left")
    # Folders of tickers: fewer than the files that the driver lists to plan a scan.
    folders = [r[0] for r in files.join(redone, "ticker", "left_semi").select("folder").distinct().collect()]
    rows = _process(capture.capture_lines(spark, folders), out_dir, False)
    _drop_emptied(out_dir, before, rows)
    rows = saved(before.join(redone, "ticker", "left_anti").unionByName(rows), "manifest")
    gone = known.join(files.select(*at), at, "left_anti")
    return _conclude(out_dir, rows, files.unionByName(gone))


def _drop_emptied(out_dir: str, before: DataFrame, rows: DataFrame) -> None:
    """Delete folders of tickers that had rows of a table and have none now, which no write replaces.

    Captures are appended to, so there are some only where a file was exchanged for another.
    """
    n = {"keyframes": "book_events", "verify": "verify_matched + verify_mismatch + verify_skipped"}
    held = lambda m: m.select("ticker", F.array_compact(F.array(*[F.expr(f"CASE WHEN {n.get(x, x)} > 0 THEN '{x}' END") for x in (*ORDER, "read_errors")])).alias("t"))
    both = held(before).join(held(rows).withColumnRenamed("t", "now"), "ticker")
    for ticker, table in both.select("ticker", F.explode(F.array_except("t", "now"))).collect():
        _delete(rows.sparkSession, f"{out_dir}/{table}/ticker={_folder_name(rows.sparkSession, ticker)}")


def _process(lines: DataFrame, out_dir: str, replace: bool) -> DataFrame:
    """Write the tables of those lines; return their manifest rows."""
    decoded = saved(capture.decode(lines), "decoded")
    t = capture.tables(decoded)
    numbered = saved(book.number_events(t["messages"]), "numbered")
    events = saved(book.flatten(numbered), "book_events")
    top = saved(book.book_top(events), "book_top")
    # The last book message before an observation is the state it is compared with.
    observed = saved(asof_backward(t["verify"], numbered.select("ticker", "line_no", "event_idx"), "ticker", "line_no", "line_no", "event_idx", ["event_idx"], scan.by_position("_ts")), "observed")
    states = saved(book.book_states(events, verify.near(events, observed)), "states")
    outcomes = saved(verify.verify_outcomes(states, observed, t["gaps"].where("channel = 'orderbook'")), "outcomes")
    outcomes = saved(verify.with_detail(outcomes), "details")
    gaps = saved(coverage.with_mismatch_gaps(t["gaps"], outcomes), "gaps")
    cover = coverage.coverage(t["records"].select("ticker").distinct(), events, t["trades"], gaps)
    out = {"book_events": events, "keyframes": keyframes(events), "book_top": book.with_dollars(top), "trades": tape(t["trades"]), "gaps": gaps, "raw": t["raw"], "verify": outcomes}
    for name, df in out.items():
        if name not in _MAY_LACK or not df.isEmpty():
            write_table(df, f"{out_dir}/{name}", ORDER[name], replace=replace)
    if not t["read_errors"].isEmpty():
        _over(t["read_errors"], replace).json(f"{out_dir}/read_errors")
    return saved(manifest_rows(t, events, top, outcomes, cover), "manifest")


def _conclude(out_dir: str, manifest: DataFrame, files: DataFrame) -> DataFrame:
    """The manifest, then the files it stands for: a run that ends before has done nothing that counts."""
    manifest.write.mode("overwrite").json(f"{out_dir}/manifest")
    saved(files, "sources").write.mode("overwrite").parquet(f"{out_dir}/sources")
    return manifest


def _forget(spark: SparkSession, out_dir: str) -> None:
    """Remove what says which files the tables stand for, and tables that a run may not write."""
    for name in ("sources", "read_errors", *_MAY_LACK):
        _delete(spark, f"{out_dir}/{name}")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _folder_name(spark: SparkSession, value: str) -> str:
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def pretty(manifest_row) -> str:
    """A manifest row as indented JSON."""
    return json.dumps(manifest_row.asDict(recursive=True), indent=2, default=str)


def curated(manifest: DataFrame) -> DataFrame:
    """Sessions worth archiving: all but those known to be one-sided; an unknown one is kept."""
    return manifest.where("two_sided IS DISTINCT FROM false")


def write_feather(df: DataFrame, path: str) -> None:
    """A folder of Arrow files, written by the tasks."""
    write_arrow(df, path)


def verify_records(books: DataFrame, recv_ts_us: int) -> DataFrame:
    """Observations out of REST books: decoded ones with levels, others as raw records."""
    kind = F.when(F.col("error").isNull(), "verify").otherwise("raw")
    return books.select("ticker", F.lit(recv_ts_us).cast("bigint").alias("recv_ts_us"), kind.alias("kind"), "yes", "no", "error", "payload_json")


def write_markets(markets: DataFrame, path: str) -> None:
    """Resolved markets as JSON lines, which ``lists`` reads back."""
    markets.write.mode("overwrite").json(path)
