"""Processed datasets: index, gates, loaders and replay."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import ticker_date
from ..operators import book, coverage, merge, validate
from .arrow_files import read_arrow
from .process import SCHEMA_VERSION


#: Columns that readers need, by table; others that a table has are not read.
TABLES = {
    "book_events": "ticker string, event_idx bigint, recv_ts_us bigint, event_ts_us bigint, seq bigint, sid bigint, is_snapshot boolean, side string, price_micro bigint, qty_centi bigint, file_row bigint",
    "book_top": "ticker string, event_idx bigint, recv_ts_us bigint, event_ts_us bigint, seq bigint, event string, yes_bid_micro bigint, yes_bid_sz_centi bigint, yes_ask_micro bigint, yes_ask_sz_centi bigint, mid_micro bigint, spread_micro bigint, yes_total_centi bigint, no_total_centi bigint, yes_levels bigint, no_levels bigint, imbalance double, yes_bid double, yes_ask double, mid double",
    "keyframes": "ticker string, event_idx bigint, recv_ts_us bigint",
    "trades": "ticker string, file_row bigint, recv_ts_us bigint, event_ts_us bigint, seq bigint, price_micro bigint, count_centi bigint, taker_side string, taker_book_side string, trade_id string",
    "gaps": "ticker string, recv_ts_us bigint, seq bigint, last_seq bigint, observed_seq bigint, reason string, channel string, detail string, gap_no bigint",
}


class DatasetError(Exception):
    """Anything wrong with a dataset."""


class UnsupportedSchema(DatasetError):
    """The dataset is newer than this reader."""


class IncompleteData(DatasetError):
    """A session lost data and the caller has not accepted that."""


class MissingTable(DatasetError):
    """A table that the call needs is not there."""


class InvalidRange(DatasetError, ValueError):
    """A time range is empty or reversed."""


class OrderViolation(DatasetError):
    """Rows of a table step back in the order they were written."""


class MalformedRow(DatasetError):
    """A row can't be what its table says."""


class UnknownTicker(DatasetError, ValueError):
    """A ticker that was asked for is not in the dataset."""


@contextmanager
def typed() -> Iterator[None]:
    """Errors that rows of a dataset raise where they are read, as ``MalformedRow`` or ``OrderViolation``.

    Frames are lazy: what ``events``, ``between`` and ``book_at`` return is checked by the query
    that reads it, in the same pass. Put that query below ``with typed():``.
    """
    try:
        yield
    except Exception as e:
        if found := re.search(r"(MalformedRow|OrderViolation): ([^\n]*)", str(e)):
            raise {"MalformedRow": MalformedRow, "OrderViolation": OrderViolation}[found[1]](found[2].split(" SQLSTATE")[0]) from e
        raise


class MarketDataset:
    """A folder written by ``process_capture``, or some of its ``tickers``.

    ``allow_incomplete`` accepts sessions with unreadable or undecoded records; otherwise
    loading them raises. The gate runs when data are asked for, not when the dataset is opened,
    and looks at the chosen tickers alone.
    """

    def __init__(self, spark: SparkSession, root: str, allow_incomplete: bool = False, tickers: list[str] | None = None):
        self.spark, self.root, self.allow_incomplete, self.tickers = spark, root.rstrip("/"), allow_incomplete, tickers
        manifest = self._read("manifest", "json")
        newest = manifest.agg(F.max("schema_version")).first()[0]
        if newest is not None and newest > SCHEMA_VERSION:
            raise UnsupportedSchema(f"schema version {newest} is newer than {SCHEMA_VERSION}")
        self._manifest = manifest
        if tickers is not None and (lost := sorted(set(tickers) - {r[0] for r in manifest.select("ticker").collect()})):
            raise UnknownTicker(f"no such ticker: {', '.join(lost)}")

    def _has(self, table: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def _read(self, table: str, kind: str = "parquet", optional: bool = False) -> DataFrame:
        path = f"{self.root}/{table}"
        if not self._has(table):
            if optional:
                return self.spark.createDataFrame([], TABLES[table])
            raise MissingTable(path)
        reader = self.spark.read.format(kind)
        df = (reader.schema(TABLES[table]) if table in TABLES else reader).load(path)
        # Tables lie in a folder a ticker: others aren't listed.
        return df if self.tickers is None else df.where(F.col("ticker").isin(*self.tickers))

    def catalog(self, tickers: list[str] | None = None, complete: bool | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
        """Manifest rows with the ticker's date and the reasons why a session is incomplete.

        Dates are inclusive; a ticker without date is left out as soon as a bound is given.
        """
        c = self._manifest.withColumn("date", ticker_date(F.col("ticker"))).withColumn("reasons", coverage.reasons())
        if tickers is not None:
            c = c.where(F.col("ticker").isin(*tickers))
        if complete is not None:
            c = c.where(F.col("complete") == complete)
        return _dated(c, since, until)

    def _gate(self) -> None:
        if not self.allow_incomplete and (bad := [r[0] for r in self._manifest.where("NOT complete").select("ticker").limit(5).collect()]):
            raise IncompleteData(f"incomplete: {', '.join(bad)}; pass allow_incomplete=True to load anyway")

    def table(self, name: str) -> DataFrame:
        """A table as written, after the gate."""
        self._gate()
        return self._read(name)

    def events(self, strict: bool = True) -> DataFrame:
        """The merged stream; with ``strict`` a malformed row or an order violation ends the query
        that reads it (``typed`` gives it its type)."""
        self._gate()
        b, t, g = self._tables(strict)
        return self._in_order(merge.merged(b, t, g), b, g, strict)

    def _tables(self, strict: bool, since_us: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """book_events (from an instant on), trades and gaps; with ``strict`` each row is checked as it is read."""
        b, t, g = self._read("book_events"), self._trades(), self._gaps()
        if since_us is not None:
            b = b.where(F.col("recv_ts_us") >= since_us)
        if strict:
            b, t, g = validate.checked(b, "book_events", validate.book_fault()), validate.checked(t, "trades", validate.trade_fault()), validate.checked(g, "gaps", validate.gap_fault())
        return b, t, g

    def _in_order(self, stream: DataFrame, b: DataFrame, g: DataFrame, strict: bool) -> DataFrame:
        """The stream and, as rows of it, what steps back in file order: the first one is an error."""
        if not strict:
            return stream
        said = F.concat(F.lit("OrderViolation: "), F.col("ticker"), F.lit(": row "), F.col("file_row").cast("string"), F.lit(" steps back"))
        # A filter, which is evaluated whatever columns a query takes.
        bad = merge.order_violations(b, g).where(F.raise_error(said).cast("string").isNotNull()).select("ticker")
        return stream.unionByName(bad, allowMissingColumns=True)

    def _trades(self) -> DataFrame:
        return self._read("trades")

    def _gaps(self) -> DataFrame:
        return self._read("gaps").withColumnRenamed("gap_no", "file_row")

    def _opens_us(self, t_us: int) -> int | None:
        """The receive time from which rows can matter to the books at t: that of the earliest last
        snapshot before it. None, for all of history, if some ticker has rows but no snapshot yet.

        Read from the keyframes, a row a snapshot; files of book_events are in the order of time, so
        the bound keeps what lies before from being read.
        """
        if not self._has("keyframes"):
            return None
        k = self._read("keyframes").where(F.col("recv_ts_us") < t_us)
        last = k.groupBy("ticker").agg(F.max("recv_ts_us").alias("t"), F.max_by("event_idx", "recv_ts_us").alias("idx"))
        least, n = last.agg(F.min(F.when(F.col("idx").isNotNull(), F.col("t"))), F.count_if(F.col("idx").isNull())).first()
        return None if n else least

    def between(self, t0_us: int, t1_us: int, strict: bool = True) -> DataFrame:
        """Replay of [t0, t1), as ``merge.between`` gives it; checked like ``events``, also what lies
        before t0 as far as it is needed for the opening book."""
        if t0_us >= t1_us:
            raise InvalidRange(f"[{t0_us}, {t1_us})")
        self._gate()
        b, t, g = self._tables(strict, self._opens_us(t0_us))
        soon = F.col("recv_ts_us") < t1_us
        return self._in_order(merge.between(b, t, g, t0_us, t1_us), b.where(soon), g.where(soon), strict)

    def book_at(self, t_us: int, strict: bool = True) -> DataFrame:
        """The ladder just before an instant; with ``strict`` the rows that make it are checked."""
        self._gate()
        return book.book_at(self._tables(strict, self._opens_us(t_us))[0], t_us)

    def coverage(self) -> DataFrame:
        """Works for incomplete sessions too: it is there to judge them. Without a gaps table nobody
        knows of holes: the figures that need it are null."""
        b, known = self._read("book_events", optional=True), self._has("gaps")
        cover = coverage.coverage(self._manifest.select("ticker"), b, self._trades(), self._read("gaps", optional=True).withColumnRenamed("gap_no", "file_row"))
        if not known:
            cover = cover.withColumns({c: F.lit(None).cast(cover.schema[c].dataType) for c in ("n_gaps", "n_unresolved", "hole_us", "uptime")})
        return coverage.accounting(cover, self._manifest, self.root)

    def holes(self) -> DataFrame:
        b = self._read("book_events", optional=True)
        span = coverage.spans(self._manifest.select("ticker"), b, self._trades())
        return coverage.holes(self._gaps(), b, span)


def load(datasets: list[MarketDataset], table: str) -> DataFrame:
    """Rows of one table of several datasets, columns matched by name, with ``source_path``."""
    if not datasets:
        raise ValueError("no datasets")
    out = None
    for d in datasets:
        df = d.table(table).withColumn("source_path", F.lit(d.root))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


#: Names of a day's archives. Fixed pattern of those that are handed around.
DAY_TAR = r"/(\d{4}-\d{2}-\d{2})(?:\.(?:archive|live))?\.tar\.gz$"


class DatasetIndex:
    """Every dataset and day archive below a folder, from listings and manifests alone.

    Archives are rows that nobody has opened: their path and date. An unreadable manifest is an
    error, as is one that is newer than this reader.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        reader = spark.read.option("recursiveFileLookup", True)
        path = F.regexp_extract("_metadata.file_path", r"^(.*)/manifest/[^/]*$", 1)
        lines = reader.option("pathGlobFilter", "*.json").text(root).withColumn("path", path).where("path <> ''")
        m = lines.select("path", F.from_json("value", _MANIFEST, {"mode": "FAILFAST"}).alias("m")).select("path", "m.*")
        newest = m.agg(F.max("schema_version")).first()[0]
        if newest is not None and newest > SCHEMA_VERSION:
            raise UnsupportedSchema(f"schema version {newest} is newer than {SCHEMA_VERSION}")
        self._entries = m.withColumn("date", ticker_date(F.col("ticker"))).withColumn("reasons", coverage.reasons())
        tars = reader.format("binaryFile").option("pathGlobFilter", "*.tar.gz").load(root).select("path")
        self._tars = tars.withColumn("date", F.regexp_extract("path", DAY_TAR, 1).try_cast("date")).where("date IS NOT NULL")

    def entries(self, ticker: str | None = None, complete: bool | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
        """One row per session, by ticker and path. Dates are inclusive; a session without date is
        left out as soon as a bound is given."""
        e = self._entries
        if ticker is not None:
            e = e.where(F.col("ticker") == ticker)
        if complete is not None:
            e = e.where(F.col("complete") == complete)
        return _dated(e, since, until).orderBy("ticker", "path")

    def tickers(self) -> DataFrame:
        return self._entries.select("ticker").distinct().orderBy("ticker")

    def tar_entries(self, since: str | None = None, until: str | None = None) -> DataFrame:
        return _dated(self._tars, since, until).orderBy("date", "path")


_MANIFEST = (
    "ticker string, schema_version int, complete boolean, records bigint, read_errors bigint, raw bigint, trades bigint, book_events bigint, book_top bigint, gaps bigint,"
    " verify_matched bigint, verify_mismatch bigint, verify_skipped bigint, underflows bigint, two_sided boolean"
)


def _dated(rows: DataFrame, since: str | None, until: str | None) -> DataFrame:
    if since is not None:
        rows = rows.where(F.col("date") >= F.lit(since).cast("date"))
    if until is not None:
        rows = rows.where(F.col("date") <= F.lit(until).cast("date"))
    return rows


def peek(spark: SparkSession, path: str, rows: int = 5) -> tuple[str, int, list[str]]:
    """Schema, row count and the first rows as JSON of a Parquet path, an Arrow file or a folder of those."""
    df = read_arrow(spark, path) if path.rstrip("/").endswith((".feather", ".arrow")) else spark.read.parquet(path)
    return df.schema.simpleString(), df.count(), [r["j"] for r in df.limit(rows).select(F.to_json(F.struct("*")).alias("j")).collect()]
