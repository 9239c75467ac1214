"""Catalog queries: rollups, rankings, cohorts, admission, ladders, settlement, digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.naming import atm_distance, is_hourly, number_or_zero
from ..sources.scratch import saved


def category_rollup(series: DataFrame) -> DataFrame:
    """Series and volume of each category, largest volume first, then by name."""
    return series.groupBy("category").agg(F.count(F.lit(1)).alias("n_series"), F.sum("volume").alias("volume")).orderBy(F.desc("volume"), "category")


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``position`` (from 1) of every row in that order, which must not leave ties.

    Rows are dealt by ranges of the order and numbered inside a range; the numbers before each
    range come from a table with a row a range. So no task sorts the whole table.
    """
    dealt = saved(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranked")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.withColumn("_i", inside).join(F.broadcast(sizes), "_part").withColumn("position", F.col("_i") + F.col("_base")).drop("_part", "_i", "_base")


def rank_series(series: DataFrame) -> DataFrame:
    """Position by volume (largest first; NaN counts as the largest), then ticker."""
    return ranked(series, F.desc("volume"), F.col("ticker"))


def discover(markets: DataFrame) -> DataFrame:
    """Position of listed markets by volume (text; what is no number counts as 0), largest first;
    equal ones stay in the order of their ``page`` and of ``pos`` in it."""
    return ranked(markets.withColumn("_v", number_or_zero(F.col("volume"))), F.desc("_v"), F.col("page"), F.col("pos")).drop("_v")


def top_by(rows: DataFrame, volume: str, n: int, *ties: str) -> DataFrame:
    return rows.orderBy(F.desc(volume), *ties).limit(n)


def first_seen(rows: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """Of each key the row that came first."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def cohorts(markets: DataFrame) -> DataFrame:
    """Open markets by event: earliest open, latest close, tickers in input order.

    Of a ticker seen twice the first row counts; terminal markets are left out; a missing event
    is the ticker without its last part. ``markets``: pos, ticker, event, status, open_us, close_us.
    """
    from ..functions.naming import is_terminal

    m = first_seen(markets, "ticker", ("pos",)).where(~is_terminal(F.col("status")))
    stem = F.regexp_extract("ticker", r"^(.*)-[^-]*$", 1)
    m = m.withColumn("event", F.coalesce("event", F.when(stem != "", stem), "ticker"))
    return m.groupBy("event").agg(
        F.min("open_us").alias("open_us"), F.max("close_us").alias("close_us"), F.count(F.lit(1)).alias("n_markets"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "ticker"))), lambda x: x["ticker"]).alias("tickers"),
    )


def largest_ladder(markets: DataFrame, boundary_us: int) -> DataFrame:
    """The event with most markets opening at a boundary; of equals the greatest name."""
    per = markets.where(F.col("open_us") == boundary_us).groupBy("event").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.max(F.struct("n", "event")).alias("m")).where("m IS NOT NULL").select("m.event", "m.n")


#: Minutes before close after which a windowed market without known start is taken in.
CLASH_MINUTES = 70


def arm_plan(cohorts_: DataFrame, now_us: int, lead_us: int, max_units: int) -> DataFrame:
    """A decision for each cohort: excluded, deferred, skipped, arm or capped (with no_start noted).

    ``cohorts_``: event, cadence, windowed, clash_sub, start_us (inferred, may be null), open_us,
    close_us, in_flight, done. Candidates are admitted in order of event up to the free units.
    """
    start, open_, close = F.col("start_us"), F.col("open_us"), F.col("close_us")
    slow = F.col("cadence").isin("Daily", "Weekly")
    early = F.lit(now_us) < close - CLASH_MINUTES * 60_000_000
    decision = (
        F.when(F.col("in_flight") | F.col("done"), "excluded")
        .when(start.isNotNull() & (F.lit(now_us) < start - lead_us), "deferred")
        .when(start.isNull() & slow & ~F.col("clash_sub"), "skipped")
        .when(start.isNull() & slow & early, "deferred")
        .when(start.isNull() & (F.col("cadence") == "Long"), "skipped")
        .when(start.isNull() & F.col("cadence").isin("Hourly", "Other") & (F.lit(now_us) < open_ - lead_us), "deferred")
        .otherwise("candidate")
    )
    p = cohorts_.withColumn("decision", decision).withColumn("no_start", F.col("decision").isin("candidate") & start.isNull() & (F.col("cadence") == "Other") & F.col("windowed"))
    used = cohorts_.agg(F.count_if("in_flight").alias("_used"))  # one row
    w = Window.partitionBy("decision").orderBy("event")
    rank = F.when(F.col("decision") == "candidate", F.row_number().over(w))
    p = p.withColumn("_rank", rank).crossJoin(F.broadcast(used))
    return p.withColumn("decision", F.when(F.col("decision") != "candidate", F.col("decision")).when(F.col("_rank") <= F.lit(max_units) - F.col("_used"), "arm").otherwise("capped")).select("event", "decision", "no_start")


def ladder_band(strikes: DataFrame, band: int, by: str = "event") -> DataFrame:
    """Strikes within ``band`` places of the one nearest to an even price; 0 keeps all.

    ``strikes``: by, pos (input order), strike, price (null: unknown), anchor (null: unknown).
    The centre is the strike whose price is nearest to 0.5 (the first of equals in input
    order); without prices the strike nearest to the anchor (the lowest of equals); without
    anchor the upper median.
    """
    w = Window.partitionBy(by)
    s = strikes.withColumn("_i", F.row_number().over(w.orderBy("strike", "pos")) - 1).withColumn("_n", F.count(F.lit(1)).over(w))
    own = F.min_by("_i", F.when(F.col("price").isNotNull(), F.struct(F.abs(F.col("price") - 0.5), "pos"))).over(w)
    anchored = F.min_by("_i", F.when(F.col("anchor").isNotNull(), F.struct(F.abs(F.col("strike") - F.col("anchor")), "_i"))).over(w)
    s = s.withColumn("_c", F.coalesce(own, anchored, F.floor(F.col("_n") / 2).cast("int")))
    near = F.abs(F.col("_i") - F.col("_c")) <= band if band else F.lit(True)
    return s.where(near).select(by, "strike", (F.col("_i") - F.col("_c")).cast("bigint").alias("offset"))


def settled(targets: DataFrame, statuses: DataFrame) -> DataFrame:
    """Per unit: whether every target's latest status is terminal; an absent one is not."""
    from ..functions.naming import is_terminal

    last = statuses.groupBy("ticker").agg(F.max_by("status", "seen_us").alias("status"))
    return targets.join(last, "ticker", "left").groupBy("unit").agg(
        F.every(is_terminal(F.col("status"))).alias("all_settled"), F.count(F.lit(1)).alias("n_targets"), F.count_if(is_terminal(F.col("status"))).alias("n_terminal")
    )


def hourly_completeness(labels: DataFrame) -> DataFrame:
    """Distinct hours of each day of a series and a class: full (24), maint (22, 23), incomplete;
    the first and last day of a series, where not full, are edge. ``labels``: series, day, hour."""
    d = labels.groupBy("series", "day").agg(F.countDistinct("hour").alias("n_hours"))
    w = Window.partitionBy("series")
    edge = (F.col("day") == F.min("day").over(w)) | (F.col("day") == F.max("day").over(w))
    c = F.when(F.col("n_hours") == 24, "full").when(edge, "edge").when(F.col("n_hours") >= 22, "maint").otherwise("incomplete")
    return d.withColumn("class", c)


def digest(entries: DataFrame, floor: float) -> DataFrame:
    """One row about a set of sessions; absent figures are left out, not taken as 0."""
    return entries.agg(
        F.countDistinct("session").alias("n_sessions"), F.count(F.lit(1)).alias("n_tickers"), F.count_if(~F.col("complete")).alias("n_incomplete"),
        F.sum("n_gaps").alias("n_gaps"), F.sum("n_mismatches").alias("n_mismatches"), F.sum("n_underflows").alias("n_underflows"),
        F.min("uptime").alias("worst_uptime"), F.min_by("ticker", F.struct("uptime", "ticker")).alias("worst_ticker"), F.count_if(F.col("uptime") < floor).alias("n_below_floor"),
    )


def not_in(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return rows.join(other.select(key), key, "left_anti")


def search(markets: DataFrame, needle: str, *cols: str) -> DataFrame:
    """Rows one of whose columns contains the text, whatever the case."""
    hit: Column = F.lit(False)
    for c in cols:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(needle.lower())), F.lit(False))
    return markets.where(hit)


def close_window(markets: DataFrame, since_us: int | None, until_us: int | None) -> DataFrame:
    """Half-open window on close_us; an unknown close is left out as soon as a bound is set."""
    out = markets
    if since_us is not None:
        out = out.where(F.col("close_us") >= since_us)
    if until_us is not None:
        out = out.where(F.col("close_us") < until_us)
    return out


def team_match(markets: DataFrame, predicted: str | None, codes: list[str]) -> DataFrame:
    """Markets of the predicted event if there are any, else those whose event and ticker hold all codes."""
    hay = F.upper(F.concat_ws(" ", "event", "ticker"))
    by_code = F.forall(F.array(*[F.lit(c.upper()) for c in sorted(set(codes))]), lambda c: F.contains(hay, c)) if codes else F.lit(False)
    exact = F.coalesce(F.col("event") == F.lit(predicted), F.lit(False))
    found = markets.agg(F.coalesce(F.bool_or(exact), F.lit(False)).alias("_any"))  # one row
    return markets.crossJoin(F.broadcast(found)).where(F.when(F.col("_any"), exact).otherwise(by_code)).drop("_any")


def min_volume(markets: DataFrame, least: float) -> DataFrame:
    """Markets whose volume (text; what is no number counts as 0) reaches ``least``; all if that is 0."""
    return markets.where(number_or_zero(F.col("volume")) >= least) if least > 0 else markets


def spot_anchor(markets: DataFrame, by: str = "series") -> DataFrame:
    """Per series the strike of the open hourly market whose price is nearest to even, the first of equals.

    ``markets``: by, pos, strike, price (null: unknown), minutes. Series without such a market are left out.
    """
    known = markets.where(is_hourly(F.col("minutes")) & F.col("strike").isNotNull() & F.col("price").isNotNull())
    return known.groupBy(by).agg(F.min_by("strike", F.struct(atm_distance(F.col("price")), "pos")).alias("strike"))


def series_sums(markets: DataFrame, by: str = "series") -> DataFrame:
    """Per series: markets given, and the sums of their volumes (text; what is no number counts as 0)."""
    total = lambda c: F.sum(number_or_zero(F.col(c))).alias(c)
    return markets.groupBy(by).agg(F.count(F.lit(1)).alias("n_open"), total("volume"), total("volume_24h"))


def time_chunks(spark, lo_us: int, hi_us: int, step_us: int) -> DataFrame:
    """Half-open windows of a width that cover [lo, hi)."""
    if lo_us >= hi_us or step_us <= 0:
        return spark.createDataFrame([], "lo_us bigint, hi_us bigint")
    return spark.range(lo_us, hi_us, step_us).select(F.col("id").alias("lo_us"), F.least(F.col("id") + step_us, F.lit(hi_us)).alias("hi_us"))


def session_quality(manifest: DataFrame) -> DataFrame:
    """Gaps and incomplete tickers of a set of sessions, in one row."""
    return manifest.agg(F.coalesce(F.sum("gaps"), F.lit(0)).alias("gaps"), F.count_if(~F.col("complete")).alias("incomplete"))


def backfill_report(pages: DataFrame, trades_: DataFrame) -> DataFrame:
    """One row: fetched trades, distinct ones written, raw ones, duplicates and pages.

    ``pages``: one row per fetched page; ``trades_``: trade_id and error (null: decoded).
    """
    ok = F.col("error").isNull()
    t = trades_.agg(F.count(F.lit(1)).alias("fetched"), F.countDistinct(F.when(ok, F.col("trade_id"))).alias("written"), F.count_if(~ok).alias("raw"), F.count_if(ok).alias("_ok"))
    t = t.withColumn("duplicates", F.col("_ok") - F.col("written")).drop("_ok")
    return t.crossJoin(pages.agg(F.count(F.lit(1)).alias("pages")))  # one row each


def earliest_close(markets: DataFrame) -> DataFrame:
    return markets.agg(F.min("close_us").alias("close_us"))


def coverage_by_date(cover: DataFrame, date: str = "date") -> DataFrame:
    return cover.groupBy(date).agg(F.avg("uptime").alias("uptime"), F.sum("hole_us").alias("hole_us"))


def next_boundary(us: Column) -> Column:
    """The next full hour after an instant, in microseconds."""
    return (us - F.pmod(us, F.lit(3_600_000_000)) + 3_600_000_000).cast("bigint")


def seconds_to_midnight(us: Column) -> Column:
    """Seconds from an instant to the next UTC midnight."""
    day = F.lit(86_400_000_000)
    return ((day - F.pmod(us, day)) / 1_000_000).cast("bigint")


def discovery_window(start_us: Column, max_hours: Column) -> Column:
    """Close times among which a scheduled event's markets are looked for: from two hours before
    the start to four days after the longest play."""
    hour = 3_600_000_000
    return F.struct((start_us - 2 * hour).alias("lo_us"), (start_us + max_hours * hour + 96 * hour).alias("hi_us"))
