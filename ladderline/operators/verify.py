"""Checks of the replayed book against independent observations.

An observation may describe a state up to ``window_us`` to either side of it. The verdict is
one of matched (with the lag of the state that it matches), mismatch, skipped_gap (the book
was suspect) and truncated (the capture ends before it can be told).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.units import PRICE_SCALE, QTY_SCALE, format_scaled
from ..sources.scratch import saved
from . import scan
from .asof import asof_backward

WINDOW_US = 5_000_000


def near(book_events: DataFrame, observed: DataFrame, window_us: int = WINDOW_US) -> DataFrame:
    """(ticker, event_idx) of the messages whose ladders a check can need: those received within a
    window of an observation, and the ones in force at its ends."""
    e = book_events.select("ticker", "event_idx", "recv_ts_us").distinct()
    o = observed.select("ticker", F.col("recv_ts_us").alias("ts"))
    bucket = lambda c: F.floor(c / window_us)
    around = o.select("ticker", F.explode(F.array(*[bucket(F.col("ts") + k * window_us) for k in (-1, 0, 1)])).alias("_b")).distinct()
    inside = e.withColumn("_b", bucket(F.col("recv_ts_us"))).join(around, ["ticker", "_b"], "left_semi").select("ticker", "event_idx")
    ends = o.select("ticker", F.explode(F.array(F.col("ts") - window_us, F.col("ts"))).alias("at")).distinct()
    held = asof_backward(ends, e, "ticker", "at", "recv_ts_us", "event_idx", ["event_idx"])
    return inside.unionByName(held.select("ticker", "event_idx").where("event_idx IS NOT NULL")).unionByName(observed.select("ticker", "event_idx")).distinct()


def verify_outcomes(states: DataFrame, observed: DataFrame, gaps: DataFrame, window_us: int = WINDOW_US) -> DataFrame:
    """states: (ticker, event_idx, epoch, recv_ts_us, yes, no) of all messages, ladders of those that
    ``near`` names at least (null in others); observed: (ticker, event_idx of the
    last book event before it, recv_ts_us, yes, no); gaps: (ticker, recv_ts_us) of the book channel.

    event_idx counts a ticker's messages from 0, and receive times don't decrease inside it. So of the
    states equal to an observation only the last before it and the first after it can count: they
    are as-of joins by ticker and ladder, in the order of event_idx, and cost follows the rows,
    whatever the number of messages in a window.
    """
    s = states.select("ticker", F.col("event_idx").alias("j"), "epoch", F.col("recv_ts_us").alias("t"), F.struct("yes", "no").alias("book"))
    v = observed.select("ticker", F.col("event_idx").alias("i"), F.col("recv_ts_us").alias("ts"), F.struct("yes", "no").alias("rest"))
    w_v = Window.partitionBy("ticker").orderBy("i")
    v = v.withColumn("next_verify", F.lead("ts").over(w_v)).withColumn("next_verify_i", F.lead("i").over(w_v))

    # The state in force, and whether a gap came after its snapshot.
    cur = s.select("ticker", F.col("j").alias("i"), F.col("t").alias("cur_t"), F.col("book").alias("cur"), "epoch")
    v = v.join(cur, ["ticker", "i"], "left")
    snap_t = s.where("j = epoch").select("ticker", "epoch", F.col("t").alias("snap_t"))
    same = lambda c: F.concat("ticker", F.lit(" "), F.sha2(F.col(c).cast("string"), 256))
    v = saved(v.join(snap_t, ["ticker", "epoch"], "left").withColumns({"_k": same("rest"), "_id": F.monotonically_increasing_id()}), "observations")
    marks = v.select("ticker", F.col("ts").alias("m"), F.lit(1).alias("lane"), "i").unionByName(gaps.select("ticker", F.col("recv_ts_us").alias("m"), F.lit(0).alias("lane"), F.lit(None).cast("bigint").alias("i")))
    g = F.when(F.col("lane") == 0, F.col("m"))
    so_far = (Window.unboundedPreceding, Window.currentRow)
    # Looking ahead is looking back in reversed order: frames that end at the last row are
    # computed anew for every row.
    forward, backward = Window.partitionBy("ticker").orderBy("m", "lane"), Window.partitionBy("ticker").orderBy(F.desc("m"), F.desc("lane"))
    marks = marks.withColumn("gap_before", F.max(g).over(forward.rowsBetween(*so_far))).withColumn("gap_after", F.min(g).over(backward.rowsBetween(*so_far)))
    v2 = v.join(marks.where("lane = 1").select("ticker", "i", "gap_before", "gap_after"), ["ticker", "i"])

    # States with a ladder that some observation of the ticker shows: few of them all.
    shown = v.select("ticker", F.col("rest").alias("book"), "_k").distinct()
    told = saved(s.where("book.yes IS NOT NULL AND book.no IS NOT NULL").join(shown, ["ticker", "book"]).select("_k", "j", "t"), "told")
    lo = F.col("ts") - window_us
    by_idx, looks = scan.by_position("_ts"), v.where("i IS NOT NULL")
    back = asof_backward(looks.select("_id", "_k", (F.col("i") - 1).alias("at")), told, "_k", "at", "j", "j", ["j", "t"], by_idx).where("j IS NOT NULL")
    # A state holds until the next message.
    succ = s.select("ticker", (F.col("j") - 1).alias("j"), F.col("t").alias("succ"))
    back = back.join(v.select("_id", "ticker", "ts", "cur_t"), "_id").join(succ, ["ticker", "j"]).where((F.col("succ") > F.col("cur_t") - window_us) & (F.col("succ") >= lo)).select("_id", F.col("t").alias("back_t"))
    after = told.select("_k", (-F.col("j")).alias("_j"), F.col("t").alias("ahead_t"))
    ahead = asof_backward(looks.select("_id", "_k", "ts", (-F.col("i") - 1).alias("at")), after, "_k", "at", "_j", "_j", ["ahead_t"], by_idx)
    ahead = ahead.where(F.col("ahead_t") <= F.col("ts") + window_us).select("_id", "ahead_t")
    # The first book event beyond the window settles a mismatch.
    late = s.select("ticker", (-F.col("t")).alias("_t"), F.col("t").alias("late_t"))
    edge = asof_backward(v.select("_id", "ticker", (-F.col("ts") - window_us - 1).alias("at")), late, "ticker", "at", "_t", "_t", ["late_t"], F.floor(F.col("_ts") / window_us)).select("_id", "late_t")

    r = v2.join(back, "_id", "left").join(ahead, "_id", "left").join(edge, "_id", "left")
    suspect = F.col("gap_before").isNotNull() & (F.col("snap_t").isNull() | (F.col("gap_before") > F.col("snap_t")))
    inf = F.lit((1 << 63) - 1)
    far = lambda c: F.coalesce(F.col(c), inf)
    gap_t, ver_t, hit_t, late_t = far("gap_after"), far("next_verify"), far("ahead_t"), far("late_t")
    first = F.least(gap_t, ver_t, hit_t, late_t)
    outcome = (
        F.when(suspect, "skipped_gap").when(F.col("cur") == F.col("rest"), "matched").when(F.col("back_t").isNotNull(), "matched")
        .when(first == inf, "truncated").when(hit_t == first, "matched").when(gap_t == first, "skipped_gap").otherwise("mismatch")
    )
    lag = (
        F.when(F.col("outcome") != "matched", None).when(F.col("cur") == F.col("rest"), F.lit(0))
        .when(F.col("back_t").isNotNull(), F.greatest(F.col("back_t"), lo) - F.col("ts")).otherwise(F.col("ahead_t") - F.col("ts"))
    )
    r = r.withColumn("outcome", outcome).withColumn("match_lag_us", lag.cast("bigint"))
    return r.select("ticker", F.col("i").alias("event_idx"), F.col("ts").alias("recv_ts_us"), "outcome", "match_lag_us", F.col("cur.yes").alias("our_yes"), F.col("cur.no").alias("our_no"), F.col("rest.yes").alias("rest_yes"), F.col("rest.no").alias("rest_no"))


def level_diff(outcomes: DataFrame) -> DataFrame:
    """Per mismatch and side: how many prices differ, and the lowest of them with both quantities
    (null: absent). A full outer join on price of ours and theirs."""
    bad, key = outcomes.where("outcome = 'mismatch'"), ["ticker", "event_idx"]

    def side(ours: str, theirs: str, name: str) -> DataFrame:
        a = bad.select(*key, F.explode(ours).alias("l")).select(*key, "l.price", F.col("l.quantity").alias("ours"))
        b = bad.select(*key, F.explode(theirs).alias("l")).select(*key, "l.price", F.col("l.quantity").alias("rest"))
        d = a.join(b, [*key, "price"], "full").where("NOT (ours <=> rest)")
        first = d.groupBy(*key).agg(F.count(F.lit(1)).alias("n_differing"), F.min_by(F.struct("price", "ours", "rest"), "price").alias("f"))
        return first.select(*key, F.lit(name).alias("side"), "n_differing", F.col("f.price").alias("first_price_micro"), F.col("f.ours").alias("our_qty_centi"), F.col("f.rest").alias("rest_qty_centi"))

    return side("our_yes", "rest_yes", "yes").unionByName(side("our_no", "rest_no", "no"))


def with_detail(outcomes: DataFrame) -> DataFrame:
    """Outcomes with ``detail``: for a mismatch, per side, how many levels differ and the lowest
    of them with both quantities; null for others."""
    qty = lambda c: F.coalesce(format_scaled(F.col(c), QTY_SCALE), F.lit("absent"))
    first = F.concat(F.lit(" (first at "), format_scaled(F.col("first_price_micro"), PRICE_SCALE), F.lit(": ours "), qty("our_qty_centi"), F.lit(" vs rest "), qty("rest_qty_centi"), F.lit(")"))
    of = lambda s: F.max(F.when(F.col("side") == s, F.concat(F.col("n_differing").cast("string"), F.lit(" level(s) differ"), first)))
    none = F.lit("0 level(s) differ")
    sides = level_diff(outcomes).groupBy("ticker", "event_idx").agg(of("yes").alias("_yes"), of("no").alias("_no"))
    text = F.concat(F.lit("yes: "), F.coalesce("_yes", none), F.lit("; no: "), F.coalesce("_no", none))
    return outcomes.join(sides, ["ticker", "event_idx"], "left").withColumn("detail", F.when(F.col("outcome") == "mismatch", text)).drop("_yes", "_no")
