"""Registered queries on inputs that ended them, or gave them other rows than their SQL."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from ladderline.operators import verify


def test_sums_beyond_64_bits_end_no_query(spark, tmp_path):
    n = 6000
    key = F.when(F.col("id") < n, 9).otherwise(10)
    spark.range(n + 100).select(key.cast("bigint").alias("l_orderkey"), F.col("id").alias("l_linenumber"), F.lit(3).cast("bigint").alias("l_partkey"), F.lit(2.0).alias("l_quantity")).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r["ticker"]: r.asDict() for r in entry.queries()["rest_trade_outcomes"](spark, str(tmp_path)).collect()}
    at = lambda k: 1704067207250000 + k * 60_000_000
    many, few = got["T0"], got["T1"]
    assert n * at(9) > (1 << 63) - 1 and (many["n"], many["event_ts_us_sum"]) == (n, None)
    assert (many["error"], many["price_micro_sum"], many["count_centi_sum"]) == (None, n * 30_000, n * 250)
    assert (few["n"], few["event_ts_us_sum"]) == (100, 100 * at(10))


def _dense(spark, n: int):
    """A ticker of n messages in three seconds, seen after every tenth, with ladders that recur."""
    lv = "array<struct<price:bigint,quantity:bigint>>"
    at = lambda c: f"array(named_struct('price', 1L, 'quantity', ({c}) % 4))"
    s = spark.range(n).selectExpr("'A' AS ticker", "id AS event_idx", "0L AS epoch", f"id * 3000000 div {n} AS recv_ts_us", f"CAST({at('id')} AS {lv}) AS yes", f"CAST(array() AS {lv}) AS no")
    o = spark.range(1, n // 10).selectExpr("'A' AS ticker", "id * 10 AS event_idx", f"id * 10 * 3000000 div {n} + 1 AS recv_ts_us", f"CAST({at('id * 10 - id % 7 + 3')} AS {lv}) AS yes", f"CAST(array() AS {lv}) AS no")
    return s, o


def _rows(df) -> int:
    """The most rows that a join of the plan, run, made."""
    import re

    df.collect()
    plan, most = df._jdf.queryExecution().executedPlan(), [0]

    def walk(p):
        if "Join" in p.nodeName() and p.metrics().contains("numOutputRows"):
            most[0] = max(most[0], p.metrics().apply("numOutputRows").value())
        kids = [p.executedPlan()] if p.nodeName() == "AdaptiveSparkPlan" else [p.plan()] if re.search("QueryStage", p.nodeName()) else [p.children().apply(i) for i in range(p.children().size())]
        for k in kids:
            walk(k)

    walk(plan)
    return most[0]


def test_checks_of_dense_books_pair_no_windows(spark):
    s, o = _dense(spark, 2000)
    got = verify.verify_outcomes(s, o, spark.createDataFrame([], "ticker string, recv_ts_us bigint"))
    assert _rows(got) <= 4 * 2000
    t = lambda i: i * 3_000_000 // 2000
    rows = {r["event_idx"]: (r["outcome"], r["match_lag_us"]) for r in got.collect()}
    for k in range(1, 200):
        i, ts = 10 * k, t(10 * k) + 1
        q = (i - k % 7 + 3) % 4
        back = next((j for j in range(i - 1, -1, -1) if j % 4 == q), None)
        ahead = next((j for j in range(i + 1, 2000) if j % 4 == q), None)
        if i % 4 == q:
            want = ("matched", 0)
        elif back is not None:
            want = ("matched", t(back) - ts)
        else:
            after = t(10 * k + 10) + 1 if k < 199 else None
            want = ("matched", t(ahead) - ts) if ahead is not None and (after is None or t(ahead) <= after) else ("mismatch", None)
        assert rows[i] == want, i


def test_a_session_is_accounted_for_on_one_book(spark, sf_dir, monkeypatch):
    from ladderline.plans import frames, queries

    built, saved = [], queries.saved
    monkeypatch.setattr(queries, "saved", lambda df, label: (built.append(label), saved(df, label))[1])
    frames._accounted(spark, sf_dir)
    assert built.count("book_events") == 1


def test_top_k_joins_without_the_driver(spark):
    """What the planner takes for small, blocks of vectors and the visits to them, is shuffled all the same."""
    import numpy as np

    from ladderline.llm import topk

    x = np.floor(np.random.default_rng(5).normal(size=(400, 8)) * 1024).astype(int)
    df = spark.createDataFrame([(i, (v / 1024).tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "1g")
    try:
        got = topk.top_k(df, df.where("vec_id % 100 = 0"), 10, p=topk.IndexParams(pivots=8, rings=4, block=32, query_block=16))
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set(threshold, before)
    assert plan.count("SortMergeJoin(skew=true) [cell#") + plan.count("SortMergeJoin [cell#") == 2
    assert "BroadcastHashJoin [cell#" not in plan
    want = [(q, r + 1, j, int(x[q] @ x[j])) for q in range(0, 400, 100) for r, j in enumerate(sorted((j for j in range(400) if j != q), key=lambda j: (-int(x[q] @ x[j]), j))[:10])]
    assert sorted(map(tuple, rows)) == want


def test_top_k_visits_no_more_rings_than_fill_blocks(spark):
    import numpy as np

    from ladderline.llm import topk

    x = np.random.default_rng(6).normal(size=(400, 8)).tolist()
    df = spark.createDataFrame(list(enumerate(x)), "vec_id bigint, embedding array<double>").coalesce(1)
    # Four queries in as many blocks at most, and a ring for each of 32 pivots.
    assert _rows(topk.top_k(df, df.where("vec_id % 100 = 0"))) <= 4 * 32
