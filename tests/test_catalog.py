from pyspark.sql import functions as F

from ladderline.operators import catalog
from ladderline.plans import queries
from ladderline.sources import process
from ladderline.sources.arrow_files import read_arrow


def test_reports(spark, tmp_path):
    m = spark.createDataFrame([("a", 2, True, True), ("b", 1, False, False), ("c", 0, True, None)], "ticker string, gaps bigint, complete boolean, two_sided boolean")
    assert tuple(catalog.session_quality(m).first()) == (3, 1)
    assert sorted(r.ticker for r in process.curated(m).collect()) == ["a", "c"]
    t = spark.createDataFrame([("x", None), ("x", None), ("y", None), ("z", "bad")], "trade_id string, error string")
    assert catalog.backfill_report(spark.range(3), t).first().asDict() == {"fetched": 4, "written": 2, "raw": 1, "duplicates": 1, "pages": 3}
    process.write_feather(m, str(tmp_path / "m.feather"))
    assert read_arrow(spark, str(tmp_path / "m.feather")).count() == 3


def test_times(spark):
    r = spark.createDataFrame([(5_400_000_000,)], "us bigint").select(catalog.next_boundary(F.col("us")).alias("b"), catalog.seconds_to_midnight(F.col("us")).alias("s"), catalog.discovery_window(F.col("us"), F.lit(3)).alias("w")).first()
    assert (r.b, r.s, r.w.lo_us) == (7_200_000_000, 81_000, -1_800_000_000)
    assert [(x.lo_us, x.hi_us) for x in catalog.time_chunks(spark, 0, 25, 10).orderBy("lo_us").collect()] == [(0, 10), (10, 20), (20, 25)]


def test_arm_plan(spark):
    h = 3_600_000_000
    rows = [
        ("a", "Hourly", False, False, None, 0, h, False, False), ("b", "Hourly", False, False, None, 0, h, False, False), ("c", "Hourly", False, False, None, 50 * h, 51 * h, False, False),
        ("d", "Daily", False, False, None, 0, 24 * h, False, False), ("e", "Daily", False, True, None, 0, 24 * h, False, False), ("f", "Long", False, False, None, 0, 999 * h, False, False),
        ("g", "Other", True, False, None, 0, h, False, False), ("h", "Daily", False, False, 40 * h, 0, 50 * h, False, False), ("i", "Hourly", False, False, None, 0, h, True, False), ("j", "Hourly", False, False, None, 0, h, False, True),
    ]
    c = spark.createDataFrame(rows, "event string, cadence string, windowed boolean, clash_sub boolean, start_us bigint, open_us bigint, close_us bigint, in_flight boolean, done boolean")
    got = {r.event: (r.decision, r.no_start) for r in catalog.arm_plan(c, now_us=h, lead_us=600_000_000, max_units=3).collect()}
    want = {"a": "arm", "b": "arm", "c": "deferred", "d": "skipped", "e": "deferred", "f": "skipped", "g": "capped", "h": "deferred", "i": "excluded", "j": "excluded"}
    assert {k: v[0] for k, v in got.items()} == want and got["g"][1] and not got["a"][1]


def test_hourly_completeness_of_every_series(spark, sf_dir):
    hours = {}
    for r in spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate").collect():
        day = f"{r.o_orderdate:%y}{r.o_orderdate.timetuple().tm_yday // 35:02d}"
        hours.setdefault((f"KXO{r.o_custkey % 20}", day), set()).add(r.o_orderkey % 24)
    days = {}
    for s, day in hours:
        days.setdefault(s, []).append(day)
    want = {}
    for (s, day), h in hours.items():
        edge = day in (min(days[s]), max(days[s]))
        want[s, day] = (len(h), "full" if len(h) == 24 else "edge" if edge else "maint" if len(h) >= 22 else "incomplete")
    got = {(r.series, r.day): (r.n_hours, r["class"]) for r in queries.hourly_completeness(spark, sf_dir).collect()}
    assert got == want and len(days) == 20


def test_ranks_do_not_depend_on_partitions(spark):
    rows = [(f"t{i:03d}", float(i * 7 % 40)) for i in range(200)] + [("nan", float("nan")), ("none", None)]
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] if r[1] == r[1] else 1e9) if r[1] is not None else 0, r[0]))
    got = {r.ticker: r.position for r in catalog.rank_series(spark.createDataFrame(rows, "ticker string, volume double").repartition(7)).collect()}
    assert got == {t: i + 1 for i, (t, _) in enumerate(want)}


def test_instants(spark):
    from ladderline.functions import naming

    text = {"86400": (86400, 86400), " 1970-01-02 ": (86400, 172800), "1970-01-01T01:00:00+01:00": (0, 0), "1970-01-01T00:00:01.9Z": (1, 1), "-5": (-5, -5), "soon": (None, None), "2024-02-30": (None, None), "": (None, None)}
    df = spark.createDataFrame([(t,) for t in [*text, None]], "t string")
    got = {r.t: (r.a, r.u) for r in df.select("t", naming.instant_s(df.t).alias("a"), naming.until_s(df.t).alias("u")).collect()}
    assert got == text | {None: (None, None)}
