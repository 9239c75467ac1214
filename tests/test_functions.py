from pyspark.sql import functions as F

from ladderline.functions import naming, units


def _col(spark, values, make, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(make(F.col("x"))).collect()]


def test_parse_price(spark):
    text = ["0.0800", "1", "0.1234567", "abc", "", "-0.5", "-0", "5000", "+1", "1e3", " 1", "1.", ".5", None]
    assert _col(spark, text, units.parse_price) == [80000, 1000000] + [None] * 12
    errors = _col(spark, text, lambda c: units.parse_error(c, 6, units.U32_MAX))
    assert errors == [None, None, "too_many_decimals", "not_numeric", "empty", "negative", "negative", "overflow", "not_numeric", "not_numeric", "not_numeric", "not_numeric", "not_numeric", "empty"]


def test_parse_delta(spark):
    assert _col(spark, ["-5.25", "5", "0.1", "99999999999999999999999999999999999999999"], units.parse_delta) == [-525, 500, 10, None]


def test_format(spark):
    assert _col(spark, [450000, -1, 0, -1234567], lambda c: units.format_scaled(c, 6), "bigint") == ["0.450000", "-0.000001", "0.000000", "-1.234567"]


def test_event_start_follows_the_date_rule(spark):
    hour = 3_600_000_000
    names = ["S-24JAN011200", "S-24JUL011200", "S-24MAR100030", "S-24NOV030030", "S-24JAN01120", "S-24FEB301200", "S-24JAN0112001"]
    got = _col(spark, names, naming.event_start_us)
    base = 1704067200000000
    assert got[0] == base + 17 * hour and got[1] == base + 182 * 24 * hour + 16 * hour
    assert got[2] == base + 69 * 24 * hour + 4 * hour + hour // 2 and got[3] == base + 307 * 24 * hour + 5 * hour + hour // 2
    assert got[4:] == [None, None, None]


def test_names(spark):
    assert _col(spark, ["KXBTCD-26JUL0306-T6", "X-26FEB30", "none"], lambda c: naming.ticker_date(c).cast("string")) == ["2026-07-03", None, None]
    assert _col(spark, ["  A & b!", "--x--"], naming.slug) == ["a-b", "x"]
    assert _col(spark, ["ok-1.x", "..", "a/b", "", None], naming.is_safe_segment) == [True, False, False, False, False]
    assert _col(spark, ["settled", "open", None], naming.is_terminal) == [True, False, False]
    assert _col(spark, [60, 49, 1440, 10000, 10861, None], naming.cadence, "bigint") == ["Hourly", "Other", "Daily", "Weekly", "Long", "Other"]
