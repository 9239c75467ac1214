"""Side files of a session: schedules, market lists, progress logs, and durations in options."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import rfc3339_us

#: Keys of a schedule entry (the first three are required), seconds of a unit.
SCHEDULE = "id STRING, label STRING, series STRING, event_ticker STRING, teams ARRAY<STRING>, start_utc STRING, arm_lead_min BIGINT, max_hours BIGINT, remote_prefix STRING"
UNITS = {"": 1, "s": 1, "m": 60, "h": 3600, "d": 86400}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.format("text").load(path).where(F.trim(F.regexp_replace("value", "^﻿", ""), F.lit(" \t\r")) != "")
    return text.select(F.regexp_replace("value", "^﻿", "").alias("text"))


def schedule(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a JSONL schedule with ``reject`` (null: valid): malformed or unresolvable.

    A byte order mark and blank lines are ignored; an unknown key makes a line malformed; an
    entry needs a predicted event or team codes.
    """
    e = _lines(spark, path).withColumn("_e", F.from_json("text", SCHEDULE)).withColumn("_k", F.json_object_keys(F.col("text")))
    known = F.array(*[F.lit(x.split()[0]) for x in SCHEDULE.split(", ")])
    start = rfc3339_us(F.col("_e.start_utc"))
    bad = F.col("_k").isNull() | (F.size(F.array_except("_k", known)) > 0) | F.col("_e.id").isNull() | F.col("_e.series").isNull() | start.isNull()
    lost = F.col("_e.event_ticker").isNull() & (F.coalesce(F.size("_e.teams"), F.lit(0)) <= 0)
    return e.select("_e.*", start.alias("start_us"), F.when(bad, "malformed").when(lost, "unresolvable").alias("reject"))


def arm_order(entries: DataFrame, now_us: int, default_lead_min: int) -> DataFrame:
    """Valid entries that don't lie in the past, by the moment to arm (start less the lead, which is not negative)."""
    lead = F.greatest(F.coalesce("arm_lead_min", F.lit(default_lead_min)), F.lit(0))
    e = entries.where("reject IS NULL").withColumn("arm_us", F.col("start_us") - lead * 60_000_000)
    return e.where(F.col("start_us") >= now_us).orderBy("arm_us", "id")


def markets(spark: SparkSession, path: str, since_us: int | None = None, until_us: int | None = None) -> DataFrame:
    """A market list; a malformed line is an error, the close window is half-open."""
    from ..operators.catalog import close_window

    m = spark.read.option("mode", "FAILFAST").schema("ticker STRING, event_ticker STRING, status STRING, open_time STRING, close_time STRING, volume_fp STRING").json(path)
    us = lambda c: rfc3339_us(F.col(c))
    return close_window(m.withColumns({"open_us": us("open_time"), "close_us": us("close_time")}), since_us, until_us)


def done_tickers(spark: SparkSession, path: str) -> DataFrame:
    """Distinct tickers of a progress log; torn lines are skipped."""
    return _lines(spark, path).select(F.from_json("text", "ticker STRING").ticker.alias("ticker")).where("ticker IS NOT NULL").distinct()


def duration_s(text: str) -> int:
    """Seconds of 300, 90s, 5m, 1h or 2d; an error if malformed or beyond 64 bits."""
    m = re.fullmatch(r"\s*([0-9]+)\s*([smhd]?)\s*", text)
    if not m or (n := int(m[1]) * UNITS[m[2]]) >= 1 << 64:
        raise ValueError(f"invalid duration {text!r}")
    return n
