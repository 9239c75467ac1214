"""Arrow files: written and read by tasks, committed by renaming."""

import pytest
from pyspark.sql import functions as F

from ladderline.sources.arrow_files import read_arrow, write_arrow


def _frame(spark, n=1000):
    return spark.range(n).repartition(3).select(
        "id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("é"), "id")).alias("text"), F.array("id", F.lit(None).cast("bigint")).alias("many"),
        F.struct((F.col("id") / 3).alias("x"), F.lit(True).alias("y")).alias("both"), F.timestamp_micros(F.col("id")).alias("at"), (F.col("id") % 100).cast("decimal(10,2)").alias("d"),
    )


def test_round_trip_a_file_a_partition(spark, tmp_path):
    df, out = _frame(spark), str(tmp_path / "a")
    write_arrow(df, out)
    assert len(list((tmp_path / "a").iterdir())) == 3
    got = read_arrow(spark, out)
    assert got.dtypes == df.dtypes and got.rdd.getNumPartitions() == 3
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    one = str(next((tmp_path / "a").iterdir()))
    assert 0 < read_arrow(spark, one).count() < 1000
    import pyarrow.feather

    assert pyarrow.feather.read_table(one).num_rows == read_arrow(spark, one).count()


def test_append_overwrite_and_no_rows(spark, tmp_path):
    out = str(tmp_path / "a")
    write_arrow(_frame(spark, 10), out)
    write_arrow(_frame(spark, 5), out, "append")
    assert read_arrow(spark, out).count() == 15
    write_arrow(_frame(spark, 0), out)
    assert read_arrow(spark, out).count() == 0 and read_arrow(spark, out).columns == _frame(spark).columns
    with pytest.raises(Exception, match="no .arrow files"):
        read_arrow(spark, str(tmp_path / "none")).count()


def test_a_failed_job_leaves_what_was_there(spark, tmp_path):
    out = str(tmp_path / "a")
    write_arrow(_frame(spark, 10), out)
    bad = _frame(spark, 1000).withColumn("id", F.when(F.col("id") == 777, F.raise_error(F.lit("no")).cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        write_arrow(bad, out)
    assert read_arrow(spark, out).count() == 10 and all(f.name.startswith("part-") for f in (tmp_path / "a").iterdir())
