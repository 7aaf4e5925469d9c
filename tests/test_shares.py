from fixtures import Q1_EXPECTED
from files import write_crime_files
from pyspark.sql import functions as F

from urbanlens.operators.shares import share_by_bucket, time_of_day_share
from urbanlens.sources.city import read_crimes
from urbanlens.sources.writers import csv_to_parquet


def _street(crimes):
    return crimes.where(F.col("premis") == "STREET")


def test_share_per_part_of_day_from_two_csv_files(spark, tmp_dir):
    crimes = read_crimes(spark, write_crime_files(tmp_dir))
    got = [tuple(r) for r in time_of_day_share(_street(crimes), "time_occ").collect()]
    assert got == Q1_EXPECTED


def test_udf_form_gives_the_same_rows(spark, tmp_dir):
    crimes = read_crimes(spark, write_crime_files(tmp_dir))
    got = [tuple(r) for r in time_of_day_share(_street(crimes), "time_occ", method="udf").collect()]
    assert got == Q1_EXPECTED


def test_parquet_copy_gives_the_same_rows(spark, tmp_dir):
    csv_paths = write_crime_files(tmp_dir)
    written = csv_to_parquet(spark, {"a": csv_paths[0], "b": csv_paths[1]}, f"{tmp_dir}/parquet")
    raw = spark.read.parquet(written["a"])
    assert all(t == "string" for _, t in raw.dtypes)  # the copy keeps text columns
    crimes = read_crimes(spark, [written["a"], written["b"]], fmt="parquet")
    got = [tuple(r) for r in time_of_day_share(_street(crimes), "time_occ").collect()]
    assert got == Q1_EXPECTED


def test_rounding_modes_on_an_exact_tie(spark):
    # 1 of 800 rows is 0.125 %: half-up gives 0.13, half-even 0.12.
    df = spark.range(800).select(F.when(F.col("id") == 0, "a").otherwise("b").alias("k"))
    up = dict(share_by_bucket(df, "k", label="k").collect())
    even = dict(share_by_bucket(df, "k", label="k", rounding="half_even").collect())
    assert up["a"] == 0.13 and even["a"] == 0.12
    assert up["b"] == 99.88 and even["b"] == 99.88


def test_null_and_impossible_clocks_are_night(spark):
    df = spark.createDataFrame([(None,), (1160,), (2400,), (459,), (-5,)], "c int")
    assert [tuple(r) for r in time_of_day_share(df, "c").collect()] == [("night", 100.0)]
