"""Inputs of the catalogue queries, derived from the driver's tables.

The questions were asked of city data (crimes, police stations, census
blocks, incomes).  Here each input is re-hosted on a driver table, keeping
the shape the question needs:

* crimes with a clock      -> ``events`` (clock = HHMM of ``ts``)
* crimes with a date       -> ``orders.o_orderdate``
* census blocks            -> ``lineitem`` (area = ``l_suppkey``, null for every
  11th order; population = ``l_quantity``, zero on every 4th line and for
  every 13th area; housing = ``l_linenumber``)
* income per area          -> ``supplier`` (area = ``s_suppkey``, income text
  = "$" + thousands-grouped ``floor(s_acctbal)``; a negative balance is the
  unreadable text "n/a"; every 10th area has a second row)
* crimes with coordinates  -> ``customer``; stations -> ``supplier`` (their
  coordinates repeat with period 83,200, the only input here that does not
  keep growing)

Areas grow with the supplier table: 100 at sf0.01, 1,000 at sf0.1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.functions.clean import clock_of

# Fixed values of the re-hosting (coordinates fall in a box around a city).
LAT_BASE, LON_BASE = 33.70, -118.67
LAT_SPAN, LON_SPAN = 6400, 5200
POINT_LAT_MULT, POINT_LON_MULT = 7919, 104729
SITE_LAT_MULT, SITE_LON_MULT = 6151, 4957
COORD_SCALE = 10000.0
# Boundary splitting one table into two sources.
EVENTS_SPLIT = "2024-01-16 00:00:00"
ORDERS_SPLIT = "1998-07-15 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def error_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one kind, with the HHMM clock of their time."""
    ev = table(spark, sf_dir, "events")
    return ev.where(F.col("event_type") == "error").select(clock_of("ts").alias("clock"))


def split_sources(df: DataFrame, ts: str, boundary: str) -> tuple[DataFrame, DataFrame]:
    """Two sources holding every row once: before ``boundary`` and the rest."""
    # The boundary takes the column's own type (with or without time zone),
    # so the split does not depend on the session time zone.  Both conditions
    # are plain comparisons, so they reach the Parquet scan (row-group pruning).
    bound = F.lit(boundary).cast(df.schema[ts].dataType)
    t = F.col(ts)
    return df.where(t < bound), df.where((t >= bound) | t.isNull())


def income_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(zip, name, income_text) with money written as text."""
    sup = table(spark, sf_dir, "supplier")
    text = F.when(F.col("s_acctbal") < 0, F.lit("n/a")).otherwise(
        F.concat(F.lit("$"), F.format_number(F.floor("s_acctbal"), 0)))
    return sup.select(
        F.col("s_suppkey").cast("string").alias("zip"),
        F.col("s_name").alias("name"),
        text.alias("income_text"),
    )


def income_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``income_text`` with a second row, of another income, for every 10th area."""
    once = income_text(spark, sf_dir)
    again = once.where(F.col("zip").cast("long") % 10 == 0).select(
        "zip", F.concat("name", F.lit(" II")).alias("name"), F.lit("$1,234").alias("income_text"))
    return once.unionByName(again)


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(zip, population, housing) rows, many per area."""
    lines = table(spark, sf_dir, "lineitem")
    empty = (F.col("l_linenumber") % 4 == 0) | (F.col("l_suppkey") % 13 == 0)
    return lines.select(
        F.when(F.col("l_orderkey") % 11 != 0, F.col("l_suppkey").cast("string")).alias("zip"),
        F.when(empty, 0).otherwise(F.col("l_quantity")).cast("long").alias("population"),
        F.col("l_linenumber").cast("long").alias("housing"),
    )


def _coord(key: str, base: float, mult: int, span: int):
    return F.lit(base) + ((F.col(key) * mult) % span) / F.lit(COORD_SCALE)


def points(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    return cust.select(
        "c_custkey", *extra,
        _coord("c_custkey", LAT_BASE, POINT_LAT_MULT, LAT_SPAN).alias("lat"),
        _coord("c_custkey", LON_BASE, POINT_LON_MULT, LON_SPAN).alias("lon"),
    )


def sites(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    sup = table(spark, sf_dir, "supplier")
    return sup.select(
        *extra,
        F.col("s_suppkey").alias("ord"),
        F.col("s_name").alias("division"),
        _coord("s_suppkey", LAT_BASE, SITE_LAT_MULT, LAT_SPAN).alias("lat"),
        _coord("s_suppkey", LON_BASE, SITE_LON_MULT, LON_SPAN).alias("lon"),
    )


def text_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``points`` as text; every 7th latitude is null, a word, NaN, infinite or outside the usual range."""
    pts = points(spark, sf_dir)
    odd = F.when(F.col("c_custkey") % 7 != 0, F.col("lat").cast("string"))
    for rest, text in ((0, None), (1, "n/a"), (2, "NaN"), (3, "Infinity"), (4, "95.5")):
        odd = odd.when(F.col("c_custkey") % 5 == rest, F.lit(text))
    return pts.select("c_custkey", odd.alias("lat"), F.col("lon").cast("string").alias("lon"))
