"""Command line: the four questions and the CSV -> Parquet conversion over files.

    python -m urbanlens share   --crimes A.csv B.csv [--premise STREET] [--method expr|udf]
    python -m urbanlens months  --crimes A.csv B.csv [--ties rank|row_number] [--per-source] [--sql]
    python -m urbanlens area    --blocks blocks.geojson --income income.csv [--strict] [--join auto|...]
    python -m urbanlens nearest --crimes A.csv B.csv --stations stations.csv [--strategy auto|array|grid]
    python -m urbanlens to-parquet --crimes A.csv B.csv --out DIR

Common: ``--format csv|parquet`` for crime files, ``--output PATH`` to write
the result as headerless CSV (otherwise up to 50 rows are shown): one file for
shares and months, several for area and nearest, whose results grow, unless
``--single-file`` is given.  ``--explain`` prints the plan first.
"""

from __future__ import annotations

import argparse
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.functions.clean import EVENT_TIME_FORMAT, parse_event_time
from urbanlens.operators.areas import JOIN_STRATEGIES, area_ratio, income_lookup
from urbanlens.operators.nearest import nearest_site, nearest_site_summary
from urbanlens.operators.ranking import monthly_top_k, monthly_top_k_sql
from urbanlens.operators.shares import time_of_day_share
from urbanlens.plans.inspect import physical_plan
from urbanlens.session import get_session
from urbanlens.sources.city import read_census_blocks, read_crimes, read_income, read_stations
from urbanlens.sources.writers import csv_to_parquet, write_result


def _share(spark: SparkSession, a) -> DataFrame:
    crimes = read_crimes(spark, a.crimes, fmt=a.format, own_headers=a.own_headers)
    return time_of_day_share(crimes.where(F.col("premis") == a.premise), "time_occ",
                             method=a.method, rounding=a.rounding)


def _months(spark: SparkSession, a) -> DataFrame:
    sources = [read_crimes(spark, [p], fmt=a.format, own_headers=a.own_headers) for p in a.crimes]
    if a.sql:
        named = {f"crimes{i + 1}": s for i, s in enumerate(sources)}
        return monthly_top_k_sql(spark, named, f"try_to_timestamp(date_occ, '{EVENT_TIME_FORMAT}')", k=a.k)
    times = [s.select(parse_event_time("date_occ").alias("t")) for s in sources]
    return monthly_top_k(times, "t", k=a.k, ties=a.ties, combine=not a.per_source)


def _area(spark: SparkSession, a) -> DataFrame:
    income = income_lookup(read_income(spark, a.income, own_headers=a.own_headers), "zip", "income_text", strict=a.strict)
    return area_ratio(read_census_blocks(spark, a.blocks, lines=a.lines, split=a.split), income, strict=a.strict,
                      digits=a.digits, join_strategy=a.join)


def _nearest(spark: SparkSession, a) -> DataFrame:
    crimes = read_crimes(spark, a.crimes, fmt=a.format, own_headers=a.own_headers)
    stations = read_stations(spark, a.stations, order_col=a.order_column)
    return nearest_site_summary(nearest_site(crimes, stations, strategy=a.strategy))


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="urbanlens", description=__doc__.split("\n")[0])
    p.add_argument("--master", help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="command", required=True)

    def common(sp, crimes=True):
        if crimes:
            sp.add_argument("--crimes", nargs="+", required=True)
            sp.add_argument("--format", choices=("csv", "parquet"), default="csv")
        sp.add_argument("--own-headers", action="store_true", help="text files of a folder differ in their headers")
        sp.add_argument("--output")
        sp.add_argument("--single-file", action="store_true", help="one output file whatever the question")
        sp.add_argument("--explain", action="store_true", help="print the physical plan first")

    s = sub.add_parser("share", help="share of crimes per part of day")
    common(s)
    s.add_argument("--premise", default="STREET")
    s.add_argument("--method", choices=("expr", "udf"), default="expr")
    s.add_argument("--rounding", choices=("half_up", "half_even", "binary"), default="half_up")

    m = sub.add_parser("months", help="busiest months of every year")
    common(m)
    m.add_argument("--k", type=int, default=3)
    m.add_argument("--ties", choices=("rank", "row_number"), default="rank")
    m.add_argument("--per-source", action="store_true", help="count each file on its own")
    m.add_argument("--sql", action="store_true", help="per-source form in SQL with ROW_NUMBER")

    r = sub.add_parser("area", help="average income per ZIP")
    common(r, crimes=False)
    r.add_argument("--blocks", nargs="+", required=True)
    r.add_argument("--income", nargs="+", required=True)
    shape = r.add_mutually_exclusive_group()
    shape.add_argument("--lines", action="store_true", help="blocks are one feature per line")
    shape.add_argument("--split", action="store_true", help="many tasks read one collection")
    r.add_argument("--strict", action="store_true")
    r.add_argument("--digits", type=int)
    r.add_argument("--join", choices=JOIN_STRATEGIES, default="auto")

    n = sub.add_parser("nearest", help="crimes per nearest station and mean distance")
    common(n)
    n.add_argument("--stations", required=True)
    n.add_argument("--order-column", help="station column giving the tie-break order")
    n.add_argument("--strategy", choices=("auto", "array", "grid"), default="auto")

    c = sub.add_parser("to-parquet", help="convert crime CSV files to Parquet")
    c.add_argument("--crimes", nargs="+", required=True)
    c.add_argument("--out", required=True)
    return p


QUESTIONS = {"share": _share, "months": _months, "area": _area, "nearest": _nearest}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame | None:
    a = build_parser().parse_args(argv)
    spark = spark or get_session(master=a.master)
    if a.command == "to-parquet":
        names = {os.path.splitext(os.path.basename(p.rstrip("/")))[0]: p for p in a.crimes}
        for name, path in csv_to_parquet(spark, names, a.out).items():
            print(f"{name}: {path}")
        return None
    result = QUESTIONS[a.command](spark, a)
    if a.explain:
        print(physical_plan(result))
    start = time.perf_counter()
    if a.output:
        write_result(result, a.output, single_file=a.single_file or a.command in ("share", "months"))
        print(f"written: {a.output}")
    else:
        result.show(50, truncate=False)
    print(f"elapsed_seconds={time.perf_counter() - start:.3f}")
    return result


if __name__ == "__main__":
    main()
