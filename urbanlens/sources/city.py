"""Typed readers for the city inputs: crimes, stations, census blocks, income.

Each reader maps the source's own column names to snake_case names and
types (``conform``), so the operators never see spaces or text numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanlens.functions.clean import parse_event_time, parse_money, parse_money_whole
from urbanlens.functions.geo import usable_coordinates
from urbanlens.sources.feature_scan import read_features_split
from urbanlens.sources.lines import read_mixed_headers, with_file_order
from urbanlens.sources.readers import (
    conform,
    flatten_features,
    observe_rejects,
    read_delimited,
    read_feature_lines,
    read_features,
    read_parquet,
    reject_counts,
    union_sources,
)

# Column names of the source files.
CRIME_COLUMNS = {
    "date_occ": ("DATE OCC", "string"),
    "time_occ": ("TIME OCC", "int"),
    "premis": ("Premis Desc", "string"),
    "lat": ("LAT", "double"),
    "lon": ("LON", "double"),
}
STATION_COLUMNS = {
    "division": ("DIVISION", "string"),
    "lat": ("Y", "double"),
    "lon": ("X", "double"),
}
BLOCK_PROPERTIES = T.StructType([
    T.StructField("ZCTA20", T.StringType()),
    T.StructField("POP20", T.LongType()),
    T.StructField("HOUSING20", T.LongType()),
])
# Our readers take the counts as variants and cast them: the same property may be 4, 4.0 or "4".
# (Reading JSON numbers into a text column works too, but takes about 50 microseconds a value.)
_LOOSE_PROPERTIES = T.StructType([
    T.StructField("ZCTA20", T.StringType()),
    T.StructField("POP20", T.VariantType()),
    T.StructField("HOUSING20", T.VariantType()),
])
_COUNT = "decimal(20,4)"
INCOME_KEY, INCOME_TEXT = "Zip Code", "Estimated Median Income"


def read_crimes(
    spark: SparkSession, paths: Sequence[str], fmt: str = "csv",
    columns: dict[str, tuple[str, str]] | None = None, own_headers: bool = False,
) -> DataFrame:
    """One or more crime files (CSV with header, or their Parquet copies).

    Files are combined by column name; only the columns in ``columns`` are
    read and typed.  ``own_headers``: the files of a folder differ in their
    headers, each is read under its own.
    """
    columns = columns or CRIME_COLUMNS
    return union_sources([conform(_raw(spark, path, fmt, own_headers), columns) for path in paths])


def _raw(spark: SparkSession, path: str, fmt: str, own_headers: bool = False) -> DataFrame:
    if fmt != "csv":
        return read_parquet(spark, path)
    return read_mixed_headers(spark, path) if own_headers else read_delimited(spark, path)


def crime_rejects(spark: SparkSession, paths: Sequence[str], fmt: str = "csv") -> DataFrame:
    """Per source file: rows, and rows each question has to leave out.

    ``bad_date``: date text missing or not in the event layout (dropped by the
    month ranking); ``bad_clock``: clock text present but not a number (it
    counts as night, like a missing clock); ``bad_coordinates``: latitude or
    longitude missing or not a finite number (left out by the nearest-site search,
    which uses the same condition).
    One aggregate scan per file; :func:`read_crimes_observed` counts in a query's own scan.
    """
    return _counted(paths, lambda path: _crime_text(_raw(spark, path, fmt)), _crime_checks())


def _counted(paths: Sequence[str], read: Callable[[str], DataFrame], checks: dict[str, Column]) -> DataFrame:
    """One aggregate scan a path."""
    return union_sources([reject_counts(read(path), checks).select(F.lit(path).alias("source"), "*") for path in paths])


def _observed(paths: Sequence[str], read: Callable[[str], DataFrame], checks: dict[str, Column],
              finish: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, dict[str, Observation]]:
    """The paths' rows, and per path an observation of its counts in the scan that gives those rows.

    The counts are there (``Observation.get``) when the first action on the
    result is done: no scan of their own.  Read each frame once in that
    action; a plan that scans twice counts twice.
    """
    frames, seen = [], {}
    for path in paths:
        rows, seen[path] = observe_rejects(read(path), checks)
        frames.append(finish(rows))
    return union_sources(frames), seen


def _crime_text(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(f"`{src}`").alias(name) for name, (src, _) in CRIME_COLUMNS.items()])


def _crime_checks() -> dict[str, Column]:
    return {
        "bad_date": parse_event_time("date_occ").isNull(),
        "bad_clock": F.col("time_occ").isNotNull() & F.trim("time_occ").try_cast("int").isNull(),
        "bad_coordinates": ~usable_coordinates(F.trim("lat").try_cast("double"), F.trim("lon").try_cast("double")),
    }


def read_crimes_observed(spark: SparkSession, paths: Sequence[str], fmt: str = "csv") -> tuple[DataFrame, dict[str, Observation]]:
    """``read_crimes``, and per path an observation of what ``crime_rejects`` counts (see ``_observed``)."""
    return _observed(paths, lambda path: _crime_text(_raw(spark, path, fmt)), _crime_checks(),
                     lambda text: conform(text, {name: (name, dtype) for name, (_, dtype) in CRIME_COLUMNS.items()}))


def observed_counts(spark: SparkSession, seen: dict[str, Observation]) -> DataFrame:
    """The counts of observations as ``crime_rejects`` gives them: one row a source.  Waits for the action."""
    rows = [{"source": path, **observation.get} for path, observation in seen.items()]
    return spark.createDataFrame(rows, ", ".join(["source string", *[f"{c} long" for c in rows[0] if c != "source"]]))


def read_stations(spark: SparkSession, path: str, order_col: str | None = None) -> DataFrame:
    """Stations as (ord, division, lat, lon).

    ``ord`` breaks distance ties.  Give ``order_col`` when the file has an
    explicit order; otherwise it is the row's number in file order, files by
    their path, however many files there are and however they are split
    (``with_file_order``).
    """
    raw = read_delimited(spark, path)
    columns = dict(STATION_COLUMNS)
    if order_col:
        columns["ord"] = (order_col, "long")
        return conform(raw, columns)
    needed = raw.select(*[F.col(f"`{source}`") for source, _ in STATION_COLUMNS.values()])
    return conform(with_file_order(needed), {**columns, "ord": ("ord", "long")})


def _count_text(name: str) -> Column:
    return F.trim(F.try_variant_get(F.col(name), "$", "string"))


def _blocks(flat: DataFrame) -> DataFrame:
    return flat.select(
        F.col("ZCTA20").alias("zip"), _count_text("POP20").try_cast(_COUNT).alias("population"),
        _count_text("HOUSING20").try_cast(_COUNT).alias("housing"))


def _features(spark: SparkSession, paths: str | Sequence[str], lines: bool, split: bool) -> DataFrame:
    if lines and split:
        raise ValueError("features are either one per line or in documents to split")
    read = read_feature_lines if lines else read_features_split if split else read_features
    return flatten_features(read(spark, paths, _LOOSE_PROPERTIES))


def read_census_blocks(spark: SparkSession, paths: str | Sequence[str], lines: bool = False,
                       split: bool = False) -> DataFrame:
    """GeoJSON census blocks -> (zip, population, housing); polygons are not read.

    ``lines``: one feature per line instead of collections.  ``split``: many
    tasks read one collection (``read_features_split``, which scans when called).
    """
    return _blocks(_features(spark, paths, lines, split))


def read_census_blocks_observed(spark: SparkSession, paths: Sequence[str], lines: bool = False,
                                split: bool = False) -> tuple[DataFrame, dict[str, Observation]]:
    """``read_census_blocks``, and per path an observation of what ``block_rejects`` counts."""
    return _observed(paths, lambda path: _features(spark, path, lines, split), _block_checks(), _blocks)


def read_income(spark: SparkSession, paths: str | Sequence[str], own_headers: bool = False) -> DataFrame:
    """';'-separated income table -> (zip, income_text); several files each under its own header.

    ``own_headers``: also the files inside one folder.
    """
    raw = read_mixed_headers(spark, paths, sep=";") if own_headers else read_delimited(spark, paths, sep=";")
    return raw.select(F.col(f"`{INCOME_KEY}`").alias("zip"), F.col(f"`{INCOME_TEXT}`").alias("income_text"))


def read_income_observed(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, dict[str, Observation]]:
    """``read_income``, and per path an observation of what ``income_rejects`` counts."""
    return _observed(paths, lambda path: read_income(spark, path), _income_checks(), lambda rows: rows)


def _block_checks() -> dict[str, Column]:
    return {
        "no_key": F.col("ZCTA20").isNull(),
        "bad_population": _count_text("POP20").isNotNull() & _count_text("POP20").try_cast(_COUNT).isNull(),
        "bad_housing": _count_text("HOUSING20").isNotNull() & _count_text("HOUSING20").try_cast(_COUNT).isNull(),
    }


def block_rejects(spark: SparkSession, paths: Sequence[str], lines: bool = False) -> DataFrame:
    """Per source: features, those without a key, and counts that are there but are no numbers."""
    return _counted(paths, lambda path: _features(spark, path, lines, False), _block_checks())


def _income_checks() -> dict[str, Column]:
    return {
        "short_line": F.col("income_text").isNull(),
        "bad_income": F.col("income_text").isNotNull() & parse_money("income_text").isNull(),
        "not_whole": F.col("income_text").isNotNull() & parse_money_whole("income_text").isNull(),
    }


def income_rejects(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Per source: rows, short lines, incomes that are unreadable, and those the strict reading drops."""
    return _counted(paths, lambda path: read_income(spark, path), _income_checks())


def _station_checks() -> dict[str, Column]:
    return {"bad_coordinates": ~usable_coordinates("lat", "lon")}


def station_rejects(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Per source: stations, and those without usable coordinates."""
    return _counted(paths, lambda path: conform(read_delimited(spark, path), STATION_COLUMNS), _station_checks())


def read_stations_observed(spark: SparkSession, path: str,
                           order_col: str | None = None) -> tuple[DataFrame, dict[str, Observation]]:
    """``read_stations``, and an observation of what ``station_rejects`` counts.

    The nearest-site search reads its sites more than once: write these first.
    """
    return _observed([path], lambda path: read_stations(spark, path, order_col), _station_checks(), lambda rows: rows)
