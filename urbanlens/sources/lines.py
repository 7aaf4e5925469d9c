"""Delimited text taken line by line: mixed headers, quarantine of malformed lines, file order.

Spark's text scan gives each line with its file and the start of its split, so
these readers know where a line came from, and read files of any store.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator, Sequence
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from urbanlens.session import settings_of, written
from urbanlens.sources.readers import union_sources

if __name__ != "__main__":
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WHOLE_FILES = str(1 << 60)


def _text(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).text(list(paths) if not isinstance(paths, str) else paths)


# --- Files with headers of their own --------------------------------------------------

def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a partition that is one file; the rest is not asked for."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def file_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, header): the first line of every file under ``paths``; files without a line are left out.

    A task a file reads its first lines only.
    """
    # No file is split and none shares a task.
    with settings_of(spark, {"spark.sql.files.maxPartitionBytes": _WHOLE_FILES, "spark.sql.files.openCostInBytes": _WHOLE_FILES,
                             "spark.sql.execution.arrow.maxRecordsPerBatch": "100"}):
        lines = _text(spark, paths).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("header"))
        return written(lines.mapInArrow(_first_line, "file string, header string"), "headers")


def _as_path(url: str) -> str:
    """A file's URL as a path for a reader: not encoded, and no character a pattern."""
    parts = urlsplit(url)
    path = "".join("\\" + c if c in "*?[]{}\\" else c for c in unquote(parts.path))
    return f"{parts.scheme}://{parts.netloc}{path}" if parts.scheme else path


def column_names(header: str, sep: str) -> list[str]:
    """The names of a header line; a name that is empty or taken (whatever its case) gets its place as a suffix."""
    names, taken = [], set()
    for i, name in enumerate(next(csv.reader([header], delimiter=sep), [])):
        name = name if name and name.lower() not in taken else f"{name or '_c'}{i}"
        taken.add(name.lower())
        names.append(name)
    return names


def read_mixed_headers(spark: SparkSession, paths: str | Sequence[str], sep: str = ",") -> DataFrame:
    """Delimited files, each read under its own header, united by name (all strings).

    Files of one folder may name their columns in any order, or lack some:
    those are null.  Files with equal headers are one scan.  The files' names,
    which Spark's driver lists for every scan, are what the driver holds.  A
    header is one line; files without any line add no rows.
    """
    headers = file_headers(spark, paths)
    groups = headers.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    if not groups:
        raise ValueError(f"no file with a header under {paths}")
    frames = []
    for group in groups:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in column_names(group["header"], sep)])
        frames.append(spark.read.schema(schema).option("header", True).option("sep", sep)
                      .csv([_as_path(f) for f in group["files"]]))
    return union_sources(frames, allow_missing=True)


# --- Malformed lines kept apart -------------------------------------------------------

_CORRUPT = "_malformed"


def quarantined(
    spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType, sep: str = ",",
    header: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of delimited text, from one scan: every line is in one of them.

    ``rows`` has the columns of ``schema``; ``rejects`` is (file, line, reason),
    with the line's text as it stands and ``reason`` one of ``empty line``,
    ``too few fields``, ``too many fields`` and ``unreadable value``.  Lines
    equal to ``header`` are in neither.  A record is one line.  The scan runs
    when this is called and is written once, by outcome, into the shared folder.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    typed = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    lines = _text(spark, paths).select("value", F.col("_metadata.file_path").alias("file"))
    if header is not None:
        lines = lines.where(F.col("value") != header)
    row = F.from_csv("value", _ddl(typed),
                     {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    # Fields of a line: its separators outside quotes.
    bare = F.regexp_replace("value", r'"(?:[^"\\]|\\.)*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(sep))) + 1
    reason = (F.when(F.trim("value") == "", "empty line").when(F.col(f"row.{_CORRUPT}").isNull(), F.lit(None))
              .when(fields < len(schema), "too few fields").when(fields > len(schema), "too many fields")
              .otherwise("unreadable value"))
    scan = lines.withColumn("row", row).withColumn("reason", reason)
    kept = written(scan.select("row", "reason", F.when(F.col("reason").isNotNull(), F.col("file")).alias("file"),
                               F.when(F.col("reason").isNotNull(), F.col("value")).alias("line")), "quarantine")
    rows = kept.where(F.col("reason").isNull()).select(*[F.col(f"row.`{f.name}`") for f in schema.fields])
    return rows, kept.where(F.col("reason").isNotNull()).select("file", "line", "reason")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


# --- Rows numbered as they stand in their files ---------------------------------------

def with_file_order(scan: DataFrame, name: str = "ord") -> DataFrame:
    """The rows of a file scan with their number (from 0) in file order.

    Files follow each other by path; inside a file rows count by the start of
    their split, then by their place in it.  However the scan is split, and in
    however many files, the numbers are the same.  ``scan`` is a reader's
    result with at most projections on it.  It is written to the shared folder
    when this is called, so that places are read once; one row a split is numbered.
    """
    if name in scan.columns:
        raise ValueError(f"the scan has a column {name!r} already")
    columns = [F.col(f"`{c}`") for c in scan.columns]
    placed = scan.select(F.struct(*columns).alias("row"), F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    placed = written(placed, "file-order")
    splits = placed.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1))
    starts = splits.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    number: Column = F.col("before") + F.col("at") - F.col("first")
    return placed.join(F.broadcast(starts), ["file", "block"]).select("row.*", number.alias(name))
