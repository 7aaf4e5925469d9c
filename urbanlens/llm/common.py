"""Helpers shared by the operators of this package."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanlens.session import checkpoint_dir, scratch_path

# The white space and the letters that the contracts name.
SPACES = "\t\n\x0b\x0c\r "
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

ARROW_ROWS = 2_000
ARROW_BYTES = 8 << 20

#: At most this many keys can each hold more than 1/HOT_KEYS of the rows, so a
#: table of such keys is small whatever the data.
HOT_KEYS = 500
#: Longest key text that may go into a table of hot keys.
HOT_KEY_CHARS = 2_000


def prepare(spark: SparkSession) -> None:
    """The shared folder, and a bound on the bytes a task hands to Python at once."""
    checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    Cuts the lineage and Spark's size estimate, and survives the loss of any
    executor.  Each call uses a new folder.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column | str) -> Column:
    return F.translate(c, UPPER, LOWER)


def in_bucket(id_col: str, n: int, bucket: int) -> Column:
    """Whether crc32 of the id written as text leaves ``bucket`` modulo ``n`` (null id: false)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(n)) == bucket, F.lit(False))


def packed(df: DataFrame, keep: list[str] | None = None, **columns: Column) -> DataFrame:
    """``df``'s rows (or the ``keep`` columns) as one struct ``row`` beside the named columns.

    Keeps the operators' own column names apart from any the input has.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in (keep or df.columns)]).alias("row"),
                     *[c.alias(n) for n, c in columns.items()])


def with_text(df: DataFrame, text_col: str, keep: list[str] | None = None) -> DataFrame:
    """:func:`packed`, with the text as a column of its own unless ``row`` holds it.

    :func:`text_of` finds it in either place, so no text is sent twice.
    """
    if text_col in (keep or df.columns):
        return packed(df, keep)
    return packed(df, keep, text=F.col(f"`{text_col}`"))


def text_of(batch: pa.RecordBatch, text_col: str) -> pa.Array:
    """The text column of a batch of :func:`with_text` rows, as bytes; null is empty."""
    column = batch.column("text") if "text" in batch.schema.names else pc.struct_field(batch.column("row"), text_col)
    return pc.fill_null(column.cast(pa.binary()), b"")


def row_schema(rows: DataFrame, ddl: str) -> T.StructType:
    """The ``row`` column of ``rows`` and the columns that ``ddl`` names."""
    return T.StructType([rows.schema["row"], *T.StructType.fromDDL(ddl).fields])


def unpacked(columns: list[str], replace: dict[str, Column] | None = None) -> list[Column]:
    """The original columns of :func:`packed` rows, some of them replaced."""
    replace = replace or {}
    return [(replace[c] if c in replace else F.col("row").getField(c)).alias(c) for c in columns]


def ranges(column: pa.Array, most_bytes: int = 16 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most_bytes`` of text each (one row at least)."""
    start, total = 0, 0
    sizes = pc.binary_length(column).to_pylist()
    for i, size in enumerate(sizes):
        if total and total + size > most_bytes:
            yield start, i
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)


def ship(spark: SparkSession, value):
    """A broadcast of an object of this package's own classes; :func:`shipped` opens it in a task."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shipped(shared):
    return pickle.loads(shared.value)


def join_unique(rows: DataFrame, keys: DataFrame, key: str, weight: str, total: int | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``keys``, which has each key once.

    ``weight`` (a column of ``keys``, dropped here) is how many rows have the
    key, ``total`` their sum (counted here if not given).  Keys with more than 1/HOT_KEYS of all rows can be HOT_KEYS at most:
    they are broadcast, so their rows are never gathered in one task; all
    other rows meet in a shuffled join.
    """
    if total is None:
        total = keys.agg(F.sum(weight).alias("n")).first()["n"] or 0
    hot = F.col(weight) > max(total / HOT_KEYS, 1000)
    if dict(keys.dtypes)[key] in ("string", "binary"):
        hot = hot & (F.length(key) <= HOT_KEY_CHARS)
    few = keys.where(hot).drop(weight)
    rest = keys.where(~hot).drop(weight)
    by_hot = rows.join(F.broadcast(few), key)
    by_rest = rows.join(F.broadcast(few.select(key)), key, "left_anti").join(rest, key)
    return by_hot.unionByName(by_rest)
