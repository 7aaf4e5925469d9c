"""Share of rows per bucket (e.g. per part of day), largest first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.functions.buckets import day_part, day_part_vectorized
from urbanlens.functions.clean import round_to


def share_by_bucket(
    df: DataFrame,
    bucket: Column | str,
    label: str = "period",
    value: str = "percentage",
    digits: int = 2,
    rounding: str = "half_up",
) -> DataFrame:
    """Percentage of rows per bucket, rounded, sorted by share then label.

    Rows are counted per bucket with a partial count in every task, so only
    (bucket, count) pairs cross the shuffle.  The denominator is a one-row
    scalar subquery over the same counts (the shuffle is reused), so the
    groups are never gathered in one task however many there are.
    """
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    counts = df.groupBy(b.alias(label)).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return (
        counts.select(label, round_to(F.col("n") * 100 / total, digits, rounding).alias(value))
        .orderBy(F.col(value).desc(), F.col(label).asc())
    )


def time_of_day_share(
    df: DataFrame,
    clock: Column | str,
    method: str = "expr",
    digits: int = 2,
    rounding: str = "half_up",
) -> DataFrame:
    """Share of rows per part of day of an HHMM ``clock`` column.

    ``method="expr"`` buckets with a CASE expression (default);
    ``method="udf"`` buckets with an Arrow-batched pandas UDF, which gives the
    same answer and exists to measure the cost of the Python hop.
    A null clock falls into the last bucket ("night") in both.
    """
    c = F.col(clock) if isinstance(clock, str) else clock
    if method == "expr":
        bucket = day_part(c)
    elif method == "udf":
        bucket = day_part_vectorized(c)
    else:
        raise ValueError(f"unknown method {method!r}")
    return share_by_bucket(df, bucket, digits=digits, rounding=rounding)
