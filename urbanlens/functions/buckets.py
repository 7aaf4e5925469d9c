"""Part-of-day buckets for an HHMM clock.

The expression form is the default.  The vectorised Python form exists only to
compare the cost of leaving the JVM for the same answer; both map a null or
impossible clock to the fallback bucket.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:  # ship this module's code with the UDF, so workers need no install of it
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError):  # pragma: no cover - older cloudpickle
    pass

# Closed HHMM ranges of the parts of the day, in order.
# Every clock outside them (including 1160-1199, 2400+ and null) is "night".
DAY_PARTS = (
    ("morning", 500, 1159),
    ("afternoon", 1200, 1659),
    ("evening", 1700, 2059),
)
NIGHT = "night"


def bucket_of(
    value: Column | str,
    bands: tuple[tuple[str, int, int], ...] = DAY_PARTS,
    otherwise: str = NIGHT,
) -> Column:
    """Label of the first closed range ``[lo, hi]`` holding ``value``."""
    v = F.col(value) if isinstance(value, str) else value
    expr = None
    for label, lo, hi in bands:
        cond = v.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(otherwise)


def day_part(clock: Column | str) -> Column:
    """Part of day of an HHMM clock (expression form, codegen'd)."""
    return bucket_of(clock)


def _day_part_series(clock: pd.Series) -> pd.Series:
    v = clock.to_numpy(dtype="float64", na_value=np.nan)
    conditions = [(v >= lo) & (v <= hi) for _, lo, hi in DAY_PARTS]
    labels = [label for label, _, _ in DAY_PARTS]
    return pd.Series(np.select(conditions, labels, default=NIGHT), index=clock.index)


day_part_vectorized = F.pandas_udf(_day_part_series, T.StringType())
day_part_vectorized.__doc__ = "Part of day via an Arrow-batched pandas UDF (cost comparison only)."
