"""Plan inspection: the text of ``explain`` for plan-shape checks."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints, as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical_plan(df: DataFrame) -> str:
    """The physical plan with operator arguments (pushed filters, read schema)."""
    return explain_text(df, "formatted")
