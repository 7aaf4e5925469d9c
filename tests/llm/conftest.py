import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_rows import CLASHES, ODD_ROWS  # noqa: E402

from urbanlens.llm.common import prepare  # noqa: E402


@pytest.fixture(scope="session")
def ready(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def odd(ready):
    """The odd rows as a documents table with extra, clashing columns."""
    from pyspark.sql import functions as F

    df = ready.createDataFrame(ODD_ROWS, "doc_id long, text string")
    df = df.withColumns({"lang": F.lit("en"), "source": F.when(F.col("doc_id") % 3 == 0, "a"),
                         "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.lit(c) for c in CLASHES})
