"""Weighted ratio per area: housing x median income / population, per ZIP.

Blocks (many rows per area) are summed per area first, so the join only sees
one row per area on that side; the income table is a lookup of about one
row per area.  The join strategy is a parameter: left to the optimiser and
AQE by default, or forced with a hint as the caller asks.  A forced broadcast
is only planned after checking the size of the broadcast side; beyond the
bound the same answer comes from a sort-merge join.  A replicated nested
loop (a cartesian product filtered by the key) is never planned: the
``shuffle_replicate_nl`` request is accepted and answered by a shuffled hash
join on the key, which gives the same rows without forming every pair.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.functions.clean import parse_money, parse_money_whole, round_to
from urbanlens.session import written

log = logging.getLogger(__name__)

JOIN_STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl")

# Size bound behind a forced broadcast, in bytes of the built hash relation
# (estimated as a fixed cost per row plus the key text).
MAX_BROADCAST_BYTES = 256 * 1024 * 1024
_ROW_BYTES = 48


def aggregate_blocks(
    blocks: DataFrame,
    key: str = "zip",
    population: str = "population",
    housing: str = "housing",
    strict: bool = False,
) -> DataFrame:
    """Sum population and housing per area key.

    ``strict=False`` sums every block (nulls are skipped by ``sum``).
    ``strict=True`` first drops blocks with a null key, population or housing
    and blocks with population <= 0, so their housing is not counted.
    The sum runs partially in every task before the shuffle.
    """
    b = blocks.select(
        F.col(key).cast("string").alias("zip"),
        F.col(population).alias("population"),
        F.col(housing).alias("housing"),
    )
    if strict:
        b = b.where(
            F.col("zip").isNotNull() & F.col("population").isNotNull()
            & F.col("housing").isNotNull() & (F.col("population") > 0)
        )
    return b.groupBy("zip").agg(
        F.sum("population").alias("total_population"),
        F.sum("housing").alias("total_housing"),
    )


def income_lookup(income: DataFrame, key: str, text: str, strict: bool = False) -> DataFrame:
    """(zip, income) from raw income text.

    ``strict=False`` reads money as a double and keeps unreadable values as
    null; ``strict=True`` accepts whole numbers only and drops the rest.
    """
    value = parse_money_whole(text) if strict else parse_money(text)
    out = income.select(F.trim(F.col(key).cast("string")).alias("zip"), value.alias("income"))
    if strict:
        out = out.where(F.col("income").isNotNull())
    return out


def _hinted_join(agg: DataFrame, lookup: DataFrame, strategy: str) -> DataFrame:
    if strategy not in JOIN_STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}")
    if strategy == "broadcast":
        # The aggregate is written once to the shared folder, which makes its
        # size check cheap and the rest of the job reuse it.
        agg = written(agg, "areas")
        size = agg.agg(
            (F.count(F.lit(1)) * _ROW_BYTES + F.coalesce(F.sum(F.octet_length("zip")), F.lit(0)))
            .alias("bytes")).first()["bytes"]
        if size > MAX_BROADCAST_BYTES:
            log.warning("aggregate too large to broadcast (~%d bytes); using a sort-merge join", size)
            strategy = "merge"
    elif strategy == "shuffle_replicate_nl":
        # Same rows as the equi-join; no cartesian product at any size.
        strategy = "shuffle_hash"
    if strategy != "auto":
        agg = agg.hint(strategy)
    return agg.join(lookup, on="zip", how="inner")


def area_ratio(
    blocks: DataFrame,
    income: DataFrame,
    strict: bool = False,
    digits: int | None = None,
    rounding: str | None = None,
    join_strategy: str = "auto",
) -> DataFrame:
    """``total_housing * income / total_population`` per area -> (zip, average_income).

    ``blocks`` has columns zip, population, housing; ``income`` has zip and
    a parsed income (as made by ``income_lookup``).  Defaults follow the two readings
    of the question: non-strict rounds half-up to 0 digits and gives null for
    a zero population or an unreadable income; strict drops such rows and
    rounds half-even to 2 digits.  Duplicate income rows for one area each
    give a row (inner join).  The result is unordered.
    """
    digits = (2 if strict else 0) if digits is None else digits
    rounding = rounding or ("half_even" if strict else "half_up")
    agg = aggregate_blocks(blocks, strict=strict)
    joined = _hinted_join(agg, income, join_strategy)
    if strict:
        joined = joined.where(F.col("income").isNotNull() & (F.col("total_population") != 0))
    ratio = F.try_divide(
        F.col("total_housing").cast("double") * F.col("income").cast("double"),
        F.col("total_population").cast("double"),
    )
    return joined.select("zip", round_to(ratio, digits, rounding).alias("average_income"))
