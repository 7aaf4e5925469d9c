"""Arithmetic on doubles whose result does not depend on luck: exact rounding, exact means.

All built-in column expressions, inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Splits a 53-bit significand into two halves (2^27 + 1).
_SPLITTER = 134217729.0
#: An exact mean counts in units of 2^-UNIT_BITS and takes values below 2^RANGE_BITS.
UNIT_BITS = 40
RANGE_BITS = 22
_LIMB = 20


def _halves(x: Column) -> tuple[Column, Column]:
    scaled = x * F.lit(_SPLITTER)
    high = scaled - (scaled - x)
    return high, x - high


def round_binary(c: Column | str, digits: int) -> Column:
    """Round the exact binary value of a double to ``digits`` places, exact ties to the even digit.

    The double nearest to the rounded decimal, as Python's ``round`` gives it:
    2.675, which is a little less than its shortest decimal form says, becomes
    2.67.  The scaled value is a product and its rounding error (found without
    error by splitting both factors), so a tie is told from a near tie.  Values
    too large to have ``digits`` places are returned as they are.
    """
    if not 0 <= digits <= 22:
        raise ValueError("0 to 22 digits")      # 10^22 is the last power of ten that a double holds
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    scale = float(10 ** digits)
    size = F.abs(x)
    product = size * F.lit(scale)
    high, low = _halves(size)
    scale_high = _SPLITTER * scale - (_SPLITTER * scale - scale)
    scale_low = scale - scale_high
    error = ((high * F.lit(scale_high) - product) + high * F.lit(scale_low) + low * F.lit(scale_high)) + low * F.lit(scale_low)
    whole = F.floor(product).cast("double")
    past = (product - whole) - F.lit(0.5)
    # Doubles next to a tie are further from it than the error is large.
    odd = F.pmod(whole, F.lit(2.0)) == 1.0
    up = (past > 0) | ((past == 0) & ((error > 0) | ((error == 0) & odd)))
    rounded = F.when(up, whole + 1.0).otherwise(whole) / F.lit(scale)
    # From 2^52 on the product is the nearest whole number itself, from 2^53 on the value has no such places.
    size = F.when(product < F.lit(float(1 << 52)), rounded).when(
        product < F.lit(float(1 << 53)), product / F.lit(scale)).otherwise(size)
    return F.when((x == 0) | F.isnan(x), x).when(x < 0, -size).otherwise(size)


def exact_mean(c: Column | str) -> Column:
    """The mean of doubles, the same bits in whatever order and partitions they are added.

    An aggregate.  Values are counted in units of 2^-40, so each is off by
    2^-41 at most, and so is the mean; three whole-number sums of 20 bits each
    hold 2^43 rows.  A group with a value of 2^22 or more, or one that is no
    number, has the plain average.
    """
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    fits = F.abs(x) < F.lit(float(1 << RANGE_BITS))
    units = F.when(fits, F.rint(x * F.lit(float(1 << UNIT_BITS)))).cast("long")
    mask = F.lit((1 << _LIMB) - 1)
    limbs = [F.shiftright(units, 2 * _LIMB), F.shiftright(units, _LIMB).bitwiseAND(mask), units.bitwiseAND(mask)]
    total = F.lit(0).cast("decimal(38,0)")
    for i, limb in enumerate(limbs):
        total = total + F.sum(limb).cast("decimal(20,0)") * F.lit(1 << (_LIMB * (2 - i))).cast("decimal(13,0)")
    n = F.count(x)
    whole = F.call_function("div", total, n.cast("decimal(20,0)")).cast("long")
    rest = (total - whole.cast("decimal(20,0)") * n.cast("decimal(20,0)")).cast("double")
    mean = (whole.cast("double") + rest / n) / F.lit(float(1 << UNIT_BITS))
    return F.when(F.bool_and(fits), mean).otherwise(F.avg(x))
