"""Tolerant parsing of clock, date and money text.

Every parser returns null for text it cannot read instead of failing the job
(Spark 4 runs with ANSI mode on, where a plain ``cast`` raises on dirty rows).
All of them are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from urbanlens.functions.exact import round_binary

# Fixed values taken over from the input data they describe.
# Text layout of the event date column, e.g. "2019 Jan 05 12:00:00 AM".
EVENT_TIME_FORMAT = "yyyy MMM dd hh:mm:ss a"
# Characters removed from money text before parsing, e.g. "$52,806".
MONEY_NOISE = r"[$,]"

_WHOLE_NUMBER = r"^[+-]?[0-9]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_clock(c: Column | str) -> Column:
    """HHMM text (e.g. ``"0459"``) -> int; null when not a number."""
    return F.trim(_col(c)).try_cast("int")


def clock_of(ts: Column | str) -> Column:
    """HHMM clock of a timestamp as an int, e.g. 13:05 -> 1305."""
    ts = _col(ts)
    return F.hour(ts) * 100 + F.minute(ts)


def parse_event_time(c: Column | str, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """Text -> timestamp with the given pattern; null when it does not match."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def format_event_time(ts: Column | str, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """Timestamp -> text in the event date layout (the inverse of the parser)."""
    return F.date_format(_col(ts), fmt)


def strip_money(c: Column | str) -> Column:
    """Remove currency sign and thousands separators, trim blanks."""
    return F.trim(F.regexp_replace(_col(c), MONEY_NOISE, ""))


def parse_money(c: Column | str) -> Column:
    """Money text -> double (``"$52,806.50"`` -> 52806.5); null when unreadable."""
    return strip_money(c).try_cast("double")


def parse_money_whole(c: Column | str) -> Column:
    """Money text -> bigint, whole numbers only (``"$52,806.50"`` -> null).

    The strict reading of income: a value with cents, a word or an empty
    field is not an income and yields null.
    """
    s = strip_money(c)
    return F.when(s.rlike(_WHOLE_NUMBER), s.try_cast("bigint"))


def round_to(c: Column | str, digits: int, rounding: str = "half_up") -> Column:
    """Round a double to ``digits`` places.

    ``half_up`` rounds ties away from zero, ``half_even`` to the even digit;
    both act on the shortest decimal form of the double, so 2.675 is a tie.
    ``binary`` acts on the double's exact value, ties to the even digit, so
    2.675 is no tie and becomes 2.67 (``exact.round_binary``).
    """
    if rounding == "half_up":
        return F.round(_col(c), digits)
    if rounding == "half_even":
        return F.bround(_col(c), digits)
    if rounding == "binary":
        return round_binary(_col(c), digits)
    raise ValueError(f"unknown rounding {rounding!r}")
