"""Column expressions: parsing, rounding, buckets, geometry."""

from urbanlens.functions.buckets import DAY_PARTS, NIGHT, bucket_of, day_part, day_part_vectorized
from urbanlens.functions.clean import (
    EVENT_TIME_FORMAT,
    clock_of,
    format_event_time,
    parse_clock,
    parse_event_time,
    parse_money,
    parse_money_whole,
    round_to,
    strip_money,
)
from urbanlens.functions.geo import EARTH_RADIUS_KM, haversine_from_radians, haversine_km, unit_vector

__all__ = [
    "DAY_PARTS", "NIGHT", "bucket_of", "day_part", "day_part_vectorized",
    "EVENT_TIME_FORMAT", "clock_of", "format_event_time", "parse_clock", "parse_event_time",
    "parse_money", "parse_money_whole", "round_to", "strip_money",
    "EARTH_RADIUS_KM", "haversine_from_radians", "haversine_km", "unit_vector",
]
