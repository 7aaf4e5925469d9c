"""The four question families as DataFrame operators."""

from urbanlens.operators.areas import (
    JOIN_STRATEGIES,
    aggregate_blocks,
    area_ratio,
    income_lookup,
)
from urbanlens.operators.nearest import nearest_site, nearest_site_summary, point_rejects, prepare_sites
from urbanlens.operators.ranking import monthly_counts, monthly_top_k, monthly_top_k_sql, top_k_per_group
from urbanlens.operators.shares import share_by_bucket, time_of_day_share

__all__ = [
    "JOIN_STRATEGIES", "aggregate_blocks", "area_ratio", "income_lookup",
    "nearest_site", "nearest_site_summary", "point_rejects", "prepare_sites",
    "monthly_counts", "monthly_top_k", "monthly_top_k_sql", "top_k_per_group",
    "share_by_bucket", "time_of_day_share",
]
