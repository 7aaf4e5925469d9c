"""Sources and sinks."""

from urbanlens.sources.feature_scan import read_features_split
from urbanlens.sources.lines import quarantined, read_mixed_headers, with_file_order
from urbanlens.sources.readers import (
    POINT_GEOMETRY,
    conform,
    feature_collection_schema,
    flatten_features,
    observe_rejects,
    read_delimited,
    read_features,
    read_parquet,
    reject_counts,
    union_sources,
)
from urbanlens.sources.writers import (
    as_features,
    csv_to_parquet,
    feature_collections,
    features_to_parquet,
    to_parquet,
    write_feature_collections,
    write_one_collection,
    write_one_file,
    write_result,
)

__all__ = [
    "POINT_GEOMETRY", "conform", "feature_collection_schema", "flatten_features",
    "read_delimited", "read_features", "read_parquet", "reject_counts", "union_sources",
    "as_features", "csv_to_parquet", "feature_collections", "features_to_parquet",
    "observe_rejects", "quarantined", "read_features_split", "read_mixed_headers", "to_parquet", "with_file_order",
    "write_feature_collections", "write_one_collection", "write_one_file", "write_result",
]
