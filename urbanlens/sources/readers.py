"""Scans: delimited text, Parquet, multi-line GeoJSON, plus typed conforming.

Readers never infer a schema by scanning data: delimited text is read as
strings under its header names (only the header line is touched up front) and
then conformed, with ``try_*`` casts, to the names and types a query needs.
Column pruning still reaches the file: a query that conforms five columns
reads five.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ",",
    header: bool = True,
    schema: T.StructType | str | None = None,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Quote-aware delimited text.

    Without ``schema`` every column is a string named after the header.
    Several paths are read each under its own header and united by name; files
    inside one path whose headers differ are an error, never mixed columns
    (``lines.read_mixed_headers`` takes them each under its own header).
    With a schema the columns are taken by position, as the text has them.
    ``mode`` is the reader's handling of malformed lines (``PERMISSIVE`` keeps
    them with nulls, ``DROPMALFORMED`` drops them).  Dropping looks at whole
    lines, so it reads every column whatever the query needs.
    """
    if header and schema is None and not isinstance(paths, str):
        frames = [read_delimited(spark, path, sep, mode=mode) for path in paths]
        return union_sources(frames, allow_missing=True)
    reader = spark.read.option("header", header).option("sep", sep).option("mode", mode)
    if mode.upper() == "DROPMALFORMED":
        reader = reader.option("columnPruning", False)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", False).option("enforceSchema", False)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*([paths] if isinstance(paths, str) else list(paths)))


def union_sources(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Concatenate sources by column name, keeping duplicates.

    By name rather than position: all-string text sources with a reordered
    header would otherwise mix columns without any error.
    """
    frames = list(frames)
    if not frames:
        raise ValueError("no sources to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def conform(df: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Select, rename and type columns: ``{target: (source, type)}``.

    Casting is ``try_cast`` after trimming text, so a bad value becomes null
    rather than failing the job.  Use :func:`reject_counts` to see how many.
    """
    out = []
    for target, (source, dtype) in columns.items():
        c = F.col(f"`{source}`")
        if dtype != "string":
            src_type = df.schema[source].dataType
            if isinstance(src_type, T.StringType):
                c = F.trim(c)
            c = c.try_cast(dtype)
        out.append(c.alias(target))
    return df.select(*out)


def reject_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows failing each named check.

    ``checks`` maps a name to a boolean column that is true for a rejected
    row.  This is an ordinary aggregate, so it runs as one scan with a
    partial count per task.
    """
    return df.agg(*_reject_metrics(checks))


def _reject_metrics(checks: Mapping[str, Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"),
            *[F.sum(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in checks.items()]]


def observe_rejects(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df``, and an observation of its ``reject_counts`` made while the next action runs."""
    counts = Observation()
    return df.observe(counts, *_reject_metrics(checks)), counts


# --- GeoJSON feature collections ---------------------------------------------------

def feature_collection_schema(
    properties: T.StructType, geometry: T.DataType | None = None
) -> T.StructType:
    """Schema of a FeatureCollection document.

    Leave ``geometry`` out when a query does not use it: the scan then never
    materialises the polygons.
    """
    feature = [
        T.StructField("type", T.StringType()),
        T.StructField("properties", properties),
    ]
    if geometry is not None:
        feature.append(T.StructField("geometry", geometry))
    return T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("features", T.ArrayType(T.StructType(feature))),
    ])


POINT_GEOMETRY = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("coordinates", T.ArrayType(T.DoubleType())),
])


def _documents(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, mode: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .json(list(paths) if not isinstance(paths, str) else paths)
    )


_CORRUPT = "_unreadable"


def read_features(
    spark: SparkSession,
    paths: str | Sequence[str],
    properties: T.StructType | None,
    geometry: T.DataType | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Multi-line GeoJSON FeatureCollection documents -> one row per feature.

    An unreadable document (say a truncated one) fails the query;
    ``mode="PERMISSIVE"`` leaves it out instead, and ``unreadable_documents``
    counts such documents.  ``properties=None`` infers the property set from
    all documents, at the price of one more scan of them.  Declare
    properties as strings and ``try_cast`` them where their types vary.

    Each file is one document and is read by one task, so the parallelism is
    the number of files.  ``feature_scan.read_features_split`` reads one large
    document by many tasks; ``read_feature_lines`` features one per line.
    """
    if properties is None:
        found = (spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("mode", mode)
                 .json(list(paths) if not isinstance(paths, str) else paths).schema)
        properties = found["features"].dataType.elementType["properties"].dataType
    docs = _documents(spark, paths, feature_collection_schema(properties, geometry), mode)
    return docs.selectExpr("explode(features) AS feature").select("feature.*")


def unreadable_documents(spark: SparkSession, paths: str | Sequence[str], properties: T.StructType) -> DataFrame:
    """Per file: 1 if it is no readable FeatureCollection document, else 0."""
    schema = T.StructType(feature_collection_schema(properties).fields + [T.StructField(_CORRUPT, T.StringType())])
    docs = _documents(spark, paths, schema, "PERMISSIVE")
    bad = F.col(_CORRUPT).isNotNull() | F.col("features").isNull()
    return docs.groupBy(F.input_file_name().alias("source")).agg(F.max(bad.cast("int")).alias("unreadable"))


def read_feature_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    properties: T.StructType,
    geometry: T.DataType | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """GeoJSON features, one per line -> one row per feature.

    The splittable form of ``read_features``: one file is read by many tasks.
    """
    feature = feature_collection_schema(properties, geometry)["features"].dataType.elementType
    reader = spark.read.schema(feature).option("mode", mode).option("recursiveFileLookup", True)
    return reader.json(list(paths) if not isinstance(paths, str) else paths)


def flatten_features(features: DataFrame) -> DataFrame:
    """``properties.*`` become top-level columns; ``geometry`` is kept if present.

    The property list comes from the schema, so any property set works.
    """
    cols = [F.col(f"properties.`{name}`").alias(name)
            for name in features.schema["properties"].dataType.fieldNames()]
    if "geometry" in features.columns:
        cols.append(F.col("geometry"))
    return features.select(*cols)
