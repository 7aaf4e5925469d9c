"""Sinks: Parquet, result CSV, GeoJSON feature collections, CSV -> Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanlens.sources.feature_scan import read_features_split
from urbanlens.sources.readers import flatten_features, read_delimited, read_features


def to_parquet(df: DataFrame, path: str, mode: str = "overwrite",
               partition_by: Sequence[str] = ()) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def csv_to_parquet(
    spark: SparkSession,
    sources: Mapping[str, str | Sequence[str]],
    out_dir: str,
    sep: str = ",",
) -> dict[str, str]:
    """Convert each named delimited source to ``<out_dir>/<name>.parquet``.

    Columns stay as the text has them (all strings under the header names);
    typing happens at query time with ``conform``, as for the text itself.
    Each conversion is one distributed scan and write.
    """
    written = {}
    for name, paths in sources.items():
        target = f"{out_dir.rstrip('/')}/{name}.parquet"
        to_parquet(read_delimited(spark, paths, sep=sep), target)
        written[name] = target
    return written


def features_to_parquet(
    spark: SparkSession,
    paths: str | Sequence[str],
    properties: T.StructType,
    out_path: str,
    geometry: T.DataType | None = None,
    split: bool = False,
) -> str:
    """Convert GeoJSON FeatureCollection files once to a flat Parquet table.

    The multi-line JSON scan is one task per file (``split``: many tasks a file)
    and re-parses text on every read; the Parquet copy is split, pruned and
    filtered like any table.
    """
    read = read_features_split if split else read_features
    return to_parquet(flatten_features(read(spark, paths, properties, geometry)), out_path)


def write_result(
    df: DataFrame,
    path: str,
    single_file: bool = True,
    header: bool = False,
    mode: str = "overwrite",
) -> str:
    """Write a query result as delimited text.

    ``single_file`` sends the finished rows to one task that only writes, which
    is meant for results of a few rows; the query itself keeps its tasks.
    Results that grow with the data should be written with
    ``single_file=False``, so every task writes its own part, or with
    ``write_one_file``.
    """
    out = df.repartition(1) if single_file else df
    out.write.mode(mode).option("header", header).csv(path)
    return path


def _join_parts(spark: SparkSession, parts: str, target: str) -> None:
    """The part files under ``parts``, in order of their names, become the file ``target``.

    HDFS does it in its name node without moving a byte; a local file system
    copies on its own machine.  Sizes are checked.
    """
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    where, goal = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(target)
    fs = where.getFileSystem(conf)
    found = sorted(((s.getPath().getName(), s.getLen(), s.getPath()) for s in fs.listStatus(where)
                    if s.getPath().getName().startswith("part-")), key=lambda f: f[0])
    sources = [path for _, size, path in found if size]
    local = fs.getUri().getScheme() == "file"
    if fs.exists(goal):
        fs.delete(goal, False)
    if not sources:
        fs.create(goal).close()
        return
    try:
        if local:
            fs, first = fs.getRawFileSystem(), []
        else:
            fs.rename(sources[0], goal)
            first = [sources.pop(0)]
        if sources:
            array = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(sources))
            for i, path in enumerate(sources):
                array[i] = path
            fs.concat(goal, array)
    except Py4JJavaError as error:
        if first:
            fs.rename(goal, first[0])
        raise RuntimeError(f"the store of {target} can't join files ({fs.getUri()}); the parts are under {parts}: "
                           "write several files (write_result with single_file=False)") from error
    size = sum(size for _, size, _ in found)
    if fs.getFileStatus(goal).getLen() != size:
        raise RuntimeError(f"{target} has {fs.getFileStatus(goal).getLen()} bytes, its parts had {size}")


def _one_file(rows: DataFrame, path: str, order_by: Sequence[str], write) -> str:
    parts = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex[:12]}"
    if order_by:
        rows = rows.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    write(rows, parts)
    _join_parts(rows.sparkSession, parts, path)
    return path


def write_one_file(df: DataFrame, path: str, order_by: Sequence[str] = (), sep: str = ",") -> str:
    """Write ``df`` as one headerless delimited file ``path``, in the global order of ``order_by``.

    All tasks write: rows are range-partitioned by the order, each task writes
    its part, and the file system joins the parts.  No row goes through a
    single task.  A store that can't join files (object stores) is a clear
    error.  ``path`` is replaced.  The folder of the parts, ``path`` with a
    suffix, is left: empty on HDFS, with the parts on a local disk.
    """
    def write(rows: DataFrame, parts: str) -> None:
        rows.write.option("sep", sep).csv(parts)

    return _one_file(df, path, order_by, write)


def write_one_collection(features: DataFrame, key: str, path: str) -> str:
    """Write (``key``, ``feature``) rows as one FeatureCollection document ``path``, by all tasks.

    ``key`` is unique and orders the features.  See ``write_one_file``.
    """
    first = features.agg(F.min(key).alias("first")).first()["first"]
    text = F.concat(F.when(F.col(key) == F.lit(first), F.lit("")).otherwise(F.lit(",")), F.to_json("feature"))
    lines = features.select(F.lit(1).alias("part"), F.col(key).alias("at"), text.alias("value"))
    ends = features.sparkSession.createDataFrame(
        [(0, '{"type": "FeatureCollection", "features": ['), (2, "]}")], "part int, value string")
    rows = lines.unionByName(ends.withColumn("at", F.lit(None).cast(lines.schema["at"].dataType)))

    def write(rows: DataFrame, parts: str) -> None:
        rows.select("value").write.text(parts)

    return _one_file(rows, path, ["part", "at"], write)


def as_features(
    df: DataFrame,
    properties: Sequence[str],
    lon: str | None = None,
    lat: str | None = None,
) -> DataFrame:
    """Flat rows -> one ``Feature`` struct column per row (point geometry optional)."""
    fields = [F.lit("Feature").alias("type"),
              F.struct(*[F.col(c) for c in properties]).alias("properties")]
    if lon is not None and lat is not None:
        fields.append(F.struct(
            F.lit("Point").alias("type"),
            F.array(F.col(lon).cast("double"), F.col(lat).cast("double")).alias("coordinates"),
        ).alias("geometry"))
    return df.select(F.struct(*fields).alias("feature"))


def feature_collections(features: DataFrame, features_per_doc: int = 10_000) -> DataFrame:
    """Group ``feature`` rows into FeatureCollection rows (type, features).

    Rows are grouped into collections of at most ``features_per_doc``
    features taken from the same input partition (consecutive
    ``monotonically_increasing_id`` values), so no collection grows with the
    data.
    """
    doc = F.floor(F.monotonically_increasing_id() / F.lit(features_per_doc))
    return (
        features.withColumn("doc", doc)
        .groupBy("doc")
        .agg(F.collect_list("feature").alias("features"))
        .select(F.lit("FeatureCollection").alias("type"), "features")
    )


def write_feature_collections(
    features: DataFrame,
    path: str,
    features_per_doc: int = 10_000,
    pretty: bool = True,
) -> str:
    """Write ``feature`` rows as GeoJSON FeatureCollection documents, one per file.

    Many bounded documents rather than one: each file is scanned by its own
    task when read back with ``read_features``.
    """
    docs = feature_collections(features, features_per_doc).select(
        F.to_json(F.struct("type", "features"), {"pretty": "true"} if pretty else {}).alias("value")
    )
    docs.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return path


def write_feature_lines(features: DataFrame, path: str) -> str:
    """Write ``feature`` rows one per line: splittable, no shuffle, as many files as tasks."""
    features.select(F.to_json("feature").alias("value")).write.mode("overwrite").text(path)
    return path
