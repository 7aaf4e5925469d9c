"""One multi-line document read by many tasks."""

import json
import os
import random

import pytest
from pyspark.sql import types as T

from urbanlens.sources.feature_scan import chain, read_features_split, split_text
from urbanlens.sources.readers import POINT_GEOMETRY, read_features
from urbanlens.sources.writers import write_one_collection

PROPERTIES = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType())])
TRICKY = ["}", '{"features":[{', "\\", '\\"}', 'a"b}{]', "é}", "[[[", "\\\\", "", "x" * 400 + "}"]


def _features(rng, n):
    return [{"type": "Feature", "properties": {"k": i, "s": rng.choice(TRICKY) * rng.randint(1, 3)},
             "geometry": {"type": "Polygon", "coordinates": [[[1, 2]] * rng.randint(0, 30)]}} for i in range(n)]


def _documents(root):
    rng = random.Random(4)
    for i, n in enumerate([0, 1, 30, 120, 7, 40]):
        doc = {"type": "FeatureCollection"}
        if i % 2:       # members before and behind that look like features
            doc = {"name": "x}y", "crs": {"list": [{"properties": {"k": -1}}]}, "other": [{"properties": {"k": -3}}], **doc}
        doc["features"] = _features(rng, n)
        if i > 2:
            doc["tail"] = [{"properties": {"k": -2, "s": "no"}}]
        with open(os.path.join(root, f"d{i}.geojson"), "w") as fh:
            json.dump(doc, fh, indent=2 if i % 2 else None, ensure_ascii=i < 3)
            fh.write("\n \n" if i % 3 == 0 else "")


def _rows(df):
    return sorted((str(r["properties"]) for r in df.collect()))


@pytest.mark.parametrize("split_bytes", [700, 5_000, None])
def test_split_documents_give_the_same_features(spark, tmp_dir, split_bytes):
    _documents(tmp_dir)
    if split_bytes == 700:      # one long document is many splits
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
        try:
            assert split_text(spark, os.path.join(tmp_dir, "d3.geojson")).rdd.getNumPartitions() > 20
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = _rows(read_features(spark, tmp_dir, PROPERTIES))
    assert len(want) == 198
    assert _rows(read_features_split(spark, tmp_dir, PROPERTIES, split_bytes=split_bytes)) == want


def test_truncated_documents_fail_or_are_left_out(spark, tmp_dir):
    _documents(tmp_dir)
    want = _rows(read_features(spark, tmp_dir, PROPERTIES))
    text = json.dumps({"type": "FeatureCollection", "features": _features(random.Random(1), 30)})
    for name, cut in (("inside", text[:-700]), ("string", text[:text.rindex("Polygon") + 3]), ("end", text[:-1]),
                      ("more", text + "}")):
        with open(os.path.join(tmp_dir, f"{name}.geojson"), "w") as fh:
            fh.write(cut)
        with pytest.raises(ValueError, match=name):
            read_features_split(spark, os.path.join(tmp_dir, f"{name}.geojson"), PROPERTIES, split_bytes=2_000)
    assert _rows(read_features_split(spark, tmp_dir, PROPERTIES, mode="PERMISSIVE", split_bytes=2_000)) == want


def test_one_collection_written_by_all_tasks(spark, tmp_dir):
    df = spark.range(500).selectExpr(
        "id AS key", "struct('Feature' AS type, struct(id AS k, repeat('}', int(id % 5)) AS s) AS properties, "
                     "struct('Point' AS type, array(double(id), 1.5D) AS coordinates) AS geometry) AS feature").repartition(6)
    path = write_one_collection(df, "key", os.path.join(tmp_dir, "one.geojson"))
    with open(path) as fh:
        doc = json.load(fh)
    assert [f["properties"]["k"] for f in doc["features"]] == list(range(500))
    back = read_features_split(spark, path, PROPERTIES, geometry=POINT_GEOMETRY, split_bytes=3_000)
    assert sorted((r.properties.k, r.geometry.coordinates[0]) for r in back.collect()) == [(i, float(i)) for i in range(500)]
    empty = write_one_collection(df.where("false"), "key", os.path.join(tmp_dir, "none.geojson"))
    assert read_features_split(spark, empty, PROPERTIES).collect() == []


def test_chain_of_splits():
    def split(block, outside, inside, size=100, count=25):
        row = {"file": "f", "block": block, "size": size, "bytes": count}
        for i, s in enumerate((outside, inside)):
            row |= dict(zip((f"inside{i}", f"depth{i}", f"least{i}", f"low{i}", f"next{i}"), s))
        return row

    rows = [split(0, (1, 3, 0, -1, 1), (0, 0, 0, -1, -1)), split(25, (0, 9, 0, -1, -1), (1, 1, 0, -1, -1)),
            split(50, (0, 9, 9, -1, -1), (0, 0, -2, -1, -1)), split(75, (0, -4, -4, -1, -1), (0, 0, 0, -1, -1))]
    states, bad = chain(rows)
    assert bad == [] and states == {("f", 0): (0, 0, False, None), ("f", 25): (1, 3, True, 0), ("f", 50): (1, 4, True, 0),
                                    ("f", 75): (0, 4, True, 50)}
    assert chain(rows[:3])[1] == ["f"]
