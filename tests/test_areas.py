import pytest
from fixtures import Q3_LOOSE, Q3_STRICT
from files import write_blocks, write_income

from urbanlens.operators.areas import JOIN_STRATEGIES, area_ratio, income_lookup
from urbanlens.plans.inspect import physical_plan
from urbanlens.sources.city import read_census_blocks, read_income


def _inputs(spark, tmp_dir, strict):
    blocks = read_census_blocks(spark, write_blocks(tmp_dir))
    income = income_lookup(read_income(spark, write_income(tmp_dir)), "zip", "income_text", strict=strict)
    return blocks, income


def _rows(df):
    return sorted(((r.zip, r.average_income) for r in df.collect()), key=lambda r: (r[0], r[1] or -1))


def test_geojson_blocks_are_flattened_without_geometry(spark, tmp_dir):
    blocks = read_census_blocks(spark, write_blocks(tmp_dir))
    assert blocks.columns == ["zip", "population", "housing"]
    assert blocks.count() == 9
    assert "geometry" not in physical_plan(blocks).split("ReadSchema")[1].split("\n")[0]


@pytest.mark.parametrize("strategy", [s for s in JOIN_STRATEGIES])
def test_loose_reading_every_join_strategy(spark, tmp_dir, strategy):
    blocks, income = _inputs(spark, tmp_dir, strict=False)
    assert _rows(area_ratio(blocks, income, join_strategy=strategy)) == Q3_LOOSE


def test_strict_reading(spark, tmp_dir):
    blocks, income = _inputs(spark, tmp_dir, strict=True)
    assert _rows(area_ratio(blocks, income, strict=True)) == Q3_STRICT


@pytest.mark.parametrize("strategy,operator", [
    ("broadcast", "BroadcastHashJoin"),
    ("merge", "SortMergeJoin"),
    ("shuffle_hash", "ShuffledHashJoin"),
    ("shuffle_replicate_nl", "ShuffledHashJoin"),
])
def test_hint_reaches_the_physical_plan(spark, tmp_dir, strategy, operator):
    blocks, income = _inputs(spark, tmp_dir, strict=False)
    assert operator in physical_plan(area_ratio(blocks, income, join_strategy=strategy))


def test_replicated_nested_loop_request_never_plans_a_cartesian_product(spark, tmp_dir):
    blocks, income = _inputs(spark, tmp_dir, strict=False)
    df = area_ratio(blocks, income, join_strategy="shuffle_replicate_nl")
    plan = physical_plan(df)
    assert "CartesianProduct" not in plan and "ShuffledHashJoin" in plan
    assert _rows(df) == Q3_LOOSE


def test_broadcast_falls_back_over_the_size_bound(spark, tmp_dir, monkeypatch):
    import urbanlens.operators.areas as areas
    monkeypatch.setattr(areas, "MAX_BROADCAST_BYTES", 100)
    blocks, income = _inputs(spark, tmp_dir, strict=False)
    df = area_ratio(blocks, income, join_strategy="broadcast")
    assert "SortMergeJoin" in physical_plan(df)
    assert _rows(df) == Q3_LOOSE


def test_geojson_converted_once_to_parquet(spark, tmp_dir):
    from urbanlens.sources.city import BLOCK_PROPERTIES
    from urbanlens.sources.writers import features_to_parquet

    out = features_to_parquet(spark, write_blocks(tmp_dir), BLOCK_PROPERTIES, f"{tmp_dir}/blocks.parquet")
    flat = spark.read.parquet(out).select(
        "ZCTA20", "POP20", "HOUSING20").toDF("zip", "population", "housing")
    income = income_lookup(read_income(spark, write_income(tmp_dir)), "zip", "income_text")
    assert _rows(area_ratio(flat, income)) == Q3_LOOSE
