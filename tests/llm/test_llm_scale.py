"""Plan shapes and bounds that hold whatever the size."""

import re

import pytest

from urbanlens.llm import common, line_dedup, mixing, partenum
from urbanlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_product(ready, name):
    plan = _plan(QUERIES[name](ready, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["op4_quality", "op6_decontamination", "op9_language"])
def test_scoring_passes_do_not_shuffle(ready, name):
    assert "Exchange" not in _plan(QUERIES[name](ready, SF))


def test_scans_read_only_what_is_needed(ready):
    plan = _plan(QUERIES["op6_decontamination"](ready, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_hot_keys_are_broadcast_and_the_rest_shuffled(ready, monkeypatch):
    rows = ready.createDataFrame([(i % 3, i) for i in range(3000)] + [(100 + i, i) for i in range(500)], "key long, v long")
    keys = rows.groupBy("key").count().withColumnRenamed("count", "w")
    got = common.join_unique(rows, common.cut(keys.selectExpr("key", "key * 2 AS twice", "w"), "keys"), "key", "w")
    assert got.count() == 3500 and got.where("twice <> key * 2").count() == 0
    assert "BroadcastHashJoin" in _plan(got)
    few = common.join_unique(rows, common.cut(keys.selectExpr("key", "w"), "keys"), "key", "w", total=10 ** 9)
    assert few.count() == 3500


def test_no_local_checkpoint_and_no_swallowed_imports():
    import inspect

    import corpus_pipeline

    for module in (common, line_dedup, mixing, partenum, corpus_pipeline):
        source = inspect.getsource(module)
        assert "localCheckpoint" not in source and not re.search(r"except (ImportError|ModuleNotFoundError)", source)


def test_batches_are_bounded(ready):
    assert int(ready.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == common.ARROW_ROWS
    assert int(ready.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) == common.ARROW_BYTES


def test_long_text_is_hashed_in_parts(monkeypatch):
    """Cutting a text at word ends changes no shingle."""
    import numpy as np

    text = " ".join(f"word{i % 977}" for i in range(5000)).encode()
    whole = partenum.Shingles(4).of(text)
    monkeypatch.setattr(partenum, "_PIECE", 333)
    assert np.array_equal(partenum.Shingles(4).of(text), whole)
    long = b"x" * 9000 + b" tail " + b"y" * 4095
    assert len(partenum.Shingles(1).of(long)) == 3
