"""Exact rounding against Python's, exact means against fractions."""

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from urbanlens.functions.clean import round_to
from urbanlens.functions.exact import exact_mean, round_binary
from urbanlens.plans.inspect import physical_plan


@pytest.fixture(scope="module")
def doubles(spark):
    rng = random.Random(1)
    xs = [2.675, 1.005, 0.125, 0.375, 2.5, -2.675, 0.0, -0.0, -0.001, 1e300, 45035996273704.0078125, 4.5e13 + .005,
          90071992547409.93, 1e-320, 0.5, 1.5, 9007199254740993.0, math.inf, -math.inf]
    xs += [rng.choice([rng.uniform(-1e3, 1e3), rng.uniform(-1, 1) * 10 ** rng.randint(-8, 20)]) for _ in range(60_000)]
    for _ in range(15_000):     # ties, and the doubles next to them
        x = (rng.randint(0, 10 ** rng.randint(2, 14)) + 0.5) / 100
        xs += [x, math.nextafter(x, 0), -math.nextafter(x, math.inf)]
    xs += [x for x in (struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(5_000)) if x == x]
    return spark.createDataFrame([(x,) for x in xs] + [(None,), (math.nan,)], "x double").cache()


@pytest.mark.parametrize("digits", [0, 2, 5, 22])
def test_rounding_by_the_binary_value(doubles, digits):
    for x, r in doubles.select("x", round_to("x", digits, "binary").alias("r")).collect():
        if x is None or x != x:
            assert r is None or r != r
        else:
            want = round(x, digits) if math.isfinite(x) else x
            assert r == want and math.copysign(1, r) == math.copysign(1, want), x


def test_rounding_is_expressions_only(doubles):
    assert "EvalPython" not in physical_plan(doubles.select(round_binary("x", 2)))
    with pytest.raises(ValueError):
        round_binary("x", 23)
    ties = doubles.sparkSession.createDataFrame([(2.675,), (0.125,)], "x double").select(
        round_to("x", 2, "binary"), round_to("x", 2), round_to("x", 2, "half_even")).collect()
    assert [tuple(t) for t in ties] == [(2.67, 2.68, 2.68), (0.12, 0.13, 0.12)]


def test_means_are_the_same_in_any_partitions(spark):
    rng = random.Random(2)
    values = [rng.uniform(-20_000, 20_000) * rng.choice([1, 1e-3, 1e-9]) for _ in range(20_000)]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "g int, v double")
    seen = {tuple(sorted((r.g, r.m.hex()) for r in df.orderBy(F.rand(seed)).repartition(n).groupBy("g").agg(
        exact_mean("v").alias("m")).collect())) for seed, n in enumerate((1, 7, 211))}
    assert len(seen) == 1
    for g, m in seen.pop():
        mine = values[g::3]
        assert abs(Fraction(float.fromhex(m)) - sum(map(Fraction, mine)) / len(mine)) <= Fraction(1, 2 ** 41) + Fraction(1, 2 ** 38) / 4


def test_means_of_odd_groups(spark):
    df = spark.createDataFrame([("none", None), ("some", 1.5), ("some", None), ("some", -0.25), ("large", 1e9), ("large", 3.0),
                                ("nan", math.nan), ("nan", 1.0)], "g string, v double")
    got = {r.g: r.m for r in df.groupBy("g").agg(exact_mean("v").alias("m")).collect()}
    assert got["none"] is None and got["some"] == 0.625 and got["large"] == 500_000_001.5 and got["nan"] != got["nan"]
