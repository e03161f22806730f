import random

import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from loomframe.operators import isotonic


def brute(points, increasing=True):
    """Min-max values of distinct points (x, total, weight)."""
    sign = 1 if increasing else -1
    points = sorted(points)
    mean = lambda a, b: sum(sign * p[1] for p in points[a : b + 1]) / sum(p[2] for p in points[a : b + 1])
    n = len(points)
    return {points[k][0]: sign * max(min(mean(a, b) for b in range(k, n)) for a in range(k + 1)) for k in range(n)}


@pytest.mark.parametrize("increasing", [True, False])
def test_equals_min_max_and_the_built_in(spark, increasing):
    draw = random.Random(3)
    rows = [(float(draw.randrange(40)), draw.gauss(k % 40 / 8, 2), draw.choice([0.5, 1.0, 3.0])) for k in range(200)]
    frame = spark.createDataFrame(rows, "x double, y double, w double")
    found = isotonic.isotonic_blocks(frame, "x", "y", "w", increasing)
    sums = {}
    for x, y, w in rows:
        t = sums.setdefault(x, [0.0, 0.0])
        t[0], t[1] = t[0] + y * w, t[1] + w
    expected = brute([(x, t, w) for x, (t, w) in sums.items()], increasing)
    blocks = found.orderBy("lo").collect()
    assert sum(1 for x in expected if any(b["lo"] <= x <= b["hi"] for b in blocks)) == len(expected)
    for b in blocks:
        assert all(abs(v - b["prediction"]) < 1e-9 for x, v in expected.items() if b["lo"] <= x <= b["hi"])
    values = [b["prediction"] for b in blocks]
    assert values == sorted(values, reverse=not increasing) and len(set(values)) == len(values)
    model = IsotonicRegression(featuresCol="x", labelCol="y", weightCol="w", isotonic=increasing).fit(frame)
    ends = isotonic.boundary_rows(found).orderBy("boundary").collect()
    assert [r["boundary"] for r in ends] == list(model.boundaries)
    assert all(abs(r["prediction"] - p) < 1e-9 for r, p in zip(ends, model.predictions))


def test_odd_rows(spark):
    rows = [(1.0, 5.0, 1.0), (None, 1.0, 1.0), (2.0, None, 1.0), (3.0, 1.0, 0.0), (4.0, float("nan"), 1.0), (float("inf"), 1.0, 1.0)]
    frame = spark.createDataFrame(rows, "x double, y double, w double")
    assert [tuple(r) for r in isotonic.isotonic_blocks(frame, "x", "y", "w").collect()] == [(1.0, 1.0, 5.0, 1.0)]
    assert isotonic.isotonic_blocks(frame.limit(0), "x", "y").count() == 0
    falling = spark.range(100).select(F.col("id").alias("x"), (-F.col("id")).alias("y"))
    assert [tuple(r) for r in isotonic.isotonic_blocks(falling, "x", "y").collect()] == [(0.0, 99.0, -49.5, 100.0)]
