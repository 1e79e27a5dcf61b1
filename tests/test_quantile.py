import random

import numpy as np
import pytest

from tickwise.operators.quality import latency_stats, value_at


@pytest.mark.parametrize("values", [
    [0.0], [5, 5, 5, 5], [-3.5, 0, 0, 2, 1e300, -1e300, 7], [1 + i * 1e-13 for i in range(300)],
    [random.Random(1).gauss(0, 1) * 10 ** random.Random(i).randrange(-9, 9) for i in range(500)]])
def test_ranks_and_percentile_are_exact(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "latency_ms double")
    got = latency_stats(df).first()
    assert got.n == len(values) and got.p95_ms == pytest.approx(np.quantile(values, 0.95), rel=1e-12)
    counts = df.where("latency_ms IS NOT NULL AND NOT isnan(latency_ms)").groupBy(df.latency_ms.alias("x")).count() \
        .withColumnRenamed("count", "c")
    for rank in {0, len(values) // 2, len(values) - 1}:
        assert value_at(counts, rank) == sorted(map(float, values))[rank]


def test_one_far_outlier_keeps_passes_small(spark):
    values = [float(i) for i in range(2000)] + [1e300]
    df = spark.createDataFrame([(v,) for v in values], "latency_ms double")
    assert latency_stats(df).first().p95_ms == pytest.approx(np.quantile(values, 0.95), rel=1e-12)


def test_nothing(spark):
    assert tuple(latency_stats(spark.createDataFrame([], "latency_ms long")).first()) == (None, None, 0)
