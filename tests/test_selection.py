import random
import statistics

import pytest
from pyspark.sql import functions as F

from annolab.operators import selection as S


@pytest.mark.parametrize("seed", range(4))
def test_equals_a_sort(spark, seed):
    r = random.Random(seed)
    kinds = [lambda: r.gauss(0, 1), lambda: r.choice([0.0, 0.0, -1.5, 2.0]), lambda: 10.0 ** r.randint(-300, 300) * r.choice([-1, 1]),
             lambda: float(r.randint(0, 9))]
    values = [kinds[seed]() for _ in range(1501 + seed)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double").repartition(3)
    assert S.exact_median(df, "x", few=20) == statistics.median(values)
    v = df.select(F.col("x").alias("v")).where("x IS NOT NULL AND NOT isnan(x)")
    for k in (0, 7, len(values) - 1):
        assert S.nth(v, k, len(values), few=5) == sorted(values)[k]


def test_without_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert S.exact_median(df, "x") is None and S.exact_median(df.limit(0), "x") is None
    assert S.exact_median(spark.createDataFrame([(3,)], "x int"), "x") == 3.0
