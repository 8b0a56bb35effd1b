import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fundloom.operators.ranks import POISSON, concentration, gini_draws, global_order, lorenz, resampled, spearman
from fundloom.plans.rankings import sign_p


def values(spark, *x):
    return spark.createDataFrame([(i, float(v) if v is not None else None) for i, v in enumerate(x)], "k int, x double")


def test_closed_forms(spark):
    g = lambda *x: concentration(values(spark, *x), "x", "k").first()
    assert g(5, 5, 5, 5).gini == 0 and g(5, 5, 5, 5).hhi == 0.25
    assert abs(g(1, 2, 3, 4, 5).gini - 0.266667) < 1e-6
    assert g(0, 0, 0, 8).gini == 0.75 and g(0, 0, 0, 8).hhi == 1 and g(0, 0, 0, 8).top_1 == 1
    assert g(0, 0).gini is None and g(None).n == 0 and g().gini is None
    with pytest.raises(Exception, match="negative"):
        g(1, -1)


def test_global_order(spark):
    rnd = random.Random(1)
    x = [rnd.randrange(20) for _ in range(500)]
    got = rows(global_order(values(spark, *x), F.asc("x"), F.asc("k"), value="x"), "rank", "k", "upto")
    want = sorted(range(500), key=lambda i: (x[i], i))
    assert [k for _, k, _ in got] == want and got[-1][2] == sum(x) and [r for r, _, _ in got] == list(range(1, 501))


def test_lorenz(spark):
    assert rows(lorenz(values(spark, 1, 1, 1, 1), "x", "k", 4)) == [(1, 0.25), (2, 0.5), (3, 0.75), (4, 1.0)]


def test_spearman_ordinal(spark):
    d = spark.createDataFrame([(0, 1.0, 1.0), (1, 2.0, 1.0), (2, 3.0, 9.0)], "k int, a double, b double")
    assert spearman(d, "a", "b", "k").first().spearman == 1.0


def test_sign():
    assert sign_p(0, 0) == 1 and math.isclose(sign_p(10, 10), 2 / 1024) and sign_p(5, 10) == 1


def test_resampling(spark):
    """Weights are Poisson of mean 1, the same for the same key, and don't depend on the layout."""
    d = spark.createDataFrame([(f"k{i}", float(i)) for i in range(300)], "k string, x double")
    w = resampled(d, F.col("k"), 100, 5)
    total = w.agg(F.sum("w"), F.count("*"), F.max("w")).first()
    assert abs(total[0] / 30_000 - 1) < 0.03 and abs(total[1] / 30_000 - (1 - math.exp(-1))) < 0.02 and total[2] < 12
    assert rows(w.repartition(7).groupBy("b").agg(F.sum("w"))) == rows(resampled(d.repartition(5), F.col("k"), 100, 5).groupBy("b").agg(F.sum("w")))
    assert POISSON[0] == int(2**32 * math.exp(-1)) and len(POISSON) == 11
    g = [r.gini for r in gini_draws(d, "x", "k", 200, 1).collect()]
    true = concentration(d, "x", "k").first().gini
    assert min(g) < true < max(g) and abs(sum(g) / len(g) - true) < 0.02
    assert gini_draws(d.limit(0), "x", "k", 5, 1).count() == 0
