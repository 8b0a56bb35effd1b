import math
import random

from conftest import rows

from fundloom.operators.skew import grouped_quantiles, heavy_keys, key_totals, skew_safe_join


def test_heavy_keys_against_counting(spark):
    rnd = random.Random(1)
    data = [(rnd.choice(["a"] * 300 + ["b"] * 40 + [None] * 20 + [f"k{i}" for i in range(640)]), i) for i in range(3000)]
    got = dict(rows(heavy_keys(spark.createDataFrame(data, "k string, rows long"), "k", 0.02)))
    want = {k: n for k in {x for x, _ in data} if k is not None and (n := sum(x == k for x, _ in data)) >= 0.02 * len(data)}
    assert got == want and set(want) == {"a", "b"}


def test_heavy_keys_edges(spark):
    assert rows(heavy_keys(spark.createDataFrame([], "k string"), "k", 0.02)) == []
    assert rows(heavy_keys(spark.createDataFrame([(None,)] * 5, "k string"), "k", 0.02)) == []
    # nulls count in the total, ties at the limit are kept
    d = spark.createDataFrame([("a",), ("b",), (None,), (None,)], "k string")
    assert rows(heavy_keys(d, "k", 0.25)) == [("a", 1), ("b", 1)]
    assert rows(heavy_keys(d, "k", 0.26)) == []
    assert rows(key_totals(d, "k")) == [(None, 2), ("a", 1), ("b", 1)]


def test_quantiles_against_sorting(spark):
    rnd = random.Random(2)
    data = [("hot", float(rnd.choice([1, 2, 2, 2, rnd.gauss(0, 1e6)]))) for _ in range(1500)] + [(f"k{i % 7}", rnd.random()) for i in range(60)] + [("one", 5.0), ("nan", float("nan")), (None, 1.0), ("hot", None)]
    qs = (0.0, 0.25, 0.5, 0.9, 1.0)
    for small in (10_000, 50):  # by window only, and by selection for the hot key
        got = {(k, q): (n, v) for k, q, n, v in rows(grouped_quantiles(spark.createDataFrame(data, "k string, v double"), "k", "v", qs, small=small, buckets=16))}
        keys = {k for k, v in data if k and v is not None and not math.isnan(v)}
        assert {k for k, _ in got} == keys
        for k in keys:
            x = sorted(v for kk, v in data if kk == k and v is not None)
            for q in qs:
                assert got[k, q] == (len(x), x[max(1, math.ceil(q * len(x))) - 1])


def test_quantiles_of_extreme_values(spark):
    """Infinities, denormals, neighbours and values of all magnitudes are settled in a few rounds."""
    inf, rnd = math.inf, random.Random(7)
    sets = {
        "inf": [float(i) for i in range(20)] + [inf], "both": [-inf, inf, 1.0, -1.0] * 5, "denormal": [5e-324 * i for i in range(-10, 11)], "next": [1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0)] * 7,
        "wide": [rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-320, 308) for _ in range(60)], "top": [1.7e308, -1.7e308, 0.0, -0.0, inf, 1.7976931348623157e308] * 4,
    }
    qs = (0.0, 0.1, 0.5, 0.95, 1.0)
    got = {(k, q): v for k, q, _, v in rows(grouped_quantiles(spark.createDataFrame([(k, v) for k, x in sets.items() for v in x], "k string, v double"), "k", "v", qs, small=5, buckets=4))}
    assert got == {(k, q): sorted(x)[max(1, math.ceil(q * len(x))) - 1] for k, x in sets.items() for q in qs}


def test_quantiles_of_nothing(spark):
    assert rows(grouped_quantiles(spark.createDataFrame([], "k string, v double"), "k", "v", (0.5,))) == []


def test_skew_safe_join(spark):
    left = spark.createDataFrame([("hot", i) for i in range(200)] + [("x", 1), ("y", 2), (None, 3)], "k string, i int")
    right = spark.createDataFrame([("hot", 10), ("x", 20), ("z", 30)], "k string, v int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        assert rows(skew_safe_join(left, right, "k", how, share=0.5)) == rows(left.join(right, "k", how))
