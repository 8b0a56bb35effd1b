"""Places of held-out works against a full ranking."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fundloom.plans import crossfield


def test_places_equal_those_of_a_full_ranking(monkeypatch):
    """Blocks of works add up to the position in the whole order: score descending, then the smaller node; the query and
    its visible references take no part; works without words or references stand at zero."""
    monkeypatch.setattr(crossfield, "ROWS", 7)
    rng = np.random.default_rng(3)
    vector = {n: (np.sort(rng.choice(6, rng.integers(0, 4), replace=False)), None) for n in range(60)}
    vector = {n: (i, rng.integers(1, 3, len(i)) / 4) for n, (i, _) in vector.items()}
    queries = [0, 20, 40]
    seen = {(q, n) for q in queries for n in (q + 1, q + 2)}
    gold = [(q, n) for q in queries for n in (q + 3, q + 9, (q + 30) % 60)]
    refs = {(q, int(n)): float(rng.integers(1, 4)) for q in queries for n in rng.choice(60, 12, replace=False) if n != q}
    row = lambda kind, q, n, v=None, x=0.0: {"kind": kind, "query": q, "node": n, "i": vector[v][0] if v is not None else [], "w": vector[v][1] if v is not None else [], "n": x}
    total = {}
    for block in range(3):
        docs = pd.DataFrame([{"node": n, "i": vector[n][0], "w": vector[n][1]} for n in vector if n % 3 == block])
        asked = [row(0, q, q, q) for q in queries] + [row(1, q, n, n, refs.get((q, n), 0.0)) for q, n in gold]
        asked += [row(2, q, n, None, x) for (q, n), x in refs.items() if n % 3 == block] + [row(3, q, n) for q, n in seen | {(q, q) for q in queries} if n % 3 == block]
        for r in crossfield._above(("f", 0, block), docs, pd.DataFrame(asked)).itertuples():
            t = total.setdefault((r.query, r.node), [1, 1])
            t[0], t[1] = t[0] + r.text, t[1] + r.graph
    dense = {n: np.bincount(i, w, 6) if len(i) else np.zeros(6) for n, (i, w) in vector.items()}
    want = {}
    for q, n in gold:
        cand = [c for c in vector if c != q and (q, c) not in seen]
        of = lambda f: sorted(cand, key=lambda c: (-round(f(c), 6), c)).index(n) + 1  # noqa: B023, E731
        want[q, n] = [of(lambda c: dense[q] @ dense[c]), of(lambda c: refs.get((q, c), 0.0))]  # noqa: B023
    assert total == want


def test_candidates_are_not_written(spark):
    """Only held-out works have a place in the plan: no window sorts the candidates of a query."""
    import os

    import pytest

    from fundloom.plans.graph import Graph

    root = "/root/testdata/sf0.001"
    if not os.path.isdir(root):
        pytest.skip("no test tables")
    g = Graph(spark, root)
    works = crossfield._works(g)
    edges = g.citation.join(works.withColumnRenamed("node", "src"), "src").select("field", "src", "dst")
    plan = crossfield._ranked(g, works, edges)._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" in plan and "gold" not in plan


def test_references_are_never_shuffled_all_at_once(spark, monkeypatch, tmp_path):
    """With a low limit no stage writes about as many rows as there are references, or even lines; nothing packed stays
    behind, and fields come out as they do in one piece."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    from fundloom.plans.graph import Graph

    rng, lines, parts = np.random.default_rng(5), 6000, 300
    table = lambda name, **c: pq.write_table(pa.table(c), tmp_path / f"{name}.parquet")
    table("lineitem", l_orderkey=rng.integers(0, lines // 6, lines), l_partkey=rng.integers(0, parts, lines), l_linenumber=rng.integers(1, 20, lines).astype(np.int32), l_shipdate=np.full(lines, "2020-01-01", "datetime64[us]"))
    table("part", p_partkey=np.arange(parts), p_name=[f"some w{n % 40} word{n % 7}" for n in range(parts)], p_brand=[f"Brand#{n // 7 % 4}" for n in range(parts)], p_size=np.ones(parts, np.int32), p_type=["t"] * parts)
    table("nation", n_nationkey=np.arange(25), n_name=[f"n{n}" for n in range(25)], n_regionkey=np.arange(25) % 2)
    table("region", r_regionkey=np.arange(2), r_name=["a", "b"])
    g = Graph(spark, str(tmp_path))
    works = crossfield._works(g)
    cites = g.citation.join(works.withColumnRenamed("node", "src"), "src").join(works.select(F.col("node").alias("dst"), F.col("field").alias("f")), "dst")
    want = {r.field: (r.o, r.e) for r in cites.groupBy("field").agg(F.count("*").alias("o"), F.sum((F.col("field") == F.col("f")).cast("long")).alias("e")).collect()}
    shown = lambda df: sorted(tuple(r) for r in df.collect())
    text = shown(crossfield._ranked(g, works, cites.where("field = f").select("field", "src", "dst")))
    monkeypatch.setattr(crossfield, "LEAST_ROWS", 1000, raising=False)
    jvm, store = spark.sparkContext._jvm, spark.sparkContext._jsc.sc().statusStore()
    stages = lambda: {x.stageId(): x.shuffleWriteRecords() for x in jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList()))}
    before = stages()
    got = crossfield.analyze(g, works, draws=5).collect()
    written = max(n for k, n in stages().items() if k not in before)
    assert written <= 0.8 * lines, f"{written} rows in one stage; {sum(o for o, _ in want.values())} references, {lines} lines"
    assert {r.field: (r.out_refs, r.edges_in_corpus) for r in got} == want
    assert {(r.field, r.queries or 0) for r in got} == {(f, len({x[1] for x in text if x[0] == f})) for f in want}
    for m in ("text", "graph"):
        assert {r.field: r[f"map_{m}"] for r in got} == {f: round(float(np.mean([x[3] for x in text if x[0] == f and x[2] == m])), 6) for f in want}, m
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert os.path.isdir(folder) and not [x for x in os.listdir(folder) if x.startswith("packed")]


def test_works_of_equal_text_are_scored_as_one(monkeypatch):
    """Places are the same whether equal texts are scored together or one by one."""
    rng, n = np.random.default_rng(8), 400
    texts = [(np.array([0, 1]), np.array([0.6, 0.8])), (np.array([1, 2]), np.array([0.8, 0.6])), (np.array([2]), np.array([1.0])), (np.zeros(0, int), np.zeros(0))]
    texts += [(np.array([0, 3 + k]), np.array([0.6, 0.8])) for k in range(20)]
    of = {x: texts[k] for x, k in enumerate(np.minimum(rng.geometric(0.15, n) - 1, len(texts) - 1))}
    row = lambda kind, q, x, v=True, m=0.0: {"kind": kind, "query": q, "node": x, "i": of[x][0] if v else [], "w": of[x][1] if v else [], "n": m}
    docs = pd.DataFrame([{"node": x, "i": i, "w": w} for x, (i, w) in of.items()])
    asked = [row(0, q, q) for q in (0, 50, 100)] + [row(1, q, (q * 3 + x) % n, m=float(x % 2)) for q in (0, 50, 100) for x in (7, 8, 211)]
    asked = pd.DataFrame(asked + [row(2, q, x, False, 1.0) for q in (0, 50) for x in range(1, 300, 30)] + [row(3, q, x, False) for q in (0, 50, 100) for x in (q, 31, 40)])
    out = []
    for least in (2, 10**6):
        monkeypatch.setattr(crossfield, "ALIKE", least)
        monkeypatch.setattr(crossfield, "ROWS", 5)
        out.append(crossfield._above(("f", 0, 0), docs, asked))
    pd.testing.assert_frame_equal(*out)
    assert out[0]["text"].max() > 0


def test_every_work_is_a_query(spark, tmp_path):
    """No number here is divisible by 50, so a sample by numbers would have no query; the row equals that of the SQL."""
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng, lines, parts = np.random.default_rng(6), 700, 49
    table = lambda name, **c: pq.write_table(pa.table(c), tmp_path / f"{name}.parquet")
    table("lineitem", l_orderkey=rng.integers(0, lines // 5, lines), l_partkey=rng.integers(1, parts + 1, lines), l_linenumber=rng.integers(1, 20, lines).astype(np.int32), l_shipdate=np.full(lines, "2020-01-01", "datetime64[us]"))
    keys = np.arange(1, parts + 1)
    table("part", p_partkey=keys, p_name=[f"some w{n % 11} word{n % 7}" for n in keys], p_brand=[f"Brand#{n // 3 % 4}" for n in keys], p_size=np.ones(parts, np.int32), p_type=["t"] * parts)
    table("nation", n_nationkey=np.arange(25), n_name=[f"n{n}" for n in range(25)], n_regionkey=np.arange(25) % 2)
    table("region", r_regionkey=np.arange(2), r_name=["a", "b"])
    got = crossfield.crossfield(spark, str(tmp_path)).first()
    duck = duckdb.connect()
    for name in ("lineitem", "part", "nation", "region"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    want = duck.execute(crossfield.ORACLES["crossfield"])
    want = dict(zip([c[0] for c in want.description], want.fetchone(), strict=True))
    assert got.n == 2
    assert {k: round(float(v), 5) for k, v in got.asDict().items()} == {k: round(float(v), 5) for k, v in want.items()}
