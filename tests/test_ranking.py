import math
import random

import numpy as np
from conftest import rows

from fundloom.operators import ranking as r


def graph(spark, edges, nodes):
    return spark.createDataFrame([(n,) for n in nodes], "node int"), spark.createDataFrame(edges, "src int, dst int")


def test_pagerank_against_power_iteration(spark):
    rnd = random.Random(2)
    n = 30
    edges = sorted({(rnd.randrange(n), rnd.randrange(n)) for _ in range(70)})
    edges = [e for e in edges if e[0] != e[1]]
    p = np.full(n, 1 / n)
    out = np.bincount([a for a, _ in edges], minlength=n)
    for _ in range(60):
        q = np.full(n, 0.15 / n + 0.85 * p[out == 0].sum() / n)
        for a, b in edges:
            q[b] += 0.85 * p[a] / out[a]
        p = q
    got = dict(rows(r.pagerank(*graph(spark, edges, range(n)), iterations=40, tol=1e-9)))
    assert max(abs(got[i] - p[i]) for i in range(n)) < 1e-6 and math.isclose(sum(got.values()), 1)


def test_pagerank_edges(spark):
    nodes, edges = graph(spark, [(1, 2)], [1, 2])
    assert {k: round(v, 6) for k, v in rows(r.pagerank(nodes, edges.limit(0), iterations=3))} == {1: 0.5, 2: 0.5}
    assert rows(r.pagerank(nodes.limit(0), edges.limit(0))) == []


def test_coupling(spark):
    nodes, edges = graph(spark, [(1, 9), (1, 8), (2, 9), (2, 8), (3, 9), (4, 7)], [1, 4])
    assert rows(r.coupling(edges, nodes), "query", "node", "shared", "pos") == [(1, 2, 2, 1), (1, 3, 1, 2)]


def test_tfidf_rows_have_length_one(spark):
    d = spark.createDataFrame([(1, "alpha beta beta"), (2, "beta gamma"), (3, None), (4, ""), (5, "alpha gamma")], "doc_id int, text string")
    w = r.tfidf(d, min_df=2).collect()
    for k in (1, 2, 5):
        assert math.isclose(sum(x.weight**2 for x in w if x.doc_id == k), 1)
    assert {x.doc_id for x in w} == {1, 2, 5}
    idf = lambda df: math.log(6 / (1 + df)) + 1
    a, b = idf(2), 2 * idf(2)
    assert math.isclose(next(x.weight for x in w if x.doc_id == 1 and x.term == "beta"), b / math.hypot(a, b))


def test_cosine_topk_against_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 8))
    x[7] = x[3]
    d = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(60)] + [(60, [0.0] * 8), (61, None)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = rows(r.cosine_topk(d, d.where("vec_id % 10 = 0"), 4), "query", "pos", "vec_id")
    s = np.round(u @ u.T, 6)
    want = [(q, p + 1, j) for q in range(0, 60, 10) for p, j in enumerate(sorted((j for j in range(60) if j != q), key=lambda j: (-s[q, j], j))[:4])]
    assert [t for t in got if t[0] < 60] == want
    assert rows(r.cosine_topk(d, d.limit(0), 4)) == []


def test_metrics(spark):
    ranked = spark.createDataFrame([(1, "a", 1), (1, "x", 2), (1, "b", 3)], "query int, item string, pos int")
    gold = spark.createDataFrame([(1, "a"), (1, "b"), (2, "z")], "query int, item string")
    got = rows(r.metrics(ranked, gold, (1,)))
    assert got == [(1, round((1 + 2 / 3) / 2, 6), 1.0, 0.5), (2, 0.0, 0.0, 0.0)]


def test_word_vectors_rebuild_the_matrix(spark):
    rng = np.random.default_rng(1)
    b = np.abs(rng.normal(size=(12, 3)))
    m = b @ b.T
    names = [f"w{i:02}" for i in range(12)]
    d = spark.createDataFrame([(names[i], names[j], float(m[i, j])) for i in range(12) for j in range(12)], "a string, b string, ppmi double")
    v = {x.word: np.array(x.vector) for x in r.word_vectors(d, 3).collect()}
    assert np.allclose([[v[i] @ v[j] for j in names] for i in names], m, atol=1e-6)


def test_latent_vectors_keep_angles(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(20, 3)) @ rng.normal(size=(3, 15))
    d = spark.createDataFrame([(i, f"t{j:02}", float(m[i, j])) for i in range(20) for j in range(15)], "doc_id long, term string, weight double")
    v = {x.doc_id: np.array(x.embedding) for x in r.latent_vectors(d, 3).collect()}
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    assert np.allclose([[v[i] @ v[j] for j in range(20)] for i in range(20)], u @ u.T, atol=1e-6)
    assert rows(r.latent_vectors(d.limit(0))) == []


def test_all_ranks_and_blocks(spark):
    """Every vector is ranked, and blocks of queries change nothing."""
    rng = np.random.default_rng(3)
    d = spark.createDataFrame([(i, [float(v) for v in rng.normal(size=4)]) for i in range(40)], "vec_id long, embedding array<double>")
    q = d.where("vec_id % 4 = 0")
    whole = rows(r.cosine_topk(d, q, None))
    assert len(whole) == 10 * 39 and rows(r.cosine_topk(d, q, 3)) == [x for x in whole if x[3] <= 3]
    least, r.BLOCK_ROWS = r.BLOCK_ROWS, 3
    try:
        assert rows(r.cosine_topk(d, q, 3)) == [x for x in whole if x[3] <= 3]
    finally:
        r.BLOCK_ROWS = least


def test_document_vectors(spark):
    docs = spark.createDataFrame([(1, "alpha beta beta"), (2, "gamma"), (3, None)], "doc_id long, text string")
    words = spark.createDataFrame([("alpha", [1.0, 0.0]), ("beta", [0.0, 3.0])], "word string, vector array<double>")
    assert [(x.doc_id, [round(v, 6) for v in x.embedding]) for x in r.document_vectors(docs, words).collect()] == [(1, [round(1 / 3, 6), 2.0])]


def test_sparse_topk_against_all_products(spark):
    """Ties, terms that all hold and queries of such terms only are ranked as by all products, in one block or several."""
    rng, rnd = np.random.default_rng(5), random.Random(5)
    m = np.zeros((120, 30))
    for i in range(120):
        for j in rnd.sample(range(30), 5):
            m[i, j] = rng.uniform(0.1, 1)
        m[i, :3] = rng.uniform(0.05, 0.3, 3) if i % 10 else (0.9, 0.1, 0)  # nearly all hold these
    m[10, 3:] = 0  # a query of common terms only
    m[33] = m[34]
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    d = spark.createDataFrame([(i, f"t{j:02}", float(m[i, j])) for i in range(120) for j in range(30) if m[i, j] > 0], "doc_id long, term string, weight double")
    q = spark.createDataFrame([(i,) for i in range(0, 120, 10)] + [(999,)], "doc_id long")
    s = np.round(m @ m.T, 6)
    want = [(i, p + 1, j) for i in range(0, 120, 10) for p, j in enumerate(sorted((j for j in range(120) if j != i and s[i, j] > 0), key=lambda j: (-s[i, j], j))[:4])]
    assert rows(r.sparse_topk(d, q, 4), "query", "pos", "doc_id") == want
    least, r.SPARSE_ROWS = r.SPARSE_ROWS, 5
    try:
        assert rows(r.sparse_topk(d, q, 4), "query", "pos", "doc_id") == want
    finally:
        r.SPARSE_ROWS = least
    assert rows(r.sparse_topk(d.limit(0), q)) == []


def test_pair_counts_against_writing_them_out(spark):
    from collections import Counter
    from itertools import combinations

    from fundloom.operators import pairs

    rnd = random.Random(3)
    data = [([rnd.randrange(40) for _ in range(rnd.randrange(12))] + [None] * (i % 2), rnd.randrange(1, 4)) for i in range(80)] + [(None, 1), ([], 2)]
    want = Counter()
    for x, w in data:
        for a, b in combinations(sorted({v for v in x or [] if v is not None}), 2):
            want[a, b] += w
    wide = pairs.WIDE
    try:
        for pairs.WIDE in (3000, 15):
            got = pairs.pair_counts(spark.createDataFrame(data, "members array<long>, weight int"))
            assert {(a, b): n for a, b, n in rows(got)} == want
    finally:
        pairs.WIDE = wide
