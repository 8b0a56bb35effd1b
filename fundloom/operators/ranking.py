"""Citation graph, text vectors, nearest neighbours and retrieval metrics."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundloom.functions.text import tokenize
from fundloom.session import cut

#: Query vectors, and sparse query documents, held by a task at once.
BLOCK_ROWS, SPARSE_ROWS = 4096, 256


def pagerank(nodes: DataFrame, edges: DataFrame, damping: float = 0.85, iterations: int = 200, tol: float = 1e-10, stride: int = 5) -> DataFrame:
    """``(node, rank)``; dangling mass is spread evenly, ranks add up to 1. Ends when the L1 change over the last
    ``stride`` iterations is below ``tol``, or after ``iterations``.

    An iteration is one join on the edges' own partitioning and one sum by target, combined map-side, to which every node
    adds its base. The base holds the mass of dangling nodes as it was when the stride began: that is what it settles to,
    and plans stay a chain. Lineage is cut every ``stride`` iterations.
    """
    n = nodes.count()
    if not n:
        return nodes.select("node", F.lit(0.0).alias("rank"))
    out = edges.groupBy("src").agg(F.count("*").alias("deg"))
    links = cut(edges.join(out, "src").select(F.col("src").alias("node"), "dst", (damping / F.col("deg")).alias("w")).repartition("node"))
    known = cut(nodes.join(out.select(F.col("src").alias("node"), F.lit(False).alias("dangling")), "node", "left").select("node", F.coalesce("dangling", F.lit(True)).alias("dangling")))
    state = known.select("node", F.lit(1.0 / n).alias("rank"))
    lost, done, change = known.where("dangling").count() / n, 0, math.inf
    while done < iterations and change >= tol:
        before = state
        base = known.select("node", F.lit((1 - damping + damping * lost) / n).alias("rank"))
        for _ in range(min(stride, iterations - done)):
            given = links.join(state, "node").select(F.col("dst").alias("node"), (F.col("w") * F.col("rank")).alias("rank"))
            state = given.unionByName(base).groupBy("node").agg(F.sum("rank").alias("rank"))
            done += 1
        state = cut(state)
        old = before.withColumnRenamed("rank", "old")
        lost, change = state.join(old, "node").join(known, "node").agg(F.coalesce(F.sum(F.when(F.col("dangling"), F.col("rank"))) / F.sum("rank"), F.lit(0.0)), F.sum(F.abs(F.col("rank") - F.col("old")))).first()
        change = change if tol > 0 else math.inf
    total = state.agg(F.sum("rank").alias("total"))
    return state.crossJoin(F.broadcast(total)).select("node", (F.col("rank") / F.col("total")).alias("rank"))  # one row


def coupling(edges: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``(query, node, shared, pos)``: the nodes that share most references with each query node. Ties: smaller node."""
    mine = edges.join(queries.select(F.col("node").alias("src")), "src", "left_semi").select(F.col("src").alias("query"), "dst")
    shared = mine.join(edges, "dst").where("query <> src").groupBy("query", F.col("src").alias("node")).agg(F.count("*").alias("shared"))
    return _top(shared, "query", k, F.desc("shared"), F.asc("node"))


def _top(df: DataFrame, group: str, k: int, *order) -> DataFrame:
    return df.withColumn("pos", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("pos") <= k)


def tfidf(documents: DataFrame, min_df: int = 2, max_features: int = 20_000) -> DataFrame:
    """``(doc_id, term, weight)``: smooth idf ``ln((1 + n) / (1 + df)) + 1``, rows of length 1; vocabulary by df, then term.

    ``max_features`` is a feature of the model. Counts are combined map-side; the vocabulary is broadcast, bounded by it.
    """
    words = documents.where("text is not null").select("doc_id", F.explode(tokenize(F.col("text"))).alias("term"))
    tf = cut(words.groupBy("doc_id", "term").agg(F.count("*").alias("tf")))
    n = documents.count()
    vocab = tf.groupBy("term").agg(F.count("*").alias("df")).where(F.col("df") >= min_df).orderBy(F.desc("df"), "term").limit(max_features).select("term", (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1).alias("idf"))
    raw = tf.join(F.broadcast(vocab), "term").select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("w"))
    length = raw.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"))
    return raw.join(length, "doc_id").select("doc_id", "term", (F.col("w") / F.col("len")).alias("weight"))


def _indexed(weights: DataFrame) -> tuple[list[str], DataFrame]:
    """The terms in order (bounded by VOCAB), and a row per document: ``(doc_id, i, w)`` with the terms' places and weights."""
    spark = weights.sparkSession
    terms = [r.term for r in weights.select("term").distinct().orderBy("term").limit(VOCAB + 1).collect()]
    if len(terms) > VOCAB:
        raise ValueError(f"more than {VOCAB} terms; lower max_features")
    index = spark.createDataFrame(list(enumerate(terms)), "j int, term string")
    return terms, cut(weights.join(F.broadcast(index), "term").groupBy("doc_id").agg(F.collect_list("j").alias("i"), F.collect_list("weight").alias("w")))


def sparse_topk(weights: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``(query, doc_id, score, pos)``: nearest documents of each query document by sparse dot product; documents without
    a common term take no part, ties are ordered by id.

    Queries go round in blocks of SPARSE_ROWS, of which the driver holds one at a time; a block is a thin matrix over the
    terms its queries have. A task multiplies its documents with it and keeps the k best per query, so a term that every
    document holds costs arithmetic but is never shuffled: what is shuffled is k rows per query and batch.
    """
    spark = weights.sparkSession
    terms, docs = _indexed(weights)
    asked = docs.join(queries.select("doc_id").distinct(), "doc_id", "left_semi")
    blocks = -(-asked.count() // SPARSE_ROWS)
    out = None
    for n in range(blocks):
        held = (asked.where(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)) == n) if blocks > 1 else asked).collect()
        if not held:
            continue
        used = np.unique(np.concatenate([r.i for r in held]))
        place = np.full(len(terms), -1, np.int32)
        place[used] = np.arange(len(used))
        matrix = np.zeros((len(used), len(held)))
        for c, r in enumerate(held):
            matrix[place[r.i], c] = r.w
        block = spark.sparkContext.broadcast((np.array([r.doc_id for r in held]), place, matrix))

        def run(batches: Iterator[pd.DataFrame], block=block) -> Iterator[pd.DataFrame]:
            qid, place, matrix = block.value
            for whole in batches:
                for at in range(0, len(whole), 500):
                    b = whole.iloc[at : at + 500]
                    size = b["i"].map(len).to_numpy()
                    row, w = place[np.concatenate(b["i"].to_numpy())], np.concatenate(b["w"].to_numpy())
                    owner = np.repeat(np.arange(len(b)), size)[row >= 0]
                    if not len(owner):
                        continue
                    part = w[row >= 0, None] * matrix[row[row >= 0]]
                    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                    vid, s = b["doc_id"].to_numpy()[owner[starts]], np.add.reduceat(part, starts, axis=0).T
                    s[qid[:, None] == vid[None, :]] = 0
                    m = min(k, s.shape[1])
                    edge = -np.partition(-s, m - 1, axis=1)[:, m - 1]
                    i, j = np.nonzero((s >= edge[:, None] - 1e-6) & (s > 0))
                    yield pd.DataFrame({"query": qid[i], "doc_id": vid[j], "score": s[i, j]})

        part = docs.mapInPandas(run, "query long, doc_id long, score double")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "query long, doc_id long, score double, pos int")
    return _top(out.withColumn("score", F.round("score", 6)), "query", k, F.desc("score"), F.asc("doc_id"))


def cosine_topk(vectors: DataFrame, queries: DataFrame, k: int | None = 10) -> DataFrame:
    """``(query, vec_id, score, pos)``: nearest vectors of each query vector, itself left out; every one with ``k`` None.

    The queries go round in blocks of about BLOCK_ROWS, told by the hash of their id; the driver holds one block at a
    time. A task multiplies its batch with a block and keeps the k best per query, so what is shuffled is k rows per query
    and batch. Null and zero vectors take no part; equal scores are ordered by id.
    """
    spark = vectors.sparkSession
    asked = queries.where("embedding is not null").select("vec_id", "embedding")
    count = asked.count()
    blocks = max(1, -(-count // BLOCK_ROWS))
    if not count:
        return spark.createDataFrame([], "query long, vec_id long, score double, pos int")
    out = None
    for b in range(blocks):
        held = (asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b) if blocks > 1 else asked).collect()
        if not held:
            continue
        block = spark.sparkContext.broadcast((np.array([r.vec_id for r in held]), np.array([r.embedding for r in held], np.float64)))

        def run(batches: Iterator[pd.DataFrame], block=block) -> Iterator[pd.DataFrame]:
            qid, q = block.value
            q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)
            for b in batches:
                b = b[b["embedding"].notna()]
                if not len(b):
                    continue
                x = np.stack(b["embedding"].to_numpy()).astype(np.float64)
                norm = np.linalg.norm(x, axis=1, keepdims=True)
                ok = norm[:, 0] > 0
                vid, s = b["vec_id"].to_numpy()[ok], q @ (x[ok] / norm[ok]).T
                s[qid[:, None] == vid[None, :]] = -np.inf
                m = s.shape[1] if k is None else min(k, s.shape[1])
                if not m:
                    continue
                # Equal scores at the border stay in: k best by score and id need them.
                edge = -np.partition(-s, m - 1, axis=1)[:, m - 1]
                i, j = np.nonzero((s >= edge[:, None]) & np.isfinite(s))
                yield pd.DataFrame({"query": qid[i], "vec_id": vid[j], "score": s[i, j]})

        part = vectors.select("vec_id", "embedding").mapInPandas(run, "query long, vec_id long, score double")
        out = part if out is None else out.unionByName(part)
    scored = out.withColumn("score", F.round("score", 6))
    if k is None:
        return scored.withColumn("pos", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc("vec_id"))))
    return _top(scored, "query", k, F.desc("score"), F.asc("vec_id"))


def cooccurrence(documents: DataFrame, window: int = 5, min_df: int = 5) -> DataFrame:
    """``(a, b, n)``: how often two words (a < b in the result's both directions) stand within ``window`` words."""
    w = documents.where("text is not null").select("doc_id", F.posexplode(tokenize(F.col("text"))).alias("i", "w"))
    known = w.groupBy("w").agg(F.count_distinct("doc_id").alias("df")).where(F.col("df") >= min_df).select("w")
    kept = documents.where("text is not null").select(tokenize(F.col("text")).alias("t"))
    # Pairs are made inside the row: neighbours of each position are a slice of the same array, so nothing is joined.
    near = kept.select("t", F.posexplode("t").alias("i", "a")).select("a", F.explode(F.slice("t", F.col("i") + 2, F.lit(window))).alias("b"))
    n = near.groupBy("a", "b").agg(F.count("*").alias("n"))
    both = n.unionByName(n.select(F.col("b").alias("a"), F.col("a").alias("b"), "n")).where("a <> b").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return both.join(known.withColumnRenamed("w", "a"), "a", "left_semi").join(known.withColumnRenamed("w", "b"), "b", "left_semi")


def ppmi(counts: DataFrame) -> DataFrame:
    """``(a, b, n, ppmi)``, only where positive."""
    c = cut(counts)
    total = c.agg(F.sum("n").alias("total"))
    row = c.groupBy("a").agg(F.sum("n").alias("na"))
    x = c.join(row, "a").join(row.select(F.col("a").alias("b"), F.col("na").alias("nb")), "b").crossJoin(F.broadcast(total))
    return x.select("a", "b", "n", F.log(F.col("n") * F.col("total") / (F.col("na") * F.col("nb"))).alias("ppmi")).where("ppmi > 0")


def word_vectors(pairs: DataFrame, dim: int = 16, iterations: int = 6, seed: int = 0) -> DataFrame:
    """``(word, vector)``: the leading eigenvectors of the symmetric PPMI matrix, scaled by the root of the eigenvalue.

    Block power iteration: the matrix stays distributed, each round multiplies it with a thin block (words by ``dim + 8``)
    that is broadcast, and sums the products by word. Only that block is on the driver; it is bounded by VOCAB words.
    """
    spark = pairs.sparkSession
    vocab = [r.a for r in pairs.select("a").distinct().orderBy("a").limit(VOCAB + 1).collect()]
    if len(vocab) > VOCAB:
        raise ValueError(f"more than {VOCAB} words; raise min_df")
    if not vocab:
        return spark.createDataFrame([], "word string, vector array<double>")
    index = F.broadcast(spark.createDataFrame(list(enumerate(vocab)), "i int, w string"))
    cells = cut(pairs.join(index.select(F.col("w").alias("a"), F.col("i")), "a").join(index.select(F.col("w").alias("b"), F.col("i").alias("j")), "b").select("i", "j", "ppmi"))
    k = min(dim + 8, len(vocab))

    def times(v: np.ndarray) -> np.ndarray:
        block = spark.sparkContext.broadcast(v)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            out = np.zeros_like(block.value)
            for b in batches:
                np.add.at(out, b["i"].to_numpy(), b["ppmi"].to_numpy()[:, None] * block.value[b["j"].to_numpy()])
            some = np.flatnonzero(np.abs(out).sum(1))
            if len(some):
                yield pd.DataFrame({"i": some.astype(np.int32), "y": list(out[some])})

        part = cells.mapInPandas(run, "i int, y array<double>")
        got = part.groupBy("i").agg(F.array(*[F.sum(F.col("y")[c]) for c in range(k)]).alias("y")).toPandas()
        full = np.zeros_like(v)
        full[got["i"].to_numpy()] = np.stack(got["y"].to_numpy())
        block.unpersist()
        return full

    v = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(vocab), k)))[0]
    for _ in range(iterations):
        v = np.linalg.qr(times(v))[0]
    small = v.T @ times(v)
    value, turn = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-np.abs(value))[:dim]
    out = (v @ turn[:, best]) * np.sqrt(np.abs(value[best]))
    out *= np.sign(out[np.abs(out).argmax(0), np.arange(out.shape[1])])
    return spark.createDataFrame([(w, [float(x) for x in row]) for w, row in zip(vocab, out, strict=True)], "word string, vector array<double>")


#: Most words whose thin block the driver holds.
VOCAB = 100_000


def document_vectors(documents: DataFrame, words: DataFrame) -> DataFrame:
    """``(doc_id, embedding)``: the mean of the vectors of a document's words, repeats counted; documents without a known
    word drop out. Words are counted per document first; vectors meet them by word and are summed map-side."""
    w = documents.where("text is not null").select("doc_id", F.explode(tokenize(F.col("text"))).alias("word")).groupBy("doc_id", "word").agg(F.count("*").alias("c"))
    x = w.join(words, "word").select("doc_id", "c", F.posexplode("vector").alias("i", "v"))
    y = x.groupBy("doc_id", "i").agg((F.sum(F.col("c") * F.col("v")) / F.sum("c")).alias("v"))
    return y.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda z: z["v"]).alias("embedding"))


def latent_vectors(weights: DataFrame, dim: int = 16, iterations: int = 4, seed: int = 0) -> DataFrame:
    """``(doc_id, embedding)``: documents in the space of the leading ``dim`` singular directions of ``weights``
    ``(doc_id, term, weight)``, scaled to length 1.

    Block power iteration on the term side: one pass per round multiplies each document's row with a thin block (terms by
    ``dim + 8``, bounded by the vocabulary of ``tfidf``) and back; partial products are summed by term.
    """
    spark = weights.sparkSession
    terms, docs = _indexed(weights)
    if not terms:
        return spark.createDataFrame([], "doc_id long, embedding array<double>")
    k = min(dim + 8, len(terms))

    def round_trip(v: np.ndarray) -> np.ndarray:
        block = spark.sparkContext.broadcast(v)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            out = np.zeros_like(block.value)
            for b in batches:
                for i, w in zip(b["i"], b["w"], strict=True):
                    out[i] += np.asarray(w)[:, None] * (np.asarray(w) @ block.value[i])
            some = np.flatnonzero(np.abs(out).sum(1))
            if len(some):
                yield pd.DataFrame({"i": some.astype(np.int32), "y": list(out[some])})

        got = docs.select("i", "w").mapInPandas(run, "i int, y array<double>").groupBy("i").agg(F.array(*[F.sum(F.col("y")[c]) for c in range(k)]).alias("y")).toPandas()
        full = np.zeros_like(v)
        full[got["i"].to_numpy()] = np.stack(got["y"].to_numpy())
        block.unpersist()
        return full

    v = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(terms), k)))[0]
    for _ in range(iterations):
        v = np.linalg.qr(round_trip(v))[0]
    small = v.T @ round_trip(v)
    value, turn = np.linalg.eigh((small + small.T) / 2)
    base = spark.sparkContext.broadcast(v @ turn[:, np.argsort(-value)[:dim]])

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = [np.asarray(w) @ base.value[i] for i, w in zip(b["i"], b["w"], strict=True)]
            yield pd.DataFrame({"doc_id": b["doc_id"], "embedding": [(y / max(np.linalg.norm(y), 1e-12)).tolist() for y in x]})

    return docs.mapInPandas(project, "doc_id long, embedding array<double>")


def metrics(ranked: DataFrame, gold: DataFrame, ks: tuple[int, ...] = (5, 10, 20, 50)) -> DataFrame:
    """``(query, ap, rr, recall_<k>)`` from ``(query, item, pos)`` and the relevant ``(query, item)``."""
    size = gold.groupBy("query").agg(F.count("*").alias("g"))
    hit = ranked.join(gold, ["query", "item"]).withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy("pos")))
    a = hit.groupBy("query").agg(F.sum(F.col("nth") / F.col("pos")).alias("s"), F.min("pos").alias("first"), *[F.sum((F.col("pos") <= k).cast("long")).alias(f"h{k}") for k in ks])
    x = size.join(a, "query", "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return x.select("query", F.round(zero(F.col("s") / F.col("g")), 6).alias("ap"), F.round(zero(1 / F.col("first")), 6).alias("rr"), *[F.round(zero(F.col(f"h{k}") / F.col("g")), 6).alias(f"recall_{k}") for k in ks])
