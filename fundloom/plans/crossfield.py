"""Held-out citation prediction field by field, what the fields have in common, and runs by tranche that can be resumed.

All fields are worked on at once: the field is a grouping column, not a loop. Queries are the works with five references
or more within their field, in ``crossfield`` all of them, in ``analyze_fields`` and tranches those whose number is
divisible by NTH; three in ten of these references are held out. Every other work of the field is ranked, by two methods: cosine of TF-IDF vectors of the titles, and shared references.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundloom.operators import ranking
from fundloom.operators.ranks import resampled, resampled_sql
from fundloom.plans.graph import Graph, with_views
from fundloom.plans.named import _ids
from fundloom.plans.rankings import sign_p
from fundloom.session import cut, packed
from fundloom.sources import sinks

#: Fewest queries that a field is evaluated with.
LEAST = 2
#: Works of one number in NTH are queries, unless all are.
NTH = 50
#: Queries and works of a field that a task is given; queries and texts that it compares at once.
QUERIES_A_BLOCK, WORKS_AT_ONCE, QUERIES_AT_ONCE, ROWS = 10_000, 250_000, 2000, 250
#: Works of equal text from which on they are scored as one.
ALIKE = 16
#: Lines go to their orders in up to SHARES shares, references to their works in as many as have half as many rows as there
#: are lines; no share need have fewer rows than LEAST_ROWS.
SHARES, LEAST_ROWS = 4, 4_000_000


def _works(g: Graph) -> DataFrame:
    """``(node, field)``: each work's top-level field."""
    return _ids(g.work_field, "node", "topic").join(g.climb, "topic").select("node", F.col("dom").alias("field"))


def _kinds(g: Graph, works: DataFrame) -> tuple[DataFrame, list]:
    """``(node, kind)``, and of each kind (there are few), by number, the fields that its works have in all and in
    ``works``, None unless they are in ``works``. Those in ``works`` come first."""
    fields = _works(g).groupBy("node").agg(F.sort_array(F.collect_set("field")).alias("fs"))
    mine = works.groupBy("node").agg(F.sort_array(F.collect_list("field")).alias("ws"))
    none = F.array().cast("array<string>")
    of = fields.join(mine, "node", "full").select("node", F.coalesce("fs", none).alias("fs"), F.coalesce("ws", none).alias("ws"), F.col("ws").isNotNull().alias("mine"))
    kinds = sorted(of.select("fs", "ws", "mine").distinct().collect(), key=lambda k: (not k.mine, k.fs, k.ws))
    numbered = g.spark.createDataFrame([(n, *k) for n, k in enumerate(kinds)], "kind int, fs array<string>, ws array<string>, mine boolean")
    return cut(of.join(F.broadcast(numbered), ["fs", "ws", "mine"]).select("node", "kind")), [(k.fs, k.ws if k.mine else None) for k in kinds]


def _orders(g: Graph, of: DataFrame, shares: int) -> Iterator[DataFrame]:
    """``l``: each order's lines with their works' kinds, -1 for none, in shares of the orders."""
    lines = g.line.where("l_orderkey is not null and l_partkey is not null and l_linenumber is not null").select("l_orderkey", F.col("l_partkey").alias("node"), F.col("l_linenumber").alias("i"))
    for n in range(shares):
        part = lines.where(F.pmod(F.xxhash64("l_orderkey"), F.lit(shares)) == n) if shares > 1 else lines
        told = part.join(of.hint("shuffle_hash"), "node", "left").withColumn("kind", F.coalesce("kind", F.lit(-1)))
        yield told.repartition("l_orderkey").groupBy("l_orderkey").agg(F.collect_list(F.struct("i", "node", "kind")).alias("l")).where(F.size("l") > 1).select("l")


@contextmanager
def _references(g: Graph, works: DataFrame, nth: int) -> Iterator[tuple[DataFrame, DataFrame, DataFrame, DataFrame]]:
    """``(field, out_refs)`` and ``(field, edges_in_corpus)``: how many works those of a field cite, and how many of these
    are in it; ``_split`` of the references within fields and ``_met`` of them. To be used within the block.

    References are never together on disk but as compressed columns: orders are packed with their works' kinds, then
    references are paired in the row and told apart for a share of the citing works at a time. A pair carries one number
    for both kinds; what fields it lies in is asked of the few kinds.
    """
    of, kinds = _kinds(g, works)
    base, mine = len(kinds) + 1, sum(ws is not None for _, ws in kinds)
    own = F.broadcast(g.spark.createDataFrame([(s, f) for s in range(mine) for f in kinds[s][1]], "s long, field string"))
    both = F.broadcast(g.spark.createDataFrame([(s * base + d + 1, s, d, f) for s in range(mine) for d in range(mine) for f in set(kinds[s][0]) & set(kinds[d][0])], "kk long, kind int, its int, field string"))
    lines = g.line.count()
    room = max(LEAST_ROWS, lines / 2)

    def pairs(orders: DataFrame, wanted: Column) -> DataFrame:
        citing = orders.select("l", F.inline("l").alias("i", "src", "kind")).where(F.col("kind").between(0, mine - 1)).where(wanted)
        later = citing.select("i", "src", "kind", F.inline("l").alias("j", "dst", "d")).where("j > i and src <> dst")
        one = later.select("src", "dst", (F.col("kind") * F.lit(base).cast("long") + F.col("d") + 1).alias("kk"))
        # Said here, these conditions aren't added for one reader only, and both read the same shuffle.
        return one.where("src is not null and dst is not null and kk is not null").repartition("src")

    def told() -> Iterator[DataFrame]:
        with packed(_orders(g, of, max(1, min(SHARES, lines // LEAST_ROWS)))) as orders:
            most = orders.agg(F.sum(F.size("l") * (F.size("l") - 1) / 2)).first()[0] or 0
            shares = max(1, math.ceil(most / room))
            for n in range(shares):
                part = pairs(orders, F.pmod(F.xxhash64("src"), F.lit(shares)) == n)
                within = part.join(both, "kk").select("field", "src", "dst", "kind", "its").distinct()
                counts = part.distinct().groupBy("kk").agg(F.count("*").alias("n"))
                yield _split(within, nth).withColumn("kk", F.lit(None).cast("long")).unionByName(counts, allowMissingColumns=True)

    with packed(told()) as found:
        counts = cut(found.where("kk is not null").select("kk", "n"))
        raw = counts.withColumn("s", F.floor(F.col("kk") / base)).join(own, "s").groupBy("field").agg(F.sum("n").alias("out_refs"))
        inner = counts.join(both, "kk").groupBy("field").agg(F.sum("n").alias("edges_in_corpus"))
        edges = found.where("kk is null").drop("kk", "n")
        with packed(_met(edges, _fields_of(g, kinds), room)) as met:
            yield raw, inner, edges, met


def _fields_of(g: Graph, kinds: list) -> DataFrame:
    """``(kind, field)``: the fields that works of a kind have in ``works``."""
    return F.broadcast(g.spark.createDataFrame([(n, f) for n, (_, ws) in enumerate(kinds) for f in sorted(set(ws or [])) if f is not None], "kind int, field string"))


def _split(edges: DataFrame, nth: int) -> DataFrame:
    """``edges`` with ``held``: whether a query's reference is held out, null where the citing work is no query."""
    w, asked = Window.partitionBy("src"), F.col("src") % nth == 0
    h = F.when(asked, F.md5(F.concat_ws(":", F.lit("0"), F.col("src").cast("string"), F.col("dst").cast("string"))))
    e = edges.select("*", F.row_number().over(w.orderBy(h, "dst")).alias("rn"), F.count("*").over(w).alias("of"))
    return e.withColumn("held", F.when(asked & (F.col("of") >= 5), F.col("rn") <= F.greatest(F.lit(1), F.bround(F.col("of") * 0.3)))).drop("rn", "of")


def _cited(edges: DataFrame, room: float) -> Iterator[DataFrame]:
    """``(dst, by, seen)``: each work with those that cite it, and how many of these are queries that show it; in shares."""
    shares = max(1, math.ceil(edges.count() / room))
    for n in range(shares):
        part = edges.where(F.pmod(F.xxhash64("dst"), F.lit(shares)) == n)
        yield part.groupBy("dst").agg(F.collect_list(F.struct("src", "kind")).alias("by"), F.count_if(~F.col("held")).alias("seen"))


def _met(edges: DataFrame, fields: DataFrame, room: float) -> Iterator[DataFrame]:
    """``(field, query, node, shares, above)`` of held-out works of some queries at a time: whether the work cites one that
    the query cites visibly, and of the candidates that do, how many stand above it: those that share more, or as much
    with a smaller number. Where it shares nothing itself, those of a greater number: with the candidates of a smaller
    number, that is all above it.

    Works that share something with a query are paired with it where they arrive, and not kept.
    """
    with packed(_cited(edges, room)) as cited:
        most = cited.agg(F.sum(F.size("by") * F.col("seen"))).first()[0] or 0
        shares = max(1, math.ceil(most / room))
        for n in range(shares):
            asked = edges.where(F.col("held").isNotNull() & (F.pmod(F.xxhash64("src"), F.lit(shares)) == n)).withColumnRenamed("src", "query")
            met = asked.where(~F.col("held")).select("query", "dst").join(cited.select("dst", "by"), "dst").select("query", F.inline("by").alias("node", "kind")).where("query <> node")
            theirs = asked.select("query", F.col("dst").alias("node"), F.col("its").alias("kind"), F.when(F.col("held"), 2).otherwise(1).alias("what"))
            rows = met.withColumn("what", F.lit(0)).unionByName(theirs).repartition("query")
            each = rows.groupBy("query", "node", "kind").agg(F.count_if(F.col("what") == 0).alias("n"), F.bool_or(F.col("what") == 1).alias("seen"), F.bool_or(F.col("what") == 2).alias("held"))
            w = Window.partitionBy("query", "field")
            placed = each.where("not seen").join(fields, "kind").select("field", "query", "node", "n", "held", F.row_number().over(w.orderBy(F.desc("n"), "node")).alias("pos"), F.count_if(F.col("n") > 0).over(w.orderBy(F.desc("node"))).alias("after"))
            yield placed.where("held").select("field", "query", "node", (F.col("n") > 0).alias("shares"), F.when(F.col("n") > 0, F.col("pos") - 1).otherwise(F.col("after")).alias("above"))


def _above(key: tuple, docs: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """How many of a block's works are ranked above each held-out work of a block's queries, by text and by references."""
    docs = docs.sort_values("node", kind="stable")
    nodes, empty = docs["node"].to_numpy(), pd.DataFrame({"query": [], "node": [], "text": [], "graph": []})
    q, gold, shared, seen = (asked[asked["kind"] == k] for k in range(4))
    if not len(q) or not len(gold) or not len(nodes):
        return empty
    q = q.sort_values("query", kind="stable")
    ids = q["query"].to_numpy()
    column = lambda x: np.searchsorted(ids, x["query"].to_numpy())
    terms = np.unique(np.concatenate([np.zeros(0, int), *q["i"]]).astype(int))
    weight = np.zeros((len(terms) + 1, len(ids)))  # the last row is for words that no query has
    for c, (i, w) in enumerate(zip(q["i"], q["w"], strict=True)):
        weight[np.searchsorted(terms, i), c] = w

    def flat(x: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = x["i"].map(len).to_numpy()
        i, w = np.concatenate([np.zeros(0, int), *x["i"]]).astype(int), np.concatenate([np.zeros(0), *x["w"]])
        at = np.minimum(np.searchsorted(terms, i), max(0, len(terms) - 1))
        return np.where(terms[at] == i, at, len(terms)) if len(terms) else np.zeros(len(i), int), w, np.repeat(np.arange(len(x)), size)

    def summed(part: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, part.shape[1]))
        if len(owner):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            out[owner[starts]] = np.add.reduceat(part, starts, axis=0)
        return np.rint(out * 1e6)

    gc, gt = column(gold), flat(gold)
    text = summed((gt[1] * weight[gt[0], gc[gt[2]]])[:, None], gt[2], len(gold))[:, 0]
    graph, before = gold["n"].to_numpy(float), np.searchsorted(nodes, gold["node"].to_numpy())
    order = np.argsort(gc, kind="stable")
    first = np.searchsorted(gc[order], np.arange(len(ids) + 1))

    def place(x: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the work stands in the block, the query's column, and the number; each pair once."""
        at, c = np.searchsorted(nodes, x["node"].to_numpy()), column(x)
        pair, k = np.unique(at * len(ids) + c, return_index=True)
        return pair // len(ids), pair % len(ids), x["n"].to_numpy(float)[k]

    def ranked(at: np.ndarray, c: np.ndarray, score: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Of works that have these scores for these queries, how many stand above each held-out one."""
        size = first[c + 1] - first[c]
        x = np.repeat(np.arange(len(c)), size)
        y = order[np.arange(len(x)) - np.repeat(np.cumsum(size) - size - first[c], size)]
        return np.bincount(y[(score[x] > least[y]) | ((score[x] == least[y]) & (at[x] < before[y]))], minlength=len(gold))

    met, out = place(shared), place(seen)
    hidden = np.isin(met[0] * len(ids) + met[1], out[0] * len(ids) + out[1])
    met, none = tuple(m[~hidden] for m in met), lambda x: np.zeros(len(x[0]))
    counts = np.zeros((2, len(gold)), np.int64)
    # Most works share nothing with a query and stand in the order of their numbers.
    counts[1] = np.where(graph == 0, before, 0) - ranked(*out[:2], none(out), graph) - ranked(*met[:2], none(met), graph) + ranked(*met, graph)
    i, w, owner = flat(docs.iloc[out[0]])
    counts[0] = -ranked(*out[:2], summed((w * weight[i, out[1][owner]])[:, None], owner, len(out[0]))[:, 0], text)
    u = docs["u"].to_numpy() if "u" in docs else pd.factorize(pd.Series([(np.asarray(a).tobytes(), np.asarray(b).tobytes()) for a, b in zip(docs["i"], docs["w"], strict=True)]))[0]
    size = np.bincount(u)
    by_text = np.argsort(u, kind="stable")
    start = np.cumsum(size) - size
    alone, alike = np.flatnonzero(size[u] < ALIKE), np.flatnonzero(size >= ALIKE)
    line = u[by_text] * len(nodes) + by_text  # ascending
    for at in (alone, by_text[start[alike]]):
        for lo in range(0, len(at), ROWS):
            here = at[lo : lo + ROWS]
            i, w, owner = flat(docs.iloc[here])
            s = summed(w[:, None] * weight[i], owner, len(here))[:, gc]
            if at is alone:
                counts[0] += (s > text).sum(0) + ((s == text) & (here[:, None] < before)).sum(0)
            else:
                counts[0] += size[u[here]] @ (s > text)
                x, y = np.nonzero(s == text)
                k = u[here][x]
                counts[0] += np.bincount(y, np.searchsorted(line, k * len(nodes) + before[y]) - start[k], len(gold)).astype(np.int64)
    return pd.DataFrame({"query": gold["query"].to_numpy(), "node": gold["node"].to_numpy(), "text": counts[0], "graph": counts[1]})


def _ranked(g: Graph, works: DataFrame, edges: DataFrame, nth: int = NTH) -> DataFrame:
    """``_evaluated`` with all references within fields at hand."""
    of, kinds = _kinds(g, works)
    told = edges.join(of.withColumnRenamed("node", "src"), "src").join(of.select(F.col("node").alias("dst"), F.col("kind").alias("its")), "dst")
    split = cut(_split(told.select("field", "src", "dst", "kind", "its"), nth))
    met = reduce(DataFrame.unionByName, [cut(x) for x in _met(split, _fields_of(g, kinds), LEAST_ROWS)])
    return _evaluated(g, works, split, met)


def _evaluated(g: Graph, works: DataFrame, edges: DataFrame, met: DataFrame) -> DataFrame:
    """``(field, query, method, ap)``: average precision of the held-out references over all works of the field.

    Every work of a query's field is scored, but only the places of held-out works are wanted, so scores aren't written:
    a block of works, each text once, meets a block of queries, and gives how many works stand above each held-out one.
    By references most works stand in the order of their numbers, and ``met`` has what the others change.
    """
    split = edges.where("held is not null").withColumnRenamed("src", "query")
    queries = split.select("field", "query").distinct()
    _, docs = ranking._indexed(ranking.tfidf(g.raw("part").select(F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("text"))))
    vector = docs.select(F.col("doc_id").alias("node"), "i", "w")
    seen = split.where("not held").select("query", "dst")
    most = lambda x: x.groupBy("field").count().agg(F.max("count")).first()[0] or 1
    nq, nd = -(-most(queries) // QUERIES_A_BLOCK), -(-most(works) // WORKS_AT_ONCE)
    qb, db = (F.pmod(F.xxhash64(c), F.lit(n)).cast("int") for c, n in (("query", nq), ("node", nd)))
    over = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    ints, doubles = F.array().cast("array<int>"), F.array().cast("array<double>")
    bare = [F.coalesce("i", ints).alias("i"), F.coalesce("w", doubles).alias("w")]
    theirs = lambda x: x.join(queries, "query").join(works, ["field", "node"])
    gold = theirs(split.where("held").select("query", F.col("dst").alias("node"))).join(vector, "node", "left")
    own = queries.select("query").distinct().select("query", F.col("query").alias("node"))
    parts = [
        queries.withColumn("node", F.col("query")).join(vector, "node", "left").select("field", qb.alias("qb"), over(nd).alias("db"), F.lit(0).alias("kind"), "query", "node", *bare, F.lit(0.0).alias("n")),
        gold.select("field", qb.alias("qb"), over(nd).alias("db"), F.lit(1), "query", "node", *bare, F.lit(0.0)),
        theirs(seen.withColumnRenamed("dst", "node").unionByName(own).distinct()).select("field", qb.alias("qb"), db.alias("db"), F.lit(3), "query", "node", ints, doubles, F.lit(0.0)),
    ]
    texts = works.join(vector, "node", "left").groupBy("field", db.alias("db"), *bare).agg(F.collect_list("node").alias("nodes"))
    held = texts.select("field", over(nq).alias("qb"), "db", "nodes", "i", "w")
    keys = ["field", "qb", "db"]

    def run(key: tuple, texts: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query": [], "node": [], "text": [], "graph": []})]
        if len(texts) and len(asked):
            u = np.repeat(np.arange(len(texts)), texts["nodes"].map(len))
            docs = pd.DataFrame({"node": np.concatenate(list(texts["nodes"])), "i": texts["i"].to_numpy()[u], "w": texts["w"].to_numpy()[u], "u": u}).sort_values("node", kind="stable")
            asked = asked.sort_values("query", kind="stable")
            ids = np.unique(asked["query"])
            at = np.searchsorted(asked["query"], [*ids[::QUERIES_AT_ONCE], ids[-1] + 1])
            out += [_above(key, docs, asked.iloc[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        return pd.concat(out, ignore_index=True).assign(field=key[0])[["field", "query", "node", "text", "graph"]]

    tasks = max(g.spark.sparkContext.defaultParallelism, 4 * nq * nd)  # blocks are small but dear to work on: they aren't packed together
    above = held.repartition(tasks, *keys).groupBy(*keys).cogroup(reduce(DataFrame.union, parts).repartition(tasks, *keys).groupBy(*keys)).applyInPandas(run, "field string, query long, node long, text long, graph long")
    place = above.groupBy("field", "query", "node").agg(F.sum("text").alias("text"), F.sum("graph").alias("least")).join(met, ["field", "query", "node"], "left")
    graph = F.coalesce("above", F.lit(0)) + F.when(F.coalesce("shares", F.lit(False)), 0).otherwise(F.col("least"))
    both = place.withColumn("graph", graph).select("field", "query", F.explode(F.array(*[F.struct(F.lit(m).alias("method"), (F.col(m) + 1).alias("pos")) for m in ("text", "graph")])).alias("s")).select("field", "query", "s.*")
    nth = both.withColumn("nth", F.row_number().over(Window.partitionBy("field", "query", "method").orderBy("pos")))
    return nth.groupBy("field", "query", "method").agg(F.avg(F.col("nth") / F.col("pos")).alias("ap"))


def _gini(df: DataFrame, value: str) -> DataFrame:
    """``(field, gini)``; values are few per field, so they are counted first."""
    c = df.groupBy("field", F.col(value).alias("x")).agg(F.count("*").alias("w"))
    before = F.coalesce(F.sum("w").over(Window.partitionBy("field").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    a = c.withColumn("before", before).groupBy("field").agg(F.sum("w").alias("n"), F.sum(F.col("x") * F.col("w")).alias("s"), F.sum(F.col("x") * F.col("w") * (2 * F.col("before") + F.col("w"))).alias("t"))
    return a.select("field", F.round(F.try_divide(F.col("t") - F.col("n") * F.col("s"), F.col("n") * F.col("s")), 6).alias("citation_gini"))


def analyze(g: Graph, works: DataFrame, draws: int = 500, nth: int = NTH) -> DataFrame:
    """A row per field of ``works``: size, references, concentration, both methods' mean average precision, their
    difference, how often it falls to zero or below over resampled queries, and which wins. Fields of fewer than LEAST
    queries have no evaluation. Queries are the works whose number is divisible by ``nth``: with 1 all works."""
    works = cut(works)
    cited = works.join(g.work.select(F.col("atlas_id").alias("node"), "cited_by_count"), "node")
    size = cited.groupBy("field").agg(F.count("*").alias("works"), F.median("cited_by_count").alias("median_cited_by"), F.max("cited_by_count").alias("max_cited_by"))
    with _references(g, works, nth) as (raw, within, edges, met):
        raw, within = cut(raw), cut(within)
        wide = cut(_evaluated(g, works, edges, met).groupBy("field", "query").agg(F.max(F.when(F.col("method") == "text", F.col("ap"))).alias("text"), F.max(F.when(F.col("method") == "graph", F.col("ap"))).alias("graph")).withColumn("diff", F.col("text") - F.col("graph")))
    mean = wide.groupBy("field").agg(F.count("*").alias("queries"), F.avg("text").alias("map_text"), F.avg("graph").alias("map_graph"), F.avg("diff").alias("delta")).where(F.col("queries") >= LEAST)
    p = resampled(wide, F.col("query"), draws, 5).groupBy("field", "b").agg((F.sum(F.col("diff") * F.col("w")) / F.sum("w")).alias("m")).groupBy("field").agg(F.round(F.avg((F.col("m") <= 0).cast("double")), 6).alias("p"))
    r = lambda c: F.round(c, 6).alias(c)
    out = size.join(raw, "field", "left").join(within, "field", "left").join(_gini(cited, "cited_by_count"), "field", "left").join(mean.join(p, "field"), "field", "left")
    return out.select("field", "works", "median_cited_by", "max_cited_by", F.coalesce("out_refs", F.lit(0)).alias("out_refs"), F.coalesce("edges_in_corpus", F.lit(0)).alias("edges_in_corpus"), "citation_gini", "queries", r("map_text"), r("map_graph"), r("delta"), "p", (F.col("delta") > 0).alias("text_wins"))


def analyze_fields(s: SparkSession, d: str) -> DataFrame:
    g = Graph(s, d)
    return analyze(g, _works(g))


def generalisation(fields: DataFrame) -> DataFrame:
    """One row: in how many fields text beats references, a sign test, the mean difference with its interval and two-sided
    p over resampled fields, and the range of concentration."""
    e = fields.where("delta is not null")
    counts = e.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("text_wins").cast("long")), F.lit(0)).alias("wins"), F.round(F.avg("delta"), 6).alias("mean_delta"))
    draws = resampled(e, F.col("field"), 2000, 9).groupBy("b").agg((F.sum(F.col("delta") * F.col("w")) / F.sum("w")).alias("m")).crossJoin(e.agg(F.avg("delta").alias("obs")))
    boot = draws.agg(F.round(F.percentile("m", 0.025), 6).alias("lo"), F.round(F.percentile("m", 0.975), 6).alias("hi"), F.round(F.avg((F.abs(F.col("m") - F.col("obs")) >= F.abs("obs")).cast("double")), 6).alias("p"))
    span = fields.agg(F.min("citation_gini").alias("least_gini"), F.max("citation_gini").alias("most_gini"))
    c = counts.first()  # one row
    return counts.withColumn("sign_p", F.lit(round(sign_p(c.wins, c.n), 6))).crossJoin(boot).crossJoin(span)


def crossfield(s: SparkSession, d: str) -> DataFrame:
    """Every work with five references or more within its field is a query."""
    g = Graph(s, d)
    return generalisation(cut(analyze(g, _works(g), nth=1)))


def run_tranches(s: SparkSession, d: str, out: str, tranches: tuple[int, ...] = (30, 100, 400)) -> DataFrame:
    """Analyses of the most cited works per field, in growing tranches, a table and a line in the log per checkpoint.

    A tranche that the log names is not computed again, so a run that was broken off goes on where it stopped; the table
    is written before the line. Result: the rows of all tranches.
    """
    g = Graph(s, d)
    ranked = _works(g).join(g.work.select(F.col("atlas_id").alias("node"), "cited_by_count"), "node").withColumn("rn", F.row_number().over(Window.partitionBy("field").orderBy(F.desc("cited_by_count"), "node")))
    done = {x["tranche"] for x in sinks.read_jsonl(f"{out}/log.jsonl")}
    for n in tranches:
        if n not in done:
            rows = analyze(g, ranked.where(F.col("rn") <= n).select("node", "field"))
            rows.select(F.lit(n).alias("tranche"), "*").write.mode("overwrite").parquet(f"{out}/tranche={n}")
            part = s.read.parquet(f"{out}/tranche={n}")
            sinks.append_jsonl(f"{out}/log.jsonl", {"tranche": n, "fields": part.count(), "wins": part.where("text_wins").count()})
    return s.read.parquet(*[f"{out}/tranche={n}" for n in tranches])


QUERIES = {f.__name__: f for f in (analyze_fields, crossfield)}

_TOK = r"regexp_extract_all(lower(p_name), '[a-z][a-z0-9\-]+')"
_FIELDS = lambda only: rf"""ff AS (SELECT wf.src_id AS node, dom AS field FROM work_field wf JOIN climb ON topic = wf.dst_id), ee AS (SELECT a.field, src, dst FROM citation JOIN ff a ON a.node = src JOIN ff b ON b.node = dst WHERE a.field = b.field),
  sp AS (SELECT field, src AS query, dst, rn <= greatest(1, round_even(n * 0.3, 0)) AS held FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY md5('0:' || src || ':' || dst), dst) AS rn, count(*) OVER (PARTITION BY src) AS n FROM ee{only}) WHERE n >= 5),
  qq AS (SELECT DISTINCT field, query FROM sp), ca AS (SELECT qq.field, query, node FROM qq JOIN ff ON ff.field = qq.field AND node <> query WHERE NOT EXISTS (SELECT 1 FROM sp WHERE sp.query = qq.query AND sp.dst = node AND NOT held)),
  tf AS (SELECT p_partkey AS doc, term, count(*) AS tf FROM (SELECT p_partkey, unnest({_TOK}) AS term FROM part) GROUP BY 1, 2), vo AS (SELECT term, ln((1 + (SELECT count(*) FROM part)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY 1 HAVING count(*) >= 2 ORDER BY count(*) DESC, term LIMIT 20000),
  xx AS (SELECT doc, term, tf * idf AS w FROM tf JOIN vo USING (term)), nn AS (SELECT doc, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS w FROM xx),
  te AS (SELECT a.doc AS query, b.doc AS node, round(sum(a.w * b.w), 6) AS score FROM nn a JOIN nn b USING (term) WHERE a.doc IN (SELECT query FROM qq) GROUP BY 1, 2), sh AS (SELECT sp.query, e.src AS node, count(*)::DOUBLE AS score FROM sp JOIN ee e ON e.dst = sp.dst WHERE NOT held AND e.src <> sp.query GROUP BY 1, 2),
  rk AS (SELECT *, row_number() OVER (PARTITION BY query, method ORDER BY score DESC, node) AS pos FROM (SELECT ca.*, 'text' AS method, coalesce(score, 0) AS score FROM ca LEFT JOIN te USING (query, node) UNION ALL SELECT ca.*, 'graph', coalesce(score, 0) FROM ca LEFT JOIN sh USING (query, node))),
  ap AS (SELECT field, query, avg(nth / pos) FILTER (WHERE method = 'text') AS text, avg(nth / pos) FILTER (WHERE method = 'graph') AS graph, avg(nth / pos) FILTER (WHERE method = 'text') - avg(nth / pos) FILTER (WHERE method = 'graph') AS diff
    FROM (SELECT rk.*, row_number() OVER (PARTITION BY rk.query, method ORDER BY pos) AS nth FROM rk JOIN sp ON sp.query = rk.query AND sp.dst = rk.node AND held) GROUP BY 1, 2),
  me AS (SELECT field, count(*) AS queries, avg(text) AS map_text, avg(graph) AS map_graph, avg(diff) AS delta FROM ap GROUP BY 1 HAVING queries >= {LEAST}), pp AS (SELECT field, round(avg((m <= 0)::INT), 6) AS p FROM (SELECT field, b, sum(diff * w) / sum(w) AS m FROM {resampled_sql("ap", "query", 500, 5)} GROUP BY 1, 2) GROUP BY 1),
  ci AS (SELECT field, cited_by_count AS x, row_number() OVER (PARTITION BY field ORDER BY cited_by_count, node) AS i, count(*) OVER (PARTITION BY field) AS n FROM ff JOIN work ON atlas_id = node),
  af AS (SELECT field, works, median_cited_by, max_cited_by, coalesce(out_refs, 0) AS out_refs, coalesce(edges, 0) AS edges_in_corpus, citation_gini, queries, round(map_text, 6) AS map_text, round(map_graph, 6) AS map_graph, round(delta, 6) AS delta, p, delta > 0 AS text_wins
    FROM (SELECT field, count(*) AS works, median(x) AS median_cited_by, max(x) AS max_cited_by, round(sum((2 * i - n - 1) * x) / (max(n) * sum(x)), 6) AS citation_gini FROM ci GROUP BY 1) LEFT JOIN (SELECT field, count(*) AS out_refs FROM citation JOIN ff ON node = src GROUP BY 1) USING (field) LEFT JOIN (SELECT field, count(*) AS edges FROM ee GROUP BY 1) USING (field) LEFT JOIN (me JOIN pp USING (field)) USING (field))"""  # noqa: E731
_SQL = {
    "analyze_fields": f"WITH {_FIELDS(' WHERE src % 50 = 0')} SELECT * FROM af",
    "crossfield": f"""WITH {_FIELDS('')}, ev AS (SELECT * FROM af WHERE delta IS NOT NULL), dr AS (SELECT b, sum(delta * w) / sum(w) AS m FROM {resampled_sql("ev", "field", 2000, 9)} GROUP BY 1)
      SELECT n, wins, mean_delta, round(least(1, 2 * (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) - n * ln(2))) FROM range(0, 1 + least(wins, n - wins)) t(i))), 6) AS sign_p, lo, hi, p, least_gini, most_gini FROM (SELECT count(*) AS n, count(*) FILTER (WHERE text_wins) AS wins, round(avg(delta), 6) AS mean_delta FROM ev),
        (SELECT round(quantile_cont(m, 0.025), 6) AS lo, round(quantile_cont(m, 0.975), 6) AS hi, round(avg((abs(m - obs) >= abs(obs))::INT), 6) AS p FROM dr, (SELECT avg(delta) AS obs FROM ev)), (SELECT min(citation_gini) AS least_gini, max(citation_gini) AS most_gini FROM af)""",
}
ORACLES = {k: with_views(v) for k, v in _SQL.items()}
