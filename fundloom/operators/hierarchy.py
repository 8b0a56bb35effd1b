"""Parent-child rows to full hierarchies, with circles told, in a number of rounds that grows with the logarithm.

1. Leaves are peeled until only circles are left. A plain peel takes one round per level; here round ``k`` peels
   ``2**k`` levels at once, by following ``parent`` composed with itself.
2. Circle nodes are cut loose from their parents, which leaves a forest. Its Euler tour has an entry and an exit
   element per node and a successor for each; the tour is ranked by pointer doubling (parallel list ranking).
3. Position and running weight of entry and exit give depth, root, subtree size and ancestor tests.
4. Paths, ancestors and descendants come from the entry-exit intervals: a sweep over sorted entries keeps the intervals
   that are open, which are the ancestors. A tree is swept in blocks of entries, each of which is given the intervals
   that are open where it begins, so a tree that holds most nodes is many tasks.

Joins in the list ranking are one to one (a successor is named by one element only), so a node with a third of all
children is no hot key there. Its children are chained through salted buckets, and it is looked up by broadcast where
children ask for their parent. Leaves leave before the peel joins anything; a parent that many inner nodes share is left
to the adaptive join there.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundloom.functions.instants import micros
from fundloom.operators.skew import skew_safe_join
from fundloom.session import cut

SALTS = 256


def current_parents(field: DataFrame) -> DataFrame:
    """One row per atlas_id, of its latest as_of: ``(v, parent)``; parent is null unless it is in the table.

    Among rows of the same instant the one with the greatest parent text counts; a row without a readable as_of is
    older than any other. Rows without atlas_id take no part. A node that names itself is a circle of one.
    """
    latest = F.struct(F.coalesce(micros(F.col("as_of")), F.lit(-(2**62))), F.coalesce(F.col("parent_atlas_id"), F.lit("")))
    one = field.where("atlas_id is not null").select(F.col("atlas_id").alias("v"), latest.alias("x")).groupBy("v").agg(F.max("x").alias("x")).select("v", F.col("x.col2").alias("p"))
    one = cut(one)
    named = skew_safe_join(one.where("p <> ''"), one.select(F.col("v").alias("p"), F.col("v").alias("parent")), "p").select("v", "parent")
    return named.unionByName(one.where("p = ''").select("v", F.lit(None).cast("string").alias("parent")))


def circle_nodes(parents: DataFrame) -> DataFrame:
    """Nodes on circles, ``(v, parent)``, by peeling leaves in layers of doubling thickness.

    ``f`` leads ``2**k`` steps up. The values that ``f`` takes are the nodes that still have something ``2**k`` levels
    below: all others are peeled. When a round peels nothing, ``f`` permutes what is left, which then is circles only.
    """
    f = parents.where("parent is not null").select("v", F.col("parent").alias("u"))
    f = cut(f)
    n = f.count()
    while n:
        kept = f.select(F.col("u").alias("v")).distinct()
        f2 = f.join(kept, "v", "left_semi")
        f = cut(f2.alias("a").join(f.select(F.col("v").alias("u"), F.col("u").alias("w")), "u").select("v", F.col("w").alias("u")))
        m = f.count()
        if m == n:
            break
        n = m
    return parents.join(f.select("v"), "v", "left_semi")


def circle_names(circles: DataFrame) -> DataFrame:
    """``(v, least)``: the smallest id of the circle that ``v`` lies on; doubling along the circle, one to one."""
    state = cut(circles.select("v", F.col("parent").alias("u"), F.col("v").alias("least")))
    size = state.count()
    steps = 1
    while steps < size:
        nxt = state.select(F.col("v").alias("u"), F.col("u").alias("u2"), F.col("least").alias("least2"))
        state = cut(state.join(nxt, "u").select("v", F.col("u2").alias("u"), F.least("least", "least2").alias("least")))
        steps *= 2
    return state.select("v", "least")


def euler_tour(forest: DataFrame) -> DataFrame:
    """Tour elements ``(v, out, nv, nout)``: entry (out false) or exit of ``v`` and the element after it, null at the end.

    Children of one parent are chained bucket by bucket; any order makes a valid tour, so no window sees more than a
    bucket's share of a hot parent's children.
    """
    child = forest.where("parent is not null").withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    within = child.withColumn("sib", F.lead("v").over(Window.partitionBy("parent", "s").orderBy("v")))
    heads = child.groupBy("parent", "s").agg(F.min("v").alias("head"))
    heads = heads.withColumn("after", F.lead("head").over(Window.partitionBy("parent").orderBy("s")))
    first = heads.groupBy("parent").agg(F.min_by("head", "s").alias("first"))
    chained = within.join(heads.select("parent", "s", "after"), ["parent", "s"]).select("v", "parent", F.coalesce("sib", "after").alias("sib"))
    nodes = forest.join(chained.select("v", "sib"), "v", "left").join(first.select(F.col("parent").alias("v"), "first"), "v", "left")
    enter = nodes.select("v", F.lit(False).alias("out"), F.coalesce("first", "v").alias("nv"), F.col("first").isNull().alias("nout"))
    leave = nodes.select("v", F.lit(True).alias("out"), F.coalesce("sib", "parent").alias("nv"), F.when(F.coalesce("sib", "parent").isNotNull(), F.col("sib").isNull()).alias("nout"))
    return enter.unionByName(leave)


def rank_tour(tour: DataFrame, names: DataFrame) -> DataFrame:
    """``(v, out, dist, weight, root, least)``: elements from here to the end of the list, the sum of +1 per entry and -1
    per exit on that way, the node whose exit ends it, and what ``names`` (v, least) says of that node.

    Pointer doubling. Names are joined to the last elements only, one per tree, and travel with the ranks, so no join
    ever meets a large tree's root as a key. Lists that are finished stay out of the joins but for being looked up.
    """
    weight = F.when(F.col("out"), F.lit(-1)).otherwise(F.lit(1)).cast("long")
    tour = tour.select("v", "out", "nv", "nout", F.lit(1).cast("long").alias("dist"), weight.alias("weight"))
    last = tour.where("nv is null").join(names, "v", "left").select("*", F.col("v").alias("root"))
    state = cut(last.unionByName(tour.where("nv is not null").select("*", F.lit(None).cast("string").alias("least"), F.lit(None).cast("string").alias("root"))))
    while not state.where("nv is not null").isEmpty():
        nxt = state.select(F.col("v").alias("nv"), F.col("out").alias("nout"), F.col("nv").alias("nv2"), F.col("nout").alias("nout2"), F.col("dist").alias("d2"), F.col("weight").alias("w2"), F.col("root").alias("root2"), F.col("least").alias("least2"))
        moved = state.where("nv is not null").drop("root", "least").join(nxt, ["nv", "nout"]).select(
            "v", "out", F.col("nv2").alias("nv"), F.col("nout2").alias("nout"), (F.col("dist") + F.col("d2")).alias("dist"), (F.col("weight") + F.col("w2")).alias("weight"), F.col("least2").alias("least"), F.col("root2").alias("root"),
        )
        state = cut(state.where("nv is null").select(*moved.columns).unionByName(moved))
    return state.drop("nv", "nout")


def hierarchy(field: DataFrame) -> DataFrame:
    """Every node of ``field`` once: ``(atlas_id, parent, root_atlas_id, depth, entry, exit, tree, below, circular)``.

    A field whose parent is null, empty or not in the table is a root of depth 0. A field that never reaches a root is
    circular: depth -1, root the smallest id of the circle it lies on or runs into. Within one tree ``a`` is an ancestor
    of ``b`` exactly when ``a.entry < b.entry and b.exit < a.exit``; ``tree`` is the root of a node's tour, a node on the
    circle for circular ones. ``below`` counts the fields below, along the circle for circular ones only the tree that
    hangs on them. Empty input gives no rows; further columns of ``field`` are ignored.
    """
    parents = cut(current_parents(field))
    circles = cut(circle_nodes(parents))
    on = circles.select("v", F.lit(True).alias("circle"))
    forest = cut(parents.join(on, "v", "left").select("v", F.when(F.col("circle").isNull(), F.col("parent")).alias("parent")))
    ranked = rank_tour(euler_tour(forest), circle_names(circles))
    at = ranked.where("not out").select("v", F.col("dist").alias("enter_dist"), "weight", "root", "least")
    end = ranked.where("out").select("v", F.col("dist").alias("exit_dist"))
    depth = F.when(F.col("least").isNull(), -F.col("weight")).otherwise(F.lit(-1).cast("long"))
    return at.join(end, "v").join(parents, "v").select(
        F.col("v").alias("atlas_id"), "parent", F.coalesce("least", "root").alias("root_atlas_id"), depth.alias("depth"),
        (-F.col("enter_dist")).alias("entry"), (-F.col("exit_dist")).alias("exit"), F.col("root").alias("tree"),
        ((F.col("enter_dist") - F.col("exit_dist") - 1) / 2).cast("long").alias("below"), F.col("least").isNotNull().alias("circular"),
    )


def _sweep(rows: pd.DataFrame) -> pd.DataFrame:
    """Paths of a block's own nodes; ``own`` is false for the intervals that are open where the block begins."""
    rows = rows.sort_values(["tree", "entry"], kind="stable")
    ids, found = [], []
    now, names, ends = None, [], []
    for tree, node, entry, end, own in zip(rows["tree"], rows["atlas_id"], rows["entry"], rows["exit"], rows["own"], strict=True):
        if tree != now:
            now, names, ends = tree, [], []
        while ends and ends[-1] < entry:
            ends.pop()
            names.pop()
        ends.append(end)
        names.append(node)
        if own:
            ids.append(node)
            found.append(list(names))
    return pd.DataFrame({"atlas_id": pd.Series(ids, dtype=object), "path": pd.Series(found, dtype=object)})


def paths(nodes: DataFrame, block: int = 50_000) -> DataFrame:
    """``(atlas_id, path)`` of a ``hierarchy``: ids from the root (or from the circle's node that was met first) down to
    the node itself.

    A task sweeps ``block`` positions of a tour, or several small trees, and holds one path at a time beside its result.
    Paths are as long as nodes are deep, so the result is as large as the sum of depths.
    """
    some = max(1, 2 * nodes.count() // block)
    at = lambda c: F.floor(c / block)
    x = nodes.select("tree", "atlas_id", "entry", "exit")
    own = x.withColumn("b", at(F.col("entry"))).withColumn("own", F.lit(True))
    first, last = at(F.col("entry")) + 1, at(F.col("exit") - 1)
    over = x.where(first <= last).withColumn("b", F.explode(F.sequence(first, last))).withColumn("own", F.lit(False))
    bucket = F.pmod(F.xxhash64("tree"), F.lit(some))
    return own.unionByName(over).groupBy(bucket.alias("k"), "b").applyInPandas(lambda rows: _sweep(rows), "atlas_id string, path array<string>")


def closure(nodes: DataFrame) -> DataFrame:
    """``(ancestor, descendant, distance)`` of a ``hierarchy``: every field and all fields below it."""
    p = paths(nodes)
    return p.select(F.col("atlas_id").alias("descendant"), F.size("path").alias("n"), F.posexplode("path").alias("i", "ancestor")).where("i < n - 1").select("ancestor", "descendant", (F.col("n") - 1 - F.col("i")).cast("long").alias("distance"))
