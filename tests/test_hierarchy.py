import random

from conftest import rows

from fundloom.operators.components import components
from fundloom.operators.hierarchy import closure, hierarchy, paths

DDL = "atlas_id string, parent_atlas_id string, as_of string, level string, v string, depth long"


def frame(spark, parent, extra=()):
    at = "2024-01-01T00:00:00Z"
    return spark.createDataFrame([(k, p, at, None, "clash", 9) for k, p in parent.items()] + [(*e, None, None, None) for e in extra], DDL)


def brute(parent):
    out = {}
    for k in parent:
        seen, x = [], k
        while x not in seen and parent.get(x) in parent:
            seen.append(x)
            x = parent[x]
        out[k] = (min(seen[seen.index(x):]), -1) if x in seen else (x, len(seen))
    return out


def test_against_walking(spark):
    rnd = random.Random(3)
    for n in (1, 7, 60):
        parent = {f"f{i:02}": rnd.choice([None, "", "gone", *[f"f{rnd.randrange(n):02}" for _ in range(5)]]) for i in range(n)}
        parent |= {f"c{i:02}": f"c{i - 1:02}" if i else None for i in range(45)}  # a deep chain
        got = {a: (r, d) for a, r, d in rows(hierarchy(frame(spark, parent)), "atlas_id", "root_atlas_id", "depth")}
        assert got == brute(parent)


def test_intervals_paths_and_closure(spark):
    parent = {"a": None, "b": "a", "c": "a", "d": "b", "e": "d", "x": "y", "y": "x", "z": "x", "s": "s"}
    h = {r.atlas_id: r for r in hierarchy(frame(spark, parent)).collect()}
    tree = "abcde"
    up = {k: {j for j in tree if h[j].entry < h[k].entry and h[k].exit < h[j].exit} for k in tree}
    assert up == {"a": set(), "b": {"a"}, "c": {"a"}, "d": {"a", "b"}, "e": {"a", "b", "d"}}
    assert {k: h[k].below for k in tree} == {"a": 4, "b": 2, "c": 0, "d": 1, "e": 0}
    assert (h["z"].root_atlas_id, h["z"].depth, h["s"].root_atlas_id, h["s"].depth) == ("x", -1, "s", -1)
    assert dict(rows(paths(hierarchy(frame(spark, parent)))))["e"] == ["a", "b", "d", "e"]
    assert {r[:2] for r in rows(closure(hierarchy(frame(spark, parent))))} == {("a", "b"), ("a", "c"), ("a", "d"), ("a", "e"), ("b", "d"), ("b", "e"), ("d", "e"), ("x", "z")}


def test_paths_by_blocks(spark):
    """Trees that span many blocks, and many that share one, give the paths that walking up gives."""
    rnd = random.Random(6)
    parent = {f"f{i:03}": f"f{rnd.randrange(max(0, i - 6), i):03}" if i else None for i in range(120)} | {f"s{i:03}": "f000" if i < 60 else None for i in range(80)} | {f"c{i}": f"c{(i + 1) % 3}" for i in range(3)} | {"d0": "c1", "d1": "d0"}
    nodes = hierarchy(frame(spark, parent)).cache()

    def up(k):
        out, x = [k], k
        while x[0] != "c" and parent[x] is not None:
            x = parent[x]
            out.append(x)
        return out[::-1]

    for block in (7, 50_000):
        assert dict(rows(paths(nodes, block))) == {k: up(k) for k in parent}
    want = {(a, k, len(up(k)) - 1 - i) for k in parent for i, a in enumerate(up(k)[:-1])}
    assert set(rows(closure(nodes), "ancestor", "descendant", "distance")) == want


def test_latest_row_counts_and_edges(spark):
    f = frame(spark, {"a": None}, [("b", "a", "2024-01-01T10:00:00+05:30"), ("b", None, "2024-01-01T04:00:00Z"), ("c", "b", None), (None, "a", None)])
    assert {a: d for a, d in rows(hierarchy(f), "atlas_id", "depth")} == {"a": 0, "b": 1, "c": 2}
    assert rows(hierarchy(f.limit(0))) == [] and rows(closure(hierarchy(f.limit(0)))) == []


def test_star(spark):
    f = frame(spark, {"r": None} | {f"k{i:04}": "r" for i in range(600)})
    h = hierarchy(f).collect()
    assert sorted((r.depth, r.below) for r in h) == [(0, 600)] + [(1, 0)] * 600


def test_components(spark):
    rnd = random.Random(5)
    edges = [(f"n{rnd.randrange(80):02}", f"n{rnd.randrange(80):02}") for _ in range(60)] + [(f"p{i:02}", f"p{i + 1:02}") for i in range(30)] + [("x", None)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if b and a != b:
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    want = {x: find(x) for x in root}
    assert dict(rows(components(spark.createDataFrame(edges, "a string, b string")))) == want
