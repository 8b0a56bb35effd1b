"""Pairs of funders: counted and compared without being shuffled."""

import itertools
import os
import random
from collections import Counter, defaultdict

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from fundloom.operators.pairs import met_in_blocks
from fundloom.plans import named, studies

ROOT = "/root/testdata/sf0.001"


class Lines:
    """A graph of a few lines (order, work, funder)."""

    def __init__(self, spark, *lines):
        self.line = spark.createDataFrame(list(lines), "l_orderkey long, l_partkey long, l_suppkey long")


def test_funders_of_works(spark):
    g = Lines(spark, (1, 10, 5), (1, 10, 5), (1, 11, None), (2, 10, 6), (2, None, 7), (None, 10, 8), (3, 12, None), (3, 12, None))
    got = {r.work_id: sorted(r.funders, key=str) for r in named._funders_of_works(g).collect()}
    assert got == {10: [5, 6, 7, None], 11: [5, None], 12: [None]}


def test_every_pair_meets_once(spark):
    def run(a, b):
        return pd.DataFrame([(x, y) for x, y in itertools.product(a["k"], b["k"])], columns=["a", "b"]).astype("int64")

    got = rows(met_in_blocks(spark.range(23).withColumnRenamed("id", "k"), "k", run, "a long, b long", block=5))
    assert got == sorted(itertools.product(range(23), repeat=2))
    assert rows(met_in_blocks(spark.range(0).withColumnRenamed("id", "k"), "k", run, "a long, b long")) == []


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")
def test_pairs_of_funders_are_not_shuffled(spark):
    plan = studies.funder_cosine(spark, ROOT)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")
def test_co_funding_joins_no_lines(spark):
    plan = named.QUERIES["cofunding_pairs"](spark, ROOT)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") and plan.count("Join") <= 4  # names and nations of the 25 pairs only


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")
def test_types_of_funders_are_summed_by_block(spark):
    plan = studies.cluster_cosine(spark, ROOT)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "FlatMapGroups" in plan


def test_co_funding_in_shares(spark, monkeypatch):
    """With a low limit no stage writes about as many rows as there are lines, and pairs come out as they do in one piece."""
    rng, n = random.Random(4), 6000
    lines = [(rng.randrange(n // 4) if rng.random() < 0.99 else None, rng.randrange(900) if rng.random() < 0.99 else None, rng.randrange(12) if rng.random() < 0.99 else None) for _ in range(n)]
    g = Lines(spark, *lines)
    g.spark, g.funder = spark, spark.range(12).select(F.col("id").alias("atlas_id"), F.concat(F.lit("F"), "id").alias("short_name"))
    g.line = g.line.repartition(4).localCheckpoint()
    shown = lambda: [tuple(r) for r in named.cofunding_pairs(g, 200).orderBy(F.desc("shared_works"), "funder_a", "funder_b").collect()]
    of, by = defaultdict(set), defaultdict(set)
    for grant, work, funder in lines:
        if grant is not None:
            of[grant].add(funder)
            by[work].add(grant)
    sets = [set().union(*(of[x] for x in grants)) - {None} for work, grants in by.items() if work is not None]
    count = Counter(p for s in sets for p in itertools.combinations(sorted(s), 2))
    want = sorted(((f"F{a}", f"F{b}", c) for (a, b), c in count.items()), key=lambda x: (-x[2], x[0], x[1]))
    assert shown() == want
    monkeypatch.setattr(named, "LEAST_ROWS", 500, raising=False)
    jvm, store = spark.sparkContext._jvm, spark.sparkContext._jsc.sc().statusStore()
    stages = lambda: {x.stageId(): x.shuffleWriteRecords() for x in jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList()))}
    before = stages()
    assert shown() == want
    assert max(x for k, x in stages().items() if k not in before) <= 0.5 * n
