"""Parameters of the public queries, and what they do with bad ones."""

import os

import pytest

from fundloom.plans import named, people
from fundloom.plans.graph import Graph

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.fixture(scope="module")
def g(spark):
    return Graph(spark, ROOT)


def test_clamps():
    assert [named.clamp_limit(n) for n in (None, 0, -5, 7, 1000)] == [25, 25, 1, 7, 200]
    assert named.clamp_years(2030, 1000) == (1900, 2030) and named.clean_term("  a ") == "a" and len(named.clean_term("x" * 500)) == 120 and named.clean_term(None) == ""


def test_bad_parameters(g):
    assert named.search(g, "  ").count() == 0 and named.search(g, "").count() == 0
    assert {r.kind for r in named.search(g, "0", "org", 5).collect()} == {"org"} and named.search(g, "0", "nonsense", 5).count() == 5
    portfolio = lambda level: [tuple(r) for r in named.funder_portfolio(g, 1, level).collect()]
    assert portfolio("nonsense") == portfolio("topic") != [] and portfolio("domain") == []
    assert named.top_funders_usd(g, 10_000).count() <= 200 and named.rising_fields(g, (2001, 1996), (1995, 1995)).count() > 0
    assert named.org_summary(g, "https://ror.org/none").count() == 0


def test_fields_come_before_other_levels(g):
    got = [r.detail for r in named.search(g, "a", "field", 200).collect()]
    assert got == sorted(got, key=lambda x: x != "field")


def test_stages_and_activity(spark):
    from pyspark.sql import functions as F

    d = spark.createDataFrame([(2000, 2001, 10, 3, 25, False), (2000, 2008, 600, 9, 3, False), (2000, 2006, 80, 9, 3, False), (2000, 2003, 30, 9, 3, True), (2000, 2003, 30, 9, 3, False), (None, 2003, 9999, 9999, 99, True), (2000, 2000, None, 1500, None, None)], "a long, b long, c long, m long, h long, lead boolean")
    assert [r[0] for r in d.select(people.seniority(*map(F.col, ("a", "b", "c", "m", "h", "lead")))).collect()] == ["eminent", "established", "rising-star", "rising-star", "early/unknown", "early/unknown", "eminent"]
    t = spark.createDataFrame([(2012, True), (2009, False), (2008, True), (None, True)], "b long, lead boolean")
    assert [r[0] for r in t.select(people.activity(F.col("b"), F.col("lead"))).collect()] == ["active-pi", "active", "dormant", "dormant"]
    f = spark.createDataFrame([("Medicine ",), ("Unheard of",), (None,)], "f string").select(people.field_slug(F.col("f")).alias("s"))
    assert [(r.s, r.t.split(";")[0]) for r in f.select("s", people.tool_fit(F.col("s")).alias("t")).collect()] == [("biomed-bio", "seq-pipelines"), ("other", "fair-data-mgmt"), ("other", "fair-data-mgmt")]


def test_public_researchers_have_no_contact_data(spark):
    from fundloom.sources.sinks import PRIVATE

    for name in ("researchers_by_segment", "tool_targets", "segments"):
        assert not set(people.QUERIES[name](spark, ROOT).columns) & set(PRIVATE)
