import pytest
from conftest import rows

from fundloom.operators.references import Link, cascade, direct_orphans

LINK = "src_id string, dst_id string, as_of string, atlas_id string"  # a clashing column that must not matter


def test_direct(spark):
    links = spark.createDataFrame(
        [
            ("g1", "work:a", "2024-02-01T00:00:00Z", "?"), ("g1", " WORK:A ", "2024-02-01T00:30:00Z", "?"),  # held
            ("g1", "work:a", "2023-12-31T23:30:00-02:00", "?"),  # 2024-01-01 01:30 UTC, before the target
            ("g2", "work:x", "2024-03-31T23:30:00-05:00", "?"), ("g2", "Work:X", "2024-04-02T00:00:00Z", "?"),  # missing, in April by UTC
            (None, "work:x", None, "?"), ("g3", None, "2024-01-01T00:00:00Z", "?"), ("g3", "  ", "2024-01-01T00:00:00Z", "?"), ("g4", "work:b", "junk", "?"),
        ],
        LINK,
    )
    works = spark.createDataFrame([("work:a", "2024-01-15T00:00:00Z"), ("work:a", "2025-01-15T00:00:00Z"), ("work:b", None), (None, "2024-01-01T00:00:00Z")], "atlas_id string, as_of string")
    got = rows(direct_orphans(links, works, "grant_work"), "table_name", "period", "src_id", "dst_id", "reason")
    assert got == [("grant_work", None, None, "work:x", "missing"), ("grant_work", "2024-01", "g1", "work:a", "early"), ("grant_work", "2024-04", "g2", "work:x", "missing")]
    assert rows(direct_orphans(links.limit(0), works, "t")) == []
    assert {r[0] for r in rows(direct_orphans(links, works.limit(0), "t"), "dst_id")} == {"work:a", "work:b", "work:x"}


def test_cascade(spark):
    at = "2024-05-01T00:00:00Z"
    link = lambda *p: spark.createDataFrame([(a, b, at) for a, b in p], "src_id string, dst_id string, as_of string")
    ent = lambda *k: spark.createDataFrame([(x, "2020-01-01T00:00:00Z") for x in k], "atlas_id string, as_of string")
    tables = {
        "funder_grant": link(("f", "grant:1"), ("f", "grant:9")), "grant_org": link(("grant:9", "org:1"), ("grant:1", "org:1")), "grant_work": link(("grant:9", "work:1"), ("grant:1", "work:2"), ("grant:1", "work:7")),
        "grant_record": ent("grant:1"), "organization": ent("org:1"), "work_record": ent("work:1", "work:2"),
    }
    got = rows(cascade(tables), "table_name", "src_id", "dst_id", "kind", "level")
    assert got == [("funder_grant", "f", "grant:9", "direct", 0), ("grant_org", "grant:9", "org:1", "inherited", 1), ("grant_work", "grant:1", "work:7", "direct", 0), ("grant_work", "grant:9", "work:1", "inherited", 1)]


def test_cascade_through_three_levels(spark):
    """funder, grant, work, field: what hangs on a missing funder only is orphaned level by level; what another grant
    also names lives on. A hot source and links in a circle change nothing."""
    at = "2024-05-01T00:00:00Z"
    link = lambda *p: spark.createDataFrame([(a, b, at) for a, b in p], "src_id string, dst_id string, as_of string")
    ent = lambda *k: spark.createDataFrame([(x, "2020-01-01T00:00:00Z") for x in k], "atlas_id string, as_of string")
    graph = (Link("programme_funder", "programme", "funder"), Link("funder_grant", "funder", "grant"), Link("grant_work", "grant", "work"), Link("work_field", "work", "field"), Link("field_work", "field", "work"))
    held_in = {"funder": "funder_record", "grant": "grant_record", "work": "work_record", "field": "field"}
    tables = {
        "programme_funder": link(("p", "f9"), ("p", "f1")), "funder_grant": link(("F9 ", "g1"), ("f9", "g2"), ("f1", "g2")), "grant_work": link(*[("g1", f"w{i}") for i in range(300)], ("g2", "w1")), "work_field": link(("w0", "x0"), ("w1", "x1")), "field_work": link(("x0", "w0")),
        "funder_record": ent("f1"), "grant_record": ent("g1", "g2"), "work_record": ent(*[f"w{i}" for i in range(300)]), "field": ent("x0", "x1"),
    }
    counts = lambda df: {(r[0], r[1], r[2]): r[3] for r in df.groupBy("table_name", "kind", "level").count().collect()}
    upper = {("programme_funder", "direct", 0): 1, ("funder_grant", "inherited", 1): 2, ("grant_work", "inherited", 2): 300}
    assert counts(cascade(tables, graph, held_in)) == upper
    # w0 is also named by a field's link, which isn't an orphan, so it lives on; without that table it doesn't.
    assert counts(cascade(tables, graph[:4], held_in)) == upper | {("work_field", "inherited", 3): 1}
    assert {r.level for r in cascade(tables, graph, held_in, levels=1).select("level").distinct().collect()} == {0, 1}
    with pytest.raises(RuntimeError):
        cascade(tables, graph[:4], held_in, max_rounds=2)
