from conftest import rows

from fundloom.operators import resolve

NAMES = [
    ("r1", "Karlsbad University", "display", "US"), ("r1", "KU", "acronym", "US"), ("r2", "Karlsbad University West", "display", "US"), ("r3", "Karlsbad University East", "display", "US"),
    ("r4", "Hill Pet Food", "display", "US"), ("r5", "Polar Research Institute of Norway", "display", "NO"), ("r6", "Twin College", "display", "US"), ("r7", "Twin College", "display", "US"),
    ("r8", "Twin College", "alias", "GB"), ("r9", "KU", "acronym", "DK"),
]


def test_institutions(spark):
    idx = resolve.register_index(spark.createDataFrame(NAMES, "ror string, name string, kind string, country string"))
    asked = [("KARLSBAD  University", "US"), ("Karlsbad Univ", "US"), ("KU", "US"), ("KU", None), ("Twin College", "US"), ("Twin College", "UK"), ("Norway Polar Research Institute", "NO"), ("University of Hill Park", "US"), ("Polar Research Institute Tromso", "NO"), ("", "US"), (None, None)]
    got = {(n, c): (r, m) for n, c, r, m, _ in rows(resolve.match_institutions(spark.createDataFrame(asked * 2, "name string, country string"), idx, 0.6))}
    assert got == {("KARLSBAD  University", "US"): ("r1", "exact"), ("Karlsbad Univ", "US"): ("r1", "expanded"), ("KU", "US"): ("r1", "acronym"), ("Twin College", "UK"): ("r8", "exact"), ("Norway Polar Research Institute", "NO"): ("r5", "fuzzy")}
    assert rows(resolve.match_institutions(spark.createDataFrame([], "name string, country string"), idx)) == []


def test_people(spark):
    ddl = "full_name string, first_name string, last_name string, orcid string, org string, field string"
    known = [("p1", "Ann Lee", None, None, "O1", "R", "bio"), ("p2", "Jon Lee", None, None, None, "R", "bio"), ("p3", "Jane Lee", None, None, None, "R", "chem"), ("p4", "Ann Lee", None, None, None, "S", "bio")]
    asked = [
        ("orcid", "X", None, None, "O1", None, None), ("one", "Ann Lee", None, None, None, "R", None), ("field", "Lee, J.", None, None, None, "R", "chem"), ("two", "J. Lee", None, None, None, "R", None), ("conflict", "Ann Lee", None, None, None, "R", "math"),
        ("noname", "Zoe Lee", None, None, None, "R", None), ("noorg", "Ann Lee", None, None, None, None, None), ("bad", None, None, None, None, "R", None),
    ]
    got = {q: (p, m or r) for q, p, m, _, r in rows(resolve.resolve_people(spark.createDataFrame(asked, f"qid string, {ddl}"), spark.createDataFrame(known * 2, f"person_id string, {ddl}")))}
    assert got == {
        "orcid": ("p1", "orcid"), "one": ("p1", "name+org"), "field": ("p3", "name+org+field"), "two": (None, "ambiguous"), "conflict": (None, "field-conflict"),
        "noname": (None, "no-name-overlap"), "noorg": (None, "no-org-overlap"), "bad": (None, "unparseable-name"),
    }


def test_awards(spark):
    g = spark.createDataFrame([("g1", "nih", "5R01CA068377-23"), ("g2", "cordis", "101000001"), ("g3", "nsf", None)], "atlas_id string, source string, source_id string")
    a = spark.createDataFrame([("w1", "nih", "R01 CA 068377"), ("w2", "ec", "101000001"), ("w3", "nsf", "777"), ("w4", None, None)], "work_id string, source string, award string")
    assert rows(resolve.link_awards(a, g)) == [("w1", "g1"), ("w2", "g2")]


def test_modal(spark):
    d = spark.createDataFrame([("g", "b", False), ("g", "b", False), ("g", "a", True), ("h", "y", None), ("h", "x", None), ("h", None, None)], "k string, v string, f boolean")
    assert rows(resolve.modal(d, "k", "v")) == [("g", "b", 2), ("h", "x", 1)]
    from pyspark.sql import functions as F

    assert rows(resolve.modal(d, "k", "v", F.coalesce("f", F.lit(False)))) == [("g", "a", 1), ("h", "x", 1)]


def test_an_id_that_is_given_comes_first(spark):
    idx = resolve.register_index(spark.createDataFrame(NAMES, "ror string, name string, kind string, country string"))
    o = spark.createDataFrame([("Karlsbad University", "US", "r99"), ("Karlsbad University", "US", " "), ("Nowhere", None, None), (None, None, "r5"), (None, None, None)], "name string, country string, ror_id string")
    assert rows(resolve.resolve_institutions(o, idx), "name", "given", "ror", "method") == [(None, None, None, None), (None, "r5", "r5", "prematched"), ("Karlsbad University", None, "r1", "exact"), ("Karlsbad University", "r99", "r99", "prematched"), ("Nowhere", None, None, None)]
