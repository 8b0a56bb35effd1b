import random
import sys

import numpy as np

from fundloom.llm import matching, names
from fundloom.llm.entities import org_entities, person_entities, variants
from fundloom.llm.survivors import host, ror_key, says, survivors

sys.path.insert(0, "tests")
from conftest import rows  # noqa: E402

ORG = "atlas_id string, name string, ror_id string, country_code string, city string, region string, org_type string, homepage string, lat double, lon double, source string, as_of string, id string"
PERSON = "atlas_id string, full_name string, first_name string, last_name string, orcid string, sur string"
SAMPLE = "`Internal ID` string, `Recipient Org:Name` string, `Recipient Org:City` string, `Recipient Org:Country` string"


def org(k, name, city=None, country=None, ror=None, home=None, lat=None, lon=None, at="2024-01-01T00:00:00Z"):
    return (k, name, ror, country, city, None, None, home, lat, lon, "s", at, "clash")


def test_org_forms():
    f = lambda n, c=None: names.org_forms(n, c)
    assert f("Univ. of Lorvik")[0] == f("LORVIK, UNIVERSITY OF")[0] == f("Universität Lorvik")[0] == f("College of Arts, The University of Lorvik")[0] == f("UniversitÃ¤t Lorvik")[0]
    assert f("CHU de Lorvik")[0] == f("Lorvik Univ Hosp")[0] == f("Universitätsklinikum Lorvik")[0] != f("University of Lorvik")[0]
    assert f("Lorvik Foundation, Inc.")[0] == f("Stiftung Lorvik")[0] == f("Lorvik Fdn")[0]
    assert "LRCOR".lower() in f("Lorvik Research Centre")[1] and f("LRCOR") == ([], ["lrcor"])
    assert "lorvik univ" in f("University of Lorvik, Tessin", "Tessin")[0]
    for n in (None, "", " - ", "N/A", "(not stated)", "TBD"):
        assert f(n) is None


def test_person_forms():
    f = names.person_forms
    assert f("Dr Alexander Novel") == f("NOVEL, ALEXANDER") == f("NOVEL Alexander") == f("Novel Alexander, PhD") == f("Älexander Novel") == [("novel", "alexander", "a", None)]
    assert ("novel", "alexander", "a", None) in f("Sasha Novel") and f("Novel, A. B.") == f("Novel AB") == f("A. B. Novel") == [("novel", None, "a", "b")]
    assert f("A. Novel", "Alexander", "Novel") == [("novel", "alexander", "a", None)]
    assert f(None) == f("") == f("Dr") == [] and len(f("Tarvo Melin")) == 2


def test_variants(spark):
    orgs = [
        org("o1", "University of Lorvik", "Tessin", "CH"), org("o2", "Lorvik, Univ. of", "TESSIN", "ch"), org("o3", "Univeristy of Lorvik", None, "CH"), org("o4", "ULOR", "Tessin", None), org("o1", "University of Lorvik", "Tessin", "CH"),
        org("n1", "University of Lorvik", "Aarlund", "DK"),  # a namesake elsewhere
        org("s1", "Lorvik University Hospital", "Tessin", "CH"),  # a sibling
        org("x1", "N/A", "Tessin", "CH"), org("x2", None), org(None, "University of Lorvik"), org("r1", "Quite Another Name", ror="0abcdef12"), org("r2", "ROR twin", ror="https://ror.org/0ABCDEF12/"),
    ]
    people = [
        ("p1", "Alexander Novel", None, None, None, ""), ("p2", "Novel, Sasha", None, None, None, ""), ("p3", "Alexander Nvoel", None, None, None, ""), ("p4", "Beatrice Novel", None, None, None, ""), ("p1", "Alexander Novel", None, None, None, ""),
        ("q1", "Tom Reed", None, None, "0000-0000-0000-0001", ""), ("q2", "Tom Reed", None, None, "https://x/0000-0000-0000-0002", ""), ("q3", "T. Reed", None, None, "0000-0000-0000-0001", ""), (None, "Tom Reed", None, None, None, ""), ("z", None, None, None, None, ""),
    ]
    sample = [("i1", "UNIVERSITY OF LORVIK", "Tessin", "Switzerland"), ("i2", "Unheard of Place", None, None), (None, "x", None, None), ("i3", None, None, None)]
    o, p, s = spark.createDataFrame(orgs, ORG), spark.createDataFrame(people, PERSON), spark.createDataFrame(sample, SAMPLE)
    got = set(rows(variants(o, p, s)))
    want = {("organization", a, b) for a, b in (("o1", "o2"), ("o1", "o3"), ("o1", "o4"), ("o2", "o3"), ("o2", "o4"), ("o3", "o4"), ("r1", "r2"))} | {("person", "p1", "p2"), ("person", "p1", "p3"), ("person", "p2", "p3"), ("person", "q1", "q3")} | {("recipient", "i1", k) for k in ("o1", "o2", "o3", "o4")}
    assert got == want
    assert rows(variants(o.limit(0), p.limit(0), s.limit(0))) == []


def test_wide_forms_are_linked_too(spark):
    """More spellings of one form than are paired out, by grouping on evidence."""
    o = spark.createDataFrame([(f"k{i:03}", "University of Lorvik", f"Tessin {'x' * (i % 3)}{i}", "CH", None, "lorvik.example", None, None) for i in range(260)], "id string, name string, city string, country string, ror string, host string, lat double, lon double")
    assert len({e for _, e in rows(org_entities(o))}) == 1
    p = spark.createDataFrame([(f"k{i:03}", "Alexander Novel", None, None, f"{i // 2:016}") for i in range(600)], "id string, full_name string, first_name string, last_name string, orcid string")
    e = dict(rows(person_entities(p)))
    assert all(e[f"k{i:03}"] == e[f"k{i + 1:03}"] for i in range(0, 600, 2)) and len(set(e.values())) == 300


def test_held_out_ids(spark):
    """Typed variants of made-up institutions are found without their ids, and no two institutions are merged."""
    rnd = random.Random(3)
    syl = ["lor", "vik", "tes", "sin", "mar", "gol", "pen", "dra", "fun", "kel", "bor", "hus"]
    stems = sorted({"".join(rnd.sample(syl, 3)).capitalize() for _ in range(50)})
    kinds = [["University of {}", "Univ. of {}", "{}, University of", "UNIVERSITÄT {}"], ["{} Research Centre", "Research Center {}", "Forschungszentrum {}", "{} Res. Ctr."], ["{} Foundation", "The {} Foundation", "Stiftung {}", "{} Fdn"]]
    data = []
    for i, s in enumerate(stems):
        for j in range(5):
            n = rnd.choice(kinds[i % 3]).format(s)
            if j == 4:
                at = n.index(s[2:5]) + 1 if s[2:5] in n else 3
                n = n[:at] + n[at + 1 :]
            data.append((f"{i:02}-{j}", n, f"{s[::-1]}ham" if j % 2 else None, "CH", None, None, None, None))
    got = dict(rows(org_entities(spark.createDataFrame(data, "id string, name string, city string, country string, ror string, host string, lat double, lon double"))))
    pairs = [(a, b) for a in got for b in got if a < b and got[a] == got[b]]
    right = sum(a[:2] == b[:2] for a, b in pairs)
    assert right / len(pairs) > 0.99 and right / (len(stems) * 10) > 0.95


def test_matching(spark):
    rnd = random.Random(4)
    syl = ["lor", "vik", "tes", "sin", "mar", "gol", "pen", "dra", "fun", "kel", "bor", "hus"]
    stems = sorted({"".join(rnd.sample(syl, 3)).capitalize() for _ in range(120)})
    reg = [(i, f"{s} Research Centre", None, f"Town{s}", "Switzerland", float(i), float(i), 1900) for i, s in enumerate(stems[:80])] + [(900, None, None, None, None, None, None, None), (None, "x", None, None, None, None, None, None)]
    orgs = [org(f"o{i:03}", f"Research Ctr. {s[:3] + s[4:] if i % 4 == 0 else s}", f"Town{s}" if i % 3 else None, "CH", lat=float(i) if i % 2 else None, lon=float(i) if i % 2 else None) for i, s in enumerate(stems)] + [org("x", "-"), org(None, "y")]
    regp = [(i, f"Ann {s}" if i % 2 else f"{s}, A.", f"{s}, A. B.", f"{i:04}" if i % 2 else None, 2000) for i, s in enumerate(stems[:80])]
    people = [(f"p{i:03}", f"{s.upper()} Ann", None, None, f"0000-0000-0000-{i:04}" if i % 3 else None, "") for i, s in enumerate(stems)] + [("z", None, None, None, None, "")]
    o, p = spark.createDataFrame(orgs, ORG), spark.createDataFrame(people, PERSON)
    ro = spark.createDataFrame(reg, "reg_id long, legal_name string, other_names string, town string, country string, lat double, lon double, founded long")
    rp = spark.createDataFrame(regp, "reg_id long, display_name string, other_name string, orcid_tail string, active_since long")
    got = rows(matching.matches(o, p, ro, rp))
    right = sum(int(k[1:]) == r for _, k, r, _ in got)
    assert right == len(got) and right >= 0.93 * 160 and all(0.5 <= c <= 1 for *_, c in got)
    assert rows(matching.matches(o.limit(0), p.limit(0), ro, rp)) == [] and rows(matching.matches(o, p, ro.limit(0), rp.limit(0))) == []


def test_classifier_learns_and_falls_back():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 2))
    y = (x @ [2.0, -1.0] + rng.normal(0, 0.3, 400) > 0).astype(float)
    w = matching.fit(x, y, np.zeros(3))
    assert np.mean((x @ w[1:] + w[0] > 0) == y) > 0.93
    assert (matching.fit(x[:0], y[:0], np.ones(3)) == 1).all()
    few = matching.fit(x[:5], y[:5], np.ones(3))
    assert np.abs(few - 1).max() < np.abs(matching.fit(x, y, np.ones(3)) - 1).max()  # few labels move the prior a little


def test_survivors(spark):
    from pyspark.sql import functions as F

    def bad(column, values, f):
        return [r[0] for r in spark.createDataFrame([(v, i) for i, v in enumerate(values)], "c string, i int").orderBy("i").select(f(F.col("c"))).collect()]

    assert bad("c", ["Uni", " ", "-", "N/A", "(Not stated)", None, "tbd"], says) == [True] + [False] * 6
    assert bad("c", [" 0ABCDEF12 ", "https://ror.org/0abcdef12/", "ror.example/0abcdef12", "pending", "n/a", None], ror_key) == ["0abcdef12"] * 3 + [None] * 3
    assert bad("c", ["http://www.A-b.example/x", "a.example", "https://", "none", "-", None], host) == ["a-b.example", "a.example"] + [None] * 4
    data = [
        org("a", "Old name", "T", "CH", "0abcdef12", "www.a.example", 1.0, 1.0, "2024-01-01T00:00:00Z"), org("b", "New name", "T", "CH", "ror.org/0ABCDEF12", "https://", None, None, "2024-03-01T00:30:00+02:00"),
        org("c", "TBD", "U", "CH", "0abcdef12", "n/a", 5.0, 5.0, "2024-06-01T00:00:00Z"), org("c", "TBD", "U", "CH", "0abcdef12", "n/a", 5.0, 5.0, "2024-06-01T00:00:00Z"), org("d", "Alone", ror="0zzzzzz99"), org("e", "No id"), org("f", "-", ror="0yyyyyy11"), org("g", " ", ror="0yyyyyy11"),
    ]
    got = {r.ror_id: r for r in survivors(spark.createDataFrame(data, ORG)).collect()}
    assert {k: (r.name_from, r.homepage_from, r["keys"]) for k, r in got.items()} == {"0abcdef12": ("b", "a", 3), "0yyyyyy11": ("", "", 2)}
    assert got["0abcdef12"].address.city == "U" and got["0abcdef12"].geo_from == "c"  # the place fixes its coordinates
    assert survivors(spark.createDataFrame([], ORG)).count() == 0


def test_countries_do_not_block(spark):
    """Countries in a notation that isn't recognised contradict nothing, and ones that differ are evidence, not a block."""
    reg = [(1, "Stubiduvi National Laboratory", None, "Tessin", "République française", None, None, 1900), (2, "Lorvik Research Centre", None, "Aarlund", "RSA", 5.0, 5.0, 1900), (3, "Margol Foundation", None, "Penby", "Sweden", 7.0, 7.0, 1900)]
    orgs = [org("o1", "Stubiduvi Natl. Lab.", "Tessin", "FR"), org("o2", "Lorvik Research Ctr.", "Aarlund", "ZA", lat=5.0, lon=5.0), org("o3", "Margol Fdn", "Penby", "NO", lat=7.0, lon=7.0), org("o4", "Lorvik Research Centre", "Kelhus", "US", lat=50.0, lon=50.0)]
    o, p = spark.createDataFrame(orgs, ORG), spark.createDataFrame([], PERSON)
    ro = spark.createDataFrame(reg, "reg_id long, legal_name string, other_names string, town string, country string, lat double, lon double, founded long")
    rp = spark.createDataFrame([], "reg_id long, display_name string, other_name string, orcid_tail string, active_since long")
    assert [x[1:3] for x in rows(matching.matches(o, p, ro, rp))] == [("o1", 1), ("o2", 2), ("o3", 3)]


def test_small_edits_always_meet(spark):
    """One edit in a short surname or stem never loses the register entry."""
    rnd = random.Random(8)
    stem = lambda n: "".join(rnd.choice("bcdfghjklmnpqrstvwxz" if i % 2 else "aeiou") for i in range(n))
    surs, stems = sorted({stem(5) for _ in range(80)}), sorted({stem(6) for _ in range(80)})
    people = [(f"p{i:03}", f"{s[:2]}y{s[3:]}, Ann{stem(6)}", None, None, f"0000-0000-0000-{i:04}", "") for i, s in enumerate(surs)]
    regp = [(i, f"{s}, {people[i][1].split()[1]}", None, f"{i:04}", 2000) for i, s in enumerate(surs)]
    orgs = [org(f"o{i:03}", f"{s[:2]}{s[3]}{s[2]}{s[4:]} Foundation", f"Town{i}", "CH", lat=float(i), lon=1.0) for i, s in enumerate(stems)]
    reg = [(i, f"{s} Foundation", None, f"Town{i}", "Switzerland", float(i), 1.0, 1900) for i, s in enumerate(stems)]
    o, p = spark.createDataFrame(orgs, ORG), spark.createDataFrame(people, PERSON)
    ro = spark.createDataFrame(reg, "reg_id long, legal_name string, other_names string, town string, country string, lat double, lon double, founded long")
    rp = spark.createDataFrame(regp, "reg_id long, display_name string, other_name string, orcid_tail string, active_since long")
    got = rows(matching.matches(o, p, ro, rp))
    assert [(k, int(a[1:])) for k, a, *_ in got] == [(k, r) for k, _, r, _ in got] and len(got) == len(surs) + len(stems)


def test_names_of_common_words_meet(spark):
    """A name all of whose words are common is compared by all of them."""
    kinds, stems = ("Institute", "Foundation", "Biosciences Ltd"), ("Vamezila", "Lorvik", "Margol", "Pendra")
    reg = [(10 * i + j, f"{s} {k}", None, f"{s[::-1]}ham", "Sweden", None, None, 1900) for i, s in enumerate(stems) for j, k in enumerate(kinds)]
    orgs = [org(f"o{10 * i + j:02}", f"{s[:3] + s[4] + s[3] + s[5:] if i == 1 else s} {k}", f"{s[::-1]}ham", "SE") for i, s in enumerate(stems) for j, k in enumerate(("Inst.", "Stiftung", "Biosci"))]
    o, p = spark.createDataFrame(orgs, ORG), spark.createDataFrame([], PERSON)
    ro = spark.createDataFrame(reg, "reg_id long, legal_name string, other_names string, town string, country string, lat double, lon double, founded long")
    rp = spark.createDataFrame([], "reg_id long, display_name string, other_name string, orcid_tail string, active_since long")
    got = rows(matching.matches(o, p, ro, rp))
    assert [int(a[1:]) for _, a, *_ in got] == [r for _, _, r, _ in got] and {a for _, a, *_ in got} >= {x[0] for x in orgs if not x[0].startswith("o1")}


def test_components_do_not_depend_on_the_width_of_a_form(spark):
    """Profiles without a second attribute, and typed cities, are linked above the block size as below it."""
    from fundloom.llm import entities

    o = spark.createDataFrame([(f"k{i:03}", "University of Lorvik", "Tessinburg" if i % 2 else "Tessinbrg", None, None, f"h{i}.example" if i < 2 else None, float(i) / 1000, 1.0) for i in range(230)], "id string, name string, city string, country string, ror string, host string, lat double, lon double")
    p = spark.createDataFrame([(f"k{i:03}", "Novel, Alexander" + ("" if i else " B."), None, None, f"{i:016}" if i else None) for i in range(230)] + [(f"m{i}", "Alexander Novel", None, None, None) for i in range(2)], "id string, full_name string, first_name string, last_name string, orcid string")
    wide = rows(org_entities(o)), rows(person_entities(p))
    least, entities.PAIRWISE = entities.PAIRWISE, 1000
    try:
        assert wide == (rows(org_entities(o)), rows(person_entities(p))) and len({e for _, e in wide[0]}) < 3
    finally:
        entities.PAIRWISE = least


def test_coordinates_without_an_address_survive(spark):
    """A row without an address contradicts none, so its coordinates may be chosen; a group may have no address at all."""
    data = [org("a", "A", "T", "CH", "0abcdef12"), org("b", "B", ror="0abcdef12", lat=1.0, lon=2.0), org("c", "C", ror="0yyyyyy11", lat=3.0, lon=4.0), org("d", "D", ror="0yyyyyy11")]
    got = {r.ror_id: (r.address_from, r.geo_from) for r in survivors(spark.createDataFrame(data, ORG)).collect()}
    assert got == {"0abcdef12": ("a", "b"), "0yyyyyy11": ("", "c")}


def test_branches_are_cut_before_they_are_worked_out(spark):
    """The newest address and the newest coordinates contradict each other: the best of each alone is no choice."""
    at = lambda d: f"2024-{d:02}-01T00:00:00Z"
    data = [
        org("a", "A", "Town", "CH", "0abcdef12", at=at(9)), org("b", "B", "Ville", "CH", "0abcdef12", lat=1.0, lon=1.0, at=at(8)), org("c", "C", "Ort", "CH", "0abcdef12", lat=9.0, lon=9.0, at=at(2)), org("d", "D", "Burg", "CH", "0abcdef12", lat=9.0, lon=9.0, at="1969-01-01T00:00:00Z"),
        org("e", "E", "Town", "CH", "0yyyyyy11", at=at(3)), org("f", "F", "Ville", "CH", "0yyyyyy11", lat=2.0, lon=2.0, at="no instant"),  # an unreadable as_of is old: no address is lost for it
        org("g", "G", "Town", None, "0zzzzzz22", at=at(3)), org("h", "H", None, "CH", "0zzzzzz22", lat=3.0, lon=3.0, at=at(1)), org("i", "I", "Ville", "CH", "0zzzzzz22", lat=4.0, lon=4.0, at=at(1)),
    ]
    got = {r.ror_id: r for r in survivors(spark.createDataFrame(data, ORG)).collect()}
    assert {k: (r.name_from, r.address_from, r.geo_from) for k, r in got.items()} == {"0abcdef12": ("a", "b", "b"), "0yyyyyy11": ("e", "e", ""), "0zzzzzz22": ("g", "g", "h")}
    assert (got["0abcdef12"].branches, got["0abcdef12"].cut) == (4, 1)


def test_survivors_against_all_choices(spark):
    """Branch and bound finds the choice that looking at all of them finds."""
    import duckdb

    from fundloom.llm.registry import ORACLES

    rnd = random.Random(12)
    some = lambda *x: rnd.choice([None, *x])
    data = []
    for i in range(400):
        xy = some(float(rnd.randrange(5)))
        data.append(org(f"k{rnd.randrange(150):03}", rnd.choice(["A", "-", "B b"]), some("Town", "town", "Ville", " Ort"), some("CH", "ch", "FR"), f"0abcde{rnd.randrange(60):03}", some("a.example", "-"), xy, xy, f"20{rnd.randrange(20, 24)}-0{rnd.randrange(1, 9)}-11T0{rnd.randrange(9)}:00:00+02:00"))
    o = spark.createDataFrame(data, ORG).dropDuplicates(["atlas_id", "as_of"])
    organization = o.toPandas()  # noqa: F841
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    want = c.execute(ORACLES["p7_records"]).fetchall()
    s = survivors(o).select("ror_id", "name", "homepage", "address.city", "address.region", "address.country_code", "address_from", "geo.lat", "geo.lon", "geo_from", "keys")
    assert {tuple(str(x) for x in r) for r in s.collect()} == {tuple("None" if x is None or x != x else str(x) for x in r) for r in want}


def test_rows_of_one_key_are_matched_each(spark):
    """Rows of one key that differ don't lend each other attributes, however they are laid out."""
    reg = [(1, "Lorvik Research Centre", None, "Aarlund", "Denmark", 5.0, 5.0, 1900), (1, "Lorvik Research Centre", None, None, None, None, None, 1900), (2, "Lorvik Research Centre", None, "Kelhus", "Sweden", 50.0, 50.0, 1900)]
    orgs = [org("o1", "Lorvik Research Ctr.", "Kelhus", "SE", lat=50.0, lon=50.0), org("o1", "Lorvik Research Centre"), org("o2", "Lorvik Research Centre", "Aarlund", "DK", lat=5.0, lon=5.0)]
    ro = spark.createDataFrame(reg, "reg_id long, legal_name string, other_names string, town string, country string, lat double, lon double, founded long")
    rp = spark.createDataFrame([], "reg_id long, display_name string, other_name string, orcid_tail string, active_since long")
    for n in (1, 3):
        o = spark.createDataFrame(orgs[::-1] if n > 1 else orgs, ORG).repartition(n)
        assert [x[1:3] for x in rows(matching.matches(o, spark.createDataFrame([], PERSON), ro.repartition(n), rp))] == [("o1", 2), ("o2", 1)]


def test_surnames_with_letters_left_out_are_not_broadcast(spark):
    """Each surname has some sixty keys, which the planner doesn't count."""
    l, r = (spark.sql(f"select * from values ('{x}', 'lutruklisu', 'l'), ('{x}2', 'lutrukilsu', 'l'), ('{x}3', 'paronogi', 'u') as t(id, sur, gi)") for x in "ab")
    found = matching.people_candidates(l, r)
    keyed = [x for x in found._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in x and "key#" in x]
    assert keyed and all("SortMergeJoin" in x for x in keyed)
    assert len(rows(found)) == 5
