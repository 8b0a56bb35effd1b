from conftest import rows
from pyspark.sql import functions as F

from fundloom.functions import contacts as c


def column(spark, values, f):
    return [r[0] for r in spark.createDataFrame([(v, i) for i, v in enumerate(values)], "c string, i int").orderBy("i").select(f(F.col("c"))).collect()]


def test_addresses(spark):
    assert column(spark, ["a.b@x.org, C@y.example.", "none", None, ""], c.addresses) == [["a.b@x.org", "C@y.example"], [], [], []]
    assert column(spark, ["Electronic address: a@x.org.", "electronic address:b@x.org", "address: c@x.org", None], c.electronic_address) == ["a@x.org", "b@x.org", None, None]
    assert column(spark, ["ann@x.org", " Ann@x.org. ", "info@x.org", "No-Reply@x.org", "a@sentry.io", "logo@2x.png", "nobody", None, ""], c.acceptable) == [True, True] + [False] * 7


def test_same_author(spark):
    d = spark.createDataFrame([("0000-1", "Ann Bee", "https://o/0000-1", "X"), ("0000-1", "Ann Bee", "0000-2", "Ann Bee"), (None, "Bee, Ann", None, "Ann B"), ("0000-1", "Ann Bee", None, "A Bee"), (None, None, None, "A")], "o string, n string, p string, m string")
    assert [r[0] for r in d.select(c.same_author(*map(F.col, "onpm"))).collect()] == [True, False, True, True, False]


def test_provenance_and_choice(spark):
    d = spark.createDataFrame([("a@x.org", "orcid", "u", "t"), ("a@", "rumour", " ", None), (None, None, None, None), (" ", "x", None, None)], "e string, s string, u string, t string")
    assert [r[0] for r in d.select(c.violations(*map(F.col, "esut"))).collect()] == [[], ["syntax", "source", "url", "as_of"], [], []]
    hits = spark.createDataFrame([(1, "math", "B@x.org.", "europepmc"), (1, "math", "a@x.org", "orcid"), (2, "chemistry", "b@x.org", "europepmc"), (2, "chemistry", "a@x.org", "orcid"), (3, None, "info@x.org", "orcid"), (4, None, "d@x.org", "rumour"), (5, None, "e@x.org", "labpage")], "person int, field_slug string, email string, source string")
    assert rows(c.best_contact(hits)) == [(1, "a@x.org", "orcid"), (2, "b@x.org", "europepmc"), (5, "e@x.org", "labpage")]
    assert rows(c.best_contact(hits.limit(0))) == []
