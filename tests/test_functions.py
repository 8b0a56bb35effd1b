import pytest
from pyspark.sql import functions as F

from fundloom.functions import dates, keys, text


def one(spark, column, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "c string").select(column).collect()]


def test_keys(spark):
    k = one(spark, keys.surrogate_key("organization", F.col("c"), F.lit("  Uni ")), " NSF ", None)
    assert k[0].startswith("org:") and len(k[0]) == 20 and k[0] != k[1]
    assert one(spark, keys.surrogate_key("person", F.col("c")), "  ", None) == [None, None]
    assert one(spark, keys.partition_year(F.col("c"), F.lit("2020-01-01")), "1999-02", "the ", None) == ["1999", "2020", "2020"]


def test_schema(spark):
    g = spark.createDataFrame([("g", 0.0)], "atlas_id string, amount_usd double")
    with pytest.raises(Exception, match="amount_usd"):
        keys.enforce_schema(g, "grant").collect()
    assert keys.enforce_schema(g.drop("amount_usd"), "grant").columns == keys.columns("grant")
    with pytest.raises(ValueError):
        keys.enforce_schema(g.withColumn("more", F.lit(1)), "grant")
    with pytest.raises(KeyError):
        keys.columns("nothing")


def test_names(spark):
    c = F.col("c")
    assert one(spark, text.normalize_name(c), "Université  de Montréal", "A&M", None) == ["universite de montreal", "a and m", ""]
    assert one(spark, text.expand_abbreviations(c), "univ hosp", "mit", "natl inst of hlth") == ["university hospital", "mit", "national institute of health"]
    assert one(spark, text.name_tokens(c), "the university of x texas university") == [["texas", "university"]]
    p = text.name_parts(c, F.lit(None).cast("string"), F.lit(None).cast("string"))
    assert [tuple(x) if x else None for x in one(spark, p, "Dr. Ann B. Lee", "Lee, Ann", "Müller, Jörg, PhD", "a, b, c, d", "", None)] == [("lee", ["ann", "b"], "a"), ("lee", ["ann"], "a"), ("muller", ["jorg"], "j"), None, None, None]


def test_award_keys(spark):
    k = lambda src, a: one(spark, text.award_keys(F.lit(src), F.col("c")), a)[0]
    assert {"NIH:CA068377"} <= set(k("nih", "5R01CA068377-23")) & set(k("nih", "R01 CA 068377")) & set(k("nih", "CA068377"))
    assert "NSF:1234567" in set(k("nsf", "1234567")) & set(k("nsf", "DEB-1234567"))
    assert k("ec", "12345678 or 123") == ["12345678", "12345678OR123", "EC:12345678"]
    assert k("ukri", "EP/X1/1") == ["EPX11", "UKRI:EPX11"] and k("nih", " ") == [] and k("nih", None) == []


def test_markup(spark):
    c = F.col("c")
    assert one(spark, text.html_text(c), "<p>a &amp;<b>b</b>&nbsp;c</p>", None) == ["a & b c", None]
    assert one(spark, text.inverted_abstract(c), '{"b":[1],"a":[0,2]}', "{}", None) == ["a b a", None, None]
    assert one(spark, text.last_segment(c), "https://x/y/Z1/", "", None) == ["Z1", None, None]


def test_dates_and_money(spark):
    c = F.col("c")
    assert one(spark, dates.us_date(c), "02/03/2020", "13/40/2020", "", None) == ["2020-02-03", None, None, None]
    assert one(spark, dates.millis_date(c), "1580515200000", "0", "x", None) == ["2020-02-01", None, None, None]
    assert [tuple(x) for x in one(spark, dates.month_span(c, F.lit("18")), "2020-05", "bad")] == [("2020-05-01", "2021-11-01"), (None, None)]
    assert [tuple(x) for x in one(spark, dates.term(c), "from 2019 to 2022", "from 2019", None)] == [("2019-01-01", "2022-12-31"), ("2019-01-01", None), (None, None)]
    assert one(spark, dates.decimal_comma(c), "1500000,50", "2,000.5", "0", "-3", "") == [1500000.5, 2000.5, None, None, None]
    assert one(spark, dates.decimal_point(c), "$1,500", "£2", "x") == [1500.0, 2.0, None]
    assert [tuple(x) for x in one(spark, dates.lat_lon(c), "(1.5,2.5)", "1.5", None)] == [(1.5, 2.5), (None, None), (None, None)]
