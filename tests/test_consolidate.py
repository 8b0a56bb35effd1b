from conftest import rows
from pyspark.sql import functions as F

from fundloom.operators import consolidate as c

DDL = "src_id string, dst_id string, role string, source string, source_id string, source_url string, as_of string"


def test_newest(spark):
    d = spark.createDataFrame([("a", "old", "2024-01-01T02:00:00+02:00"), ("a", "new", "2024-01-01T00:30:00Z"), ("b", None, None), ("b", "x", None), (None, "n", None)], "atlas_id string, name string, as_of string")
    assert rows(c.dedup_entities(d), "atlas_id", "name") == [("a", "new"), ("b", "x")]
    assert rows(c.dedup_entities(d.limit(0))) == []


def test_edges_and_remap(spark):
    e = spark.createDataFrame([("g", "o1", "r", "s", "1", None, "2024-01-01T00:00:00Z"), ("g", "o2", "r", "s", "2", None, "2024-02-01T00:00:00Z"), ("g", None, "r", "s", "3", None, None)], DDL)
    o = spark.createDataFrame([("o1", "R", "s"), ("o2", "R", "t"), ("o3", None, "t")], "atlas_id string, ror_id string, source string")
    canon = c.canonical_orgs(o, F.col("ror_id"))
    assert rows(canon) == [("o1", "o1", "s,t"), ("o2", "o1", "s,t"), ("o3", "o3", None)]
    assert rows(c.remap_edges(e, canon), "src_id", "dst_id", "source_id") == [("g", None, "3"), ("g", "o1", "2")]


def test_shards(spark, tmp_path):
    d = spark.createDataFrame([("a", "2020-01-01", "s", "2024-01-01T00:00:00Z"), ("b", None, "s", "2021-01-01T00:00:00Z")], "atlas_id string, start_date string, source string, as_of string")
    c.write_deliveries(d, f"{tmp_path}/t", "start_date")
    c.rewrite_slice(d.where("atlas_id = 'a'").withColumn("atlas_id", F.lit("z")), f"{tmp_path}/t", "start_date")
    back = spark.read.parquet(f"{tmp_path}/t")
    assert rows(back.select("atlas_id", F.col("year").cast("int"))) == [("b", 2021), ("z", 2020)]


def test_first_wins(spark):
    d = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 3, None)], "k string, i int, v string")
    assert rows(c.first_wins(d, "k", F.col("i")), "k", "v") == [("a", "early"), ("b", None)]
