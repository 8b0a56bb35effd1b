import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fundloom.operators.consolidate import dedup_entities
from fundloom.plans.crossfield import run_tranches
from fundloom.session import cut
from fundloom.sources import sinks, tables


def test_merge_swaps_whole_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    newest = lambda d: d.groupBy("k").agg(F.max(F.struct("v", "w")).alias("m")).select("k", "m.*")
    sinks.merge_table(spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, v int, w string"), path, newest)
    sinks.merge_table(spark.createDataFrame([("b", 2), ("c", 1)], "k string, v int"), path, newest)
    assert rows(spark.read.parquet(path)) == [("a", 1, "x"), ("b", 2, None), ("c", 1, None)]
    with pytest.raises(Exception, match="no such"):
        sinks.merge_table(spark.createDataFrame([("z", 1)], "k string, v int"), path, lambda d: d.select(F.raise_error(F.lit("no such"))))
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir() if p.name.endswith(".old")] == []


def test_vectors_to_do(spark):
    w = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "work_id string")
    cache = spark.createDataFrame([("a", [1.0]), ("c", None)], "work_id string, vector array<double>")
    assert rows(sinks.to_do(w, cache)) == [("b",), ("c",)] and sinks.to_do(w, None).count() == 3


def test_union_by_name_spaces_and_public_views(spark, tmp_path):
    spark.createDataFrame([("1", "a")], "id string, name string").write.parquet(str(tmp_path / "p1"))
    spark.createDataFrame([("2", "m@x.org")], "id string, email string").write.parquet(str(tmp_path / "p2"))
    both = tables.united(spark, str(tmp_path / "p1"), str(tmp_path / "p2"))
    assert rows(both.select("id", "name", "email")) == [("1", "a", None), ("2", None, "m@x.org")]
    assert tables.united(spark, str(tmp_path / "p1"), str(tmp_path / "p2"), schema=both.schema).count() == 2
    both.write.parquet(str(tmp_path / "people.parquet"))
    assert tables.attach(spark, str(tmp_path), "other", "people") == ["other_people"] and set(tables.attached(spark, "other")["people"]) == {"id", "name", "email"} and tables.attached(spark, "nothing") == {}
    sinks.public_view(both, "people_public")
    assert set(spark.table("people_public").columns) == {"id", "name"}


def test_manifest_and_report(spark, tmp_path):
    d = spark.createDataFrame([("s", "2024", 2.0), ("s", "2025", None), (None, None, 1.5)], "source string, as_of string, amount_usd double")
    m = sinks.manifest({"grant": d, "field": d.drop("amount_usd")})
    assert m["grant"]["row_count"] == 3 and m["grant"]["as_of"] == "2025" and m["grant"]["usd_by_source"] == {"s": 2.0, None: 1.5} and "usd_by_source" not in m["field"]
    sinks.report({"By source": d.groupBy("source").count()}, tmp_path / "r.md", "Landscape")
    assert (tmp_path / "r.md").read_text().startswith("# Landscape\n\n## By source\n\n| source | count |")
    sinks.append_jsonl(tmp_path / "l.jsonl", {"a": 1})
    with (tmp_path / "l.jsonl").open("a") as f:
        f.write('{"b": ')
    assert sinks.read_jsonl(tmp_path / "l.jsonl") == [{"a": 1}] and sinks.read_jsonl(tmp_path / "none") == []


def test_newest_row_of_an_entity(spark):
    d = spark.createDataFrame([("k", "old", "2024-01-01T10:00:00+02:00"), ("k", "new", "2024-01-01T09:00:00Z"), ("k", "bad", "?")], "atlas_id string, name string, as_of string")
    assert rows(dedup_entities(d), "name") == [("new",)]


def test_tranches_resume(spark, tmp_path):
    out = str(tmp_path / "run")
    (tmp_path / "run").mkdir()
    first = run_tranches(spark, "/root/testdata/sf0.001", out, (20, 60))
    assert {r.tranche for r in first.select("tranche").distinct().collect()} == {20, 60} and first.where("works > tranche").isEmpty()
    at = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "run" / "tranche=20").iterdir()}
    again = run_tranches(spark, "/root/testdata/sf0.001", out, (20, 60, 200))
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "run" / "tranche=20").iterdir()} == at and again.where("tranche = 200").count() > 0
    assert [json.loads(x)["tranche"] for x in (tmp_path / "run" / "log.jsonl").read_text().splitlines()] == [20, 60, 200]


def test_checkpoints_need_a_shared_folder(spark, monkeypatch):
    class Far:
        master = "spark://host:7077"

        def getConf(self):  # noqa: N802
            return {}

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Frame:
        class sparkSession:  # noqa: N801
            sparkContext = Far()

    with pytest.raises(RuntimeError, match="share"):
        cut(Frame())
