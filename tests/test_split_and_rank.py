import duckdb

from fundloom.plans.rankings import ORACLES, split_and_rank


def test_every_held_out_reference_is_ranked(spark):
    root = "/root/testdata/sf0.01"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{root}/lineitem.parquet'")
    want = duck.execute(ORACLES["split_and_rank"]).fetchall()
    got = sorted((r["query"], r["item"], r["pos"]) for r in split_and_rank(spark, root).collect())
    assert got == sorted(want) and max(p for *_, p in got) > 500
