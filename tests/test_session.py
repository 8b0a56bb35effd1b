"""Lineage cuts."""

from pyspark.sql import functions as F

from fundloom.session import cut


def test_guess_of_size_stays_bounded_in_a_loop(spark):
    """A table that is joined with itself each round: its guess was squared by every checkpoint, 2**k times its digits."""
    f = cut(spark.range(40).select(F.col("id").alias("v"), F.greatest(F.col("id") - 1, F.lit(0)).alias("u")))
    for _ in range(6):
        f = cut(f.join(f.select(F.col("v").alias("u"), F.col("u").alias("w")), "u").select("v", F.col("w").alias("u")))
    assert f._jdf.queryExecution().analyzed().stats().sizeInBytes().bit_length() <= 64
    assert sorted(map(tuple, f.collect())) == [(i, 0) for i in range(40)]


def test_table_that_grew_is_not_broadcast_by_the_size_of_what_it_was_made_from(spark):
    few = spark.range(10).select(F.col("id").alias("v"), F.explode(F.sequence(F.lit(1), F.lit(50_000))).alias("k"))
    grown = cut(few)
    plan = spark.range(10).withColumnRenamed("id", "v").join(grown, "v").join(grown.select("v", F.col("k").alias("j")), "v")._jdf.queryExecution()
    assert grown.count() == 500_000
    assert "v#" in plan.sparkPlan().toString() and "BuildRight" not in plan.sparkPlan().toString()


def test_shuffle_files_behind_a_cut_go(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = manager.shuffleStatuses().size()
    kept = cut(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert manager.shuffleStatuses().size() <= before
    assert kept.count() == 7
