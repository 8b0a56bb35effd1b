"""Ranks and running sums over a whole table, without gathering it in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundloom.session import cut


def global_order(df: DataFrame, *order: Column, value: str | None = None) -> DataFrame:
    """``df`` with ``rank`` (1 for the first in ``order``, which must be total) and, given ``value``, its running sum
    ``upto`` including the row itself.

    Range partitions are sorted each on their own; their sizes and sums (one row per partition) are what ties them
    together. The partitioning is materialised, so that a lost task can't draw other borders.
    """
    parts = cut(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    amount = F.col(value) if value else F.lit(0)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    offsets = parts.groupBy("_p").agg(F.count("*").alias("_n"), F.sum(amount).alias("_s")).select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s0"))
    within = Window.partitionBy("_p").orderBy(*order)
    out = parts.join(F.broadcast(offsets), "_p").withColumn("rank", F.row_number().over(within) + F.col("_n0"))
    if value:
        out = out.withColumn("upto", F.sum(value).over(within.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_s0"))
    return out.drop("_p", "_n0", "_s0")


def concentration(df: DataFrame, value: str, key: str, shares: tuple[float, ...] = (0.01, 0.05, 0.10)) -> DataFrame:
    """One row: ``n, total, gini, hhi, top_<percent>``. Gini of no rows or of zeros is null; negative values raise."""
    x = df.where(F.col(value).isNotNull()).select(F.col(key).alias("k"), F.when(F.col(value) < 0, F.raise_error(F.lit("negative value"))).otherwise(F.col(value)).alias("x"))
    r = global_order(x, F.asc("x"), F.asc("k"))
    n = r.count()
    share = [F.sum(F.when(F.col("rank") > n - max(1, -int(-n * s // 1)), F.col("x"))).alias(f"t{i}") for i, s in enumerate(shares)]
    a = r.agg(F.count("*").alias("n"), F.sum("x").alias("total"), F.sum((2 * F.col("rank") - n - 1) * F.col("x")).alias("g"), F.sum(F.col("x") * F.col("x")).alias("q"), *share)
    tops = [F.round(F.try_divide(f"t{i}", "total"), 6).alias(f"top_{round(s * 100)}") for i, s in enumerate(shares)]
    return a.select("n", F.round("total", 2).alias("total"), F.round(F.try_divide("g", F.col("total") * n), 6).alias("gini"), F.round(F.try_divide("q", F.col("total") * F.col("total")), 8).alias("hhi"), *tops)


def lorenz(df: DataFrame, value: str, key: str, points: int = 20) -> DataFrame:
    """``(step, share)``: the share of the total that the lowest ``step / points`` of the rows hold."""
    x = df.where(F.col(value).isNotNull()).select(F.col(key).alias("k"), F.col(value).cast("double").alias("x"))
    r = global_order(x, F.asc("x"), F.asc("k"), value="x")
    n = r.count()
    total = F.max("upto").over(Window.partitionBy())
    steps = F.broadcast(df.sparkSession.range(1, points + 1).select(F.col("id").alias("step"), F.floor(F.col("id") * n / points).alias("rank")))
    return r.join(steps, "rank").select("step", "upto").withColumn("share", F.round(F.col("upto") / total, 6)).select("step", "share")


def spearman(df: DataFrame, a: str, b: str, key: str) -> DataFrame:
    """``(n, spearman, pearson)``: ordinal ranks, ties in order of the key. A constant column has no correlation (null)."""
    corr = lambda x, y: F.round(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)), 6)
    ra = global_order(df.select(key, a, b), F.asc(a), F.asc(key)).withColumnRenamed("rank", "ra")
    rb = global_order(ra, F.asc(b), F.asc(key)).withColumnRenamed("rank", "rb")
    return rb.agg(F.count("*").alias("n"), corr("ra", "rb").alias("spearman"), corr(a, b).alias("pearson"))


def drawn(seed: int, *key: Column, n: Column) -> Column:
    """A draw from 0..n-1 that any SQL engine can repeat: leading 32 bits of an MD5, modulo n."""
    return F.pmod(_bits(seed, *key), n)


def _bits(seed: int, *key: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in key])), 1, 8), 16, 10).cast("bigint")


#: Of 2**32 equal draws, those from here on have a Poisson count (of mean 1) of more than 0, 1, 2 ...
POISSON = tuple(int(2**32 * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))) for k in range(11))


def resampled(df: DataFrame, key: Column, draws: int, seed: int) -> DataFrame:
    """``df`` once per draw ``b`` it takes part in, with ``w``, how often: the Poisson bootstrap.

    A row's weight depends on seed, draw and key only, so resampling needs no numbering, no join and no cross product:
    rows are exploded where they are, and sums per draw are combined map-side. Rows of equal key share their weights.
    """
    draw = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(draws - 1).cast("long")))
    # Hexadecimal digits of one length compare as the numbers they stand for.
    u = df.withColumn("b", draw).withColumn("u", F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("b").cast("string"), key.cast("string"))), 1, 8)).where(F.col("u") >= f"{POISSON[0]:08x}")
    return u.withColumn("w", sum(((F.col("u") >= f"{t:08x}").cast("long") for t in POISSON[1:]), F.lit(1).cast("long"))).drop("u")


def resampled_sql(rows: str, key: str, draws: int, seed: int) -> str:
    """The rows of ``resampled`` in SQL."""
    weight = " + ".join(f"(u >= {t})::BIGINT" for t in POISSON)
    return f"(SELECT * FROM (SELECT *, {weight} AS w FROM (SELECT *, ('0x' || substr(md5('{seed}:' || b || ':' || ({key})), 1, 8))::UBIGINT AS u FROM {rows}, range({draws}) t(b))) WHERE w > 0)"


def gini_draws(df: DataFrame, value: str, key: str, draws: int, seed: int) -> DataFrame:
    """``(b, gini)`` of each resample of ``df``. Weights are summed by value first: a draw is as many rows as there are
    different values, whatever the number of entities. Draws of nothing or of zeros drop out."""
    x = resampled(df.select(F.col(key).alias("k"), F.col(value).cast("double").alias("x")).where("x is not null"), F.col("k"), draws, seed).groupBy("b", "x").agg(F.sum("w").alias("w"))
    upto = F.sum("w").over(Window.partitionBy("b").orderBy("x").rowsBetween(Window.unboundedPreceding, -1))
    y = x.withColumn("before", F.coalesce(upto, F.lit(0))).groupBy("b").agg(F.sum("w").alias("n"), F.sum(F.col("x") * F.col("w")).alias("s"), F.sum(F.col("x") * F.col("w") * (2 * F.col("before") + F.col("w"))).alias("t"))
    return y.select("b", F.try_divide(F.col("t") - F.col("n") * F.col("s"), F.col("n") * F.col("s")).alias("gini")).where("gini is not null")
