"""Per-key results when a few keys hold most rows.

Everything here works on mergeable counts. A hot key never travels as rows to one task: it is only ever counted,
map-side first, in buckets whose number is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundloom.session import cut

BITS = 16
#: Largest lookup side, in rows of a few numbers each, that is broadcast; beyond it the join shuffles on a salted key.
BROADCAST_ROWS = 100_000


def heavy_keys(df: DataFrame, key: str, share: float, total: int | None = None) -> DataFrame:
    """Keys carried by at least ``share`` of all rows of ``df``, with their exact row count: ``(key, rows)``.

    Distributed selection over the 64-bit hash of the key. Each round counts rows in 2**16 hash buckets below the
    prefixes still open (count, least and greatest hash merge map-side), keeps the buckets that hold enough rows, and
    goes 16 bits deeper into those that still mix several hashes. At most ``1/share`` buckets stay open, so what the
    driver holds is bounded by the parameter, whatever the data. The last pass counts the real keys behind the open
    hashes, so hash collisions can't falsify a count.

    Nulls count in the total but are no key. An empty table gives no rows. Ties at the limit are all kept.
    """
    if not 0 < share <= 1:
        raise ValueError("share must lie in (0, 1]")
    rows = df.select(F.col(key).alias("key"))
    total = rows.count() if total is None else total
    none = rows.sparkSession.createDataFrame([], rows.schema).withColumn("rows", F.lit(0).cast("long"))
    if not total:
        return none
    least = share * total
    hashed = rows.where("key is not null").select(F.xxhash64("key").alias("h"))
    done: list[int] = []
    open_prefixes: list[int] | None = None
    for depth in range(BITS, 65, BITS):
        part = hashed
        if open_prefixes is not None:
            part = part.where(F.shiftright("h", 64 - depth + BITS).isin(open_prefixes))
        found = (
            part.groupBy(F.shiftright("h", 64 - depth).alias("p"))
            .agg(F.count("*").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))
            .where(F.col("n") >= least)
            .collect()
        )
        done += [r.lo for r in found if r.lo == r.hi]
        open_prefixes = [r.p for r in found if r.lo != r.hi]
        if not open_prefixes:
            break
    if not done:
        return none
    return rows.where(F.xxhash64("key").isin(done)).groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") >= least)


def key_totals(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, null as its own group: ``(key, rows)``. Partial counts leave one row per key and task to shuffle."""
    return df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("rows"))


def skew_safe_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", share: float = 0.01, keys_of: DataFrame | None = None) -> DataFrame:
    """``left`` joined to ``right``, whose ``key`` is unique, when a few keys may hold most rows of ``left``.

    Keys with at least ``share`` of the rows of ``left`` are at most ``1/share``; the matching rows of ``right`` are
    as few, so that part is broadcast. ``how`` may be a semi or anti join too (``right`` then needs no unique key). All other rows shuffle on a key that no longer is hot. Hot keys are looked for in
    the ``key`` column of ``keys_of``, the rows that ``left`` was made from where making it is dear; it is read two or
    three times, one column only. Null keys match nothing and stay where ``how`` keeps them.
    """
    hot = [r.key for r in heavy_keys(left if keys_of is None else keys_of, key, share).select("key").collect()]
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return left.where(is_hot).join(F.broadcast(right.where(is_hot)), key, how).unionByName(left.where(~is_hot).join(right.where(~is_hot), key, how))


def _folded(x: Column) -> Column:
    """A logarithm that grows with ``x`` over all doubles: 0 at zero, about 1 to 1457 in size from the least to infinity."""
    return F.when(x == 0, 0.0).otherwise(F.signum(x) * (F.least(F.log(F.abs(x)), F.lit(711.0)) + 746))


def grouped_quantiles(df: DataFrame, key: str, value: str, qs: Sequence[float], small: int = 100_000, buckets: int = 256) -> DataFrame:
    """Exact quantiles per key: ``(key, q, n, value)``, ``value`` being the element of rank ``max(1, ceil(q * n))``.

    Keys of at most ``small`` rows are ranked by a window, which is cheaper and gives the same values; a task's share is
    bounded by ``small``. A larger key is resolved by selection: its values are counted in ``buckets`` equal steps
    between its least and greatest value, the bucket that holds the wanted rank is kept with its own least and greatest
    value, and so on until that bucket holds a single value. Steps are equal in the logarithm (folded at zero, infinities
    at its ends) while the values lie more than a factor of e apart, so that far outliers cost no rounds; ten rounds
    settle any doubles. Each round moves counts only. The open intervals are at most ``len(qs) * rows / small``; they are broadcast while they are few
    (checked) and joined on a salted key beyond.

    Null keys, null values and NaN take no part. Ties count with their multiplicity. Empty input gives no rows.
    """
    rows = df.select(F.col(key).alias("key"), F.col(value).cast("double").alias("v")).where("key is not null and v is not null and not isnan(v)")
    sizes = cut(rows.groupBy("key").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    wanted = F.explode(F.array(*[F.lit(float(q)) for q in qs]))
    rank = F.greatest(F.lit(1), F.ceil(F.col("q") * F.col("n"))).cast("long")

    few = sizes.where(F.col("n") <= small).select("key", "n")
    many = sizes.where(F.col("n") > small)
    big = many.count()
    light = rows if not big else rows.join(F.broadcast(many.select("key")) if big <= BROADCAST_ROWS else many.select("key"), "key", "left_anti")
    order = Window.partitionBy("key").orderBy("v")
    ranked = light.withColumn("r", F.row_number().over(order)).withColumn("n", F.count("*").over(Window.partitionBy("key")))
    out = [ranked.withColumn("q", wanted).where(F.col("r") == rank).select("key", "q", "n", F.col("v").alias("value"))]
    if few.isEmpty():
        out = []

    targets = many.withColumn("q", wanted).withColumn("rank", rank)
    while big:
        out.append(targets.where("lo = hi").select("key", "q", "n", F.col("lo").alias("value")))
        targets = targets.where("lo < hi")
        left = targets.count()
        if not left:
            break
        if left <= BROADCAST_ROWS:
            met = rows.join(F.broadcast(targets), "key")
        else:
            salts = 64
            met = rows.withColumn("s", F.pmod(F.xxhash64("v", F.monotonically_increasing_id()), F.lit(salts))).join(targets.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).cast("long")), ["key", "s"]).drop("s")
        v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
        wide = _folded(hi) - _folded(lo) > 1
        part = F.when(wide, (_folded(v) - _folded(lo)) / (_folded(hi) - _folded(lo))).otherwise((v - lo) / (hi - lo))
        step = F.least(F.floor(part * buckets), F.lit(buckets - 1))
        counts = (
            met.where("v between lo and hi")
            .groupBy("key", "q", "n", "rank", step.alias("b"))
            .agg(F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .withColumn("upto", F.sum("c").over(Window.partitionBy("key", "q").orderBy("b")))
        )
        targets = cut(counts.where("rank <= upto and rank > upto - c").select("key", "n", "lo", "hi", "q", (F.col("rank") - F.col("upto") + F.col("c")).alias("rank")))
    return reduce(DataFrame.unionByName, out) if out else sizes.select("key", F.lit(0.0).alias("q"), "n", F.col("lo").alias("value")).limit(0)
