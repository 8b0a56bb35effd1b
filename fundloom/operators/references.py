"""References to records that do not exist, and what they drag along."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundloom.functions.instants import micros, month
from fundloom.operators.skew import skew_safe_join
from fundloom.session import cut

#: What counts as an outer blank of a key.
BLANKS = " \t\n\r\x0b\x0c\u00a0"


@dataclass(frozen=True)
class Link:
    """A table of links: its rows lead from ``src`` records to ``dst`` records."""

    table: str
    src: str
    dst: str


#: The foreign-key graph of the link tables. Funders have no table of their own.
LINKS = (Link("funder_grant", "funder", "grant"), Link("grant_org", "grant", "organization"), Link("grant_work", "grant", "work"))
TARGETS = {"grant": "grant_record", "organization": "organization", "work": "work_record"}


def norm_key(c: Column) -> Column:
    """A key without outer blanks, in lower case; null when nothing is left."""
    k = F.lower(F.btrim(c, F.lit(BLANKS)))
    return F.when(k != "", k)


def direct_orphans(links: DataFrame, targets: DataFrame, table: str) -> DataFrame:
    """Distinct links whose target is missing, or was first taken in after the link.

    ``links`` has src_id, dst_id, as_of; ``targets`` has atlas_id, as_of. Result: ``(table_name, period, src_id,
    dst_id, reason)``, reason being ``missing`` or ``early``; dst_id is trimmed and in lower case, period the UTC month
    of the link's as_of. Null and blank dst_id are no reference. A link without a readable as_of can be missing, never
    early, and has a null period. A null src_id stays null. Repeated links count once.

    Links are reduced to one row per (src, dst, month) before the join, with their earliest instant; targets to one
    row per key. The join survives a target that a third of all links name (``skew_safe_join``).
    """
    us = micros(F.col("as_of"))
    once = (
        links.select("src_id", norm_key(F.col("dst_id")).alias("dst_id"), us.alias("us"))
        .where("dst_id is not null")
        .groupBy("src_id", "dst_id", month(F.col("us")).alias("period"))
        .agg(F.min("us").alias("us"))
    )
    first = targets.where("atlas_id is not null").groupBy(F.col("atlas_id").alias("dst_id")).agg(F.min(us).alias("first"), F.lit(True).alias("held"))
    joined = skew_safe_join(once, first, "dst_id", keys_of=links.select(norm_key(F.col("dst_id")).alias("dst_id")))
    reason = F.when(F.col("held").isNull(), "missing").when(F.col("us") < F.col("first"), "early")
    return joined.select(F.lit(table).alias("table_name"), "period", "src_id", "dst_id", reason.alias("reason")).where("reason is not null")


def cascade(tables: dict[str, DataFrame], links: tuple[Link, ...] = LINKS, targets: dict[str, str] = TARGETS, levels: int | None = None, max_rounds: int = 32) -> DataFrame:
    """Direct and inherited orphans of all link tables: ``(table_name, period, src_id, dst_id, kind, reason, level)``.

    ``tables`` holds the link tables and the target tables by name; ``targets`` says which table holds an entity. Level 0
    are the direct orphans. A record that is missing makes every link that starts from it an inherited orphan; a target
    all of whose links are orphans is orphaned in turn, and its own links follow on the next level. Each round is one
    semi-join of the links with the keys found last, until no new key is found, or through ``levels``. Rounds are as many
    as the foreign-key graph is deep (circles end, since a key is found once), and each is cut from its lineage;
    RuntimeError if they are more than ``max_rounds``. A record from which a large share of all links start is no hot
    key: such keys are looked up by broadcast.
    """
    direct = {x.table: direct_orphans(tables[x.table], tables[targets[x.dst]], x.table) for x in links}
    if levels != 0:
        direct = {t: cut(d) for t, d in direct.items()}
    found = [d.select("table_name", "period", "src_id", "dst_id", F.lit("direct").alias("kind"), "reason", F.lit(0).alias("level")) for d in direct.values()]
    if levels == 0:
        return _union(found)
    plain = {x.table: cut(tables[x.table].select(norm_key(F.col("src_id")).alias("src_key"), "src_id", norm_key(F.col("dst_id")).alias("dst_id"), month(micros(F.col("as_of"))).alias("period")).where("src_key is not null and dst_id is not null").distinct()) for x in links if any(y.dst == x.src for y in links)}
    within = lambda x, keys, how: skew_safe_join(plain[x.table], keys.withColumnRenamed("key", "src_key"), "src_key", how)
    ends = {x.table: norm_key(F.col("dst_id")).alias("key") for x in links}
    frontier = {e: cut(_union([direct[x.table].where("reason = 'missing'").select(F.col("dst_id").alias("key")) for x in links if x.dst == e]).distinct()) for e in {x.dst for x in links}}
    seen = dict(frontier)
    level = 0
    while frontier and level != levels:
        level += 1
        if level > max_rounds:
            raise RuntimeError(f"orphans aren't settled after {max_rounds} rounds")
        hit = {x.table: cut(within(x, frontier[x.src], "left_semi")) for x in links if x.src in frontier}
        found += [h.select(F.lit(t).alias("table_name"), "period", "src_id", "dst_id", F.lit("inherited").alias("kind"), F.lit("parent").alias("reason"), F.lit(level).alias("level")) for t, h in hit.items()]
        after: dict[str, DataFrame] = {}
        for e in {x.dst for x in links if x.table in hit and any(y.src == x.dst for y in links)}:
            into = [x for x in links if x.dst == e]
            lost = _union([hit[x.table].select(F.col("dst_id").alias("key")) for x in into if x.table in hit]).distinct()
            alive = _union([within(x, seen[x.src], "left_anti").select(F.col("dst_id").alias("key")) if x.src in seen else tables[x.table].select(ends[x.table]) for x in into]).where("key is not null").distinct()
            after[e] = cut(lost.join(alive, "key", "left_anti").join(seen[e], "key", "left_anti"))
        frontier = {e: f for e, f in after.items() if not f.isEmpty()}
        seen |= {e: cut(seen[e].unionByName(f)) for e, f in frontier.items()}
    return _union(found)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
