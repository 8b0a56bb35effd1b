"""Queries p1, p3 and p4: skewed keys, references to nothing, hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundloom.functions.instants import micros
from fundloom.operators import hierarchy as h
from fundloom.operators.references import LINKS, cascade
from fundloom.operators.references import TARGETS as HELD_IN
from fundloom.operators.skew import grouped_quantiles, heavy_keys, key_totals
from fundloom.session import cut
from fundloom.sources.tables import table

SKEWED = ("funder_grant", "grant_work")


def _per_table(spark: SparkSession, root: str, f) -> DataFrame:
    a, b = (f(table(spark, root, t)).select(F.lit(t).alias("table_name"), "*") for t in SKEWED)
    return a.unionByName(b)


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    """Keys with at least 2 % of a table's rows."""
    return _per_table(spark, root, lambda t: heavy_keys(t, "src_id", 0.02)).select("table_name", F.col("key").alias("src_id"))


def p1_totals(spark: SparkSession, root: str) -> DataFrame:
    """Links per funder and per grant, null included."""
    return _per_table(spark, root, lambda t: key_totals(t, "src_id")).select("table_name", F.col("key").alias("src_id"), "rows")


def p1_quantiles(spark: SparkSession, root: str) -> DataFrame:
    """Quartiles and 95th percentile of the links' instants (seconds) per funder and per grant, by exact selection."""
    timed = lambda t: t.select("src_id", (micros(F.col("as_of")) / 1e6).alias("at"))
    out = _per_table(spark, root, lambda t: grouped_quantiles(timed(t), "src_id", "at", (0.25, 0.5, 0.75, 0.95), small=1_000))
    return out.select("table_name", F.col("key").alias("src_id"), "q", "n", "value")


def _graph(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    links = {x.table: table(spark, root, x.table, "src_id", "dst_id", "as_of") for x in LINKS}
    return links | {t: table(spark, root, t, "atlas_id", "as_of") for t in HELD_IN.values()}


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    """Distinct links to a target that is missing or came later: level 0 of the cascade."""
    return cascade(_graph(spark, root), levels=0).select("table_name", "period", "src_id", "dst_id")


def p3_cascade(spark: SparkSession, root: str) -> DataFrame:
    """Direct and inherited orphan links per table and month."""
    return cascade(_graph(spark, root)).groupBy("table_name", "period", "kind", "reason", "level").agg(F.count("*").alias("links"))


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    """Root and depth of each field."""
    return h.hierarchy(table(spark, root, "field")).select("atlas_id", "root_atlas_id", "depth")


def p4_tree(spark: SparkSession, root: str) -> DataFrame:
    """Path, depth, root and number of fields below for each field."""
    t = cut(h.hierarchy(table(spark, root, "field")))
    return t.join(h.paths(t), "atlas_id").select("atlas_id", F.array_join("path", "/").alias("path"), "depth", "root_atlas_id", "below")


def p4_below(spark: SparkSession, root: str) -> DataFrame:
    """Each field with each field below it."""
    return h.closure(cut(h.hierarchy(table(spark, root, "field"))))


QUERIES = {f.__name__: f for f in (p1_found, p1_totals, p1_quantiles, p3_found, p3_cascade, p4_found, p4_tree, p4_below)}

_US = "epoch_us(as_of::timestamptz)"
_ORPHANS = " UNION ALL ".join(
    f"""SELECT DISTINCT '{link}' AS table_name, strftime(l.as_of::timestamptz AT TIME ZONE 'UTC', '%Y-%m') AS period, l.src_id, lower(trim(l.dst_id)) AS dst_id
    FROM {link} l LEFT JOIN (SELECT atlas_id, min(as_of::timestamptz) AS first FROM {target} GROUP BY 1) t ON lower(trim(l.dst_id)) = t.atlas_id
    WHERE trim(l.dst_id) <> '' AND (t.atlas_id IS NULL OR l.as_of::timestamptz < t.first)"""
    for link, target in (("funder_grant", "grant_record"), ("grant_org", "organization"), ("grant_work", "work_record"))
)
_TREE = """WITH RECURSIVE one AS (
  SELECT atlas_id AS v, parent_atlas_id AS p FROM (SELECT *, row_number() OVER (PARTITION BY atlas_id ORDER BY as_of::timestamptz DESC, coalesce(parent_atlas_id, '') DESC) AS rn FROM field) WHERE rn = 1),
par AS (SELECT a.v, b.v AS p FROM one a LEFT JOIN one b ON a.p = b.v),
down AS (SELECT v, v AS root, 0::BIGINT AS depth, v AS path FROM par WHERE p IS NULL UNION ALL SELECT c.v, d.root, d.depth + 1, d.path || '/' || c.v FROM par c JOIN down d ON c.p = d.v)"""
_LOOSE = f"""{_TREE}, ring AS (SELECT v, p FROM par WHERE v NOT IN (SELECT v FROM down)),
  up AS (SELECT v, p AS u FROM ring UNION SELECT u.v, r.p FROM up u JOIN ring r ON u.u = r.v),
  circ AS (SELECT v FROM up WHERE u = v), named AS (SELECT v, min(u) AS least FROM up WHERE v IN (FROM circ) GROUP BY v),
  par2 AS (SELECT v, CASE WHEN v IN (FROM circ) THEN NULL ELSE p END AS p FROM par),
  tree AS (SELECT v, v AS root, 0::BIGINT AS depth, v AS path FROM par2 WHERE p IS NULL UNION ALL SELECT c.v, d.root, d.depth + 1, d.path || '/' || c.v FROM par2 c JOIN tree d ON c.p = d.v),
  walk AS (SELECT v, p AS u, 1::BIGINT AS distance FROM par2 WHERE p IS NOT NULL UNION ALL SELECT w.v, r.p, w.distance + 1 FROM walk w JOIN par2 r ON w.u = r.v WHERE r.p IS NOT NULL)"""
ORACLES = {
    "p1_found": " UNION ALL ".join(f"SELECT '{t}' AS table_name, src_id FROM {t} WHERE src_id IS NOT NULL GROUP BY 2 HAVING count(*) >= 0.02 * (SELECT count(*) FROM {t})" for t in SKEWED),
    "p1_totals": " UNION ALL ".join(f"SELECT '{t}' AS table_name, src_id, count(*) AS rows FROM {t} GROUP BY 2" for t in SKEWED),
    "p1_quantiles": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, src_id, q, n, secs AS value FROM (SELECT src_id, {_US} / 1e6 AS secs, row_number() OVER (PARTITION BY src_id ORDER BY {_US}) AS r, count(*) OVER (PARTITION BY src_id) AS n FROM {t} WHERE src_id IS NOT NULL),
        (VALUES (0.25::DOUBLE), (0.5), (0.75), (0.95)) v(q) WHERE r = greatest(1, ceil(q * n))"""
        for t in SKEWED
    ),
    "p3_found": _ORPHANS,
    "p3_cascade": f"""WITH d AS ({_ORPHANS.replace("DISTINCT ", "DISTINCT (t.atlas_id IS NULL) AS missing, ")}),
      l AS (SELECT DISTINCT 'grant_org' AS table_name, strftime(as_of::timestamptz AT TIME ZONE 'UTC', '%Y-%m') AS period, src_id, lower(trim(dst_id)) AS dst_id FROM grant_org WHERE trim(dst_id) <> ''
        UNION ALL SELECT DISTINCT 'grant_work', strftime(as_of::timestamptz AT TIME ZONE 'UTC', '%Y-%m'), src_id, lower(trim(dst_id)) FROM grant_work WHERE trim(dst_id) <> '')
      SELECT table_name, period, 'direct' AS kind, CASE WHEN missing THEN 'missing' ELSE 'early' END AS reason, 0 AS level, count(*) AS links FROM d GROUP BY ALL
      UNION ALL SELECT table_name, period, 'inherited', 'parent', 1, count(*) FROM l WHERE lower(trim(src_id)) IN (SELECT dst_id FROM d WHERE table_name = 'funder_grant' AND missing) GROUP BY ALL""",
    "p4_found": f"""{_TREE}, ring AS (SELECT v, p FROM par WHERE v NOT IN (SELECT v FROM down)),
      up AS (SELECT v, p AS u FROM ring UNION SELECT u.v, r.p FROM up u JOIN ring r ON u.u = r.v)
      SELECT v AS atlas_id, root AS root_atlas_id, depth FROM down
      UNION ALL SELECT v, min(u), -1 FROM up WHERE u IN (SELECT v FROM up WHERE v = u) GROUP BY v""",
    "p4_tree": f"""{_LOOSE} SELECT d.v AS atlas_id, d.path, CASE WHEN c.v IS NULL THEN d.depth ELSE -1 END AS depth, coalesce(c.least, d.root) AS root_atlas_id,
      (SELECT count(*) FROM walk w WHERE w.u = d.v) AS below FROM tree d LEFT JOIN named c ON c.v = d.root""",
    "p4_below": f"{_LOOSE} SELECT u AS ancestor, v AS descendant, distance FROM walk",
}
