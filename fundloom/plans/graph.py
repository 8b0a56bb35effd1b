"""The funding graph as a projection of the order tables, so that every operator has entities, edges and a hierarchy.

supplier = funder, orders = grant, customer = organization, part = work, region > nation > brand = domain > field > topic.
``VIEWS`` has the same projections as SQL; ``with_views`` puts those a statement needs in front of it.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundloom.sources.tables import table

SOURCES = ("nih", "nsf", "cordis", "ukri")


def _site(name: str) -> Column:
    return F.concat(F.lit("https://"), F.lower(F.replace(F.col(name), F.lit("#"))), F.lit(".example"))


class Graph:
    """Lazy views of one data folder. Nothing is cached: a query reads the columns it uses."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.root, name)

    @cached_property
    def funder(self) -> DataFrame:
        n = self.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("country_code"))
        return self.raw("supplier").join(F.broadcast(n), "s_nationkey").select(F.col("s_suppkey").alias("atlas_id"), F.col("s_name").alias("name"), F.concat(F.lit("F"), F.col("s_suppkey").cast("string")).alias("short_name"), "country_code", F.when(F.col("s_acctbal") > 0, "government").otherwise("foundation").alias("funder_type"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("https://ror.org/0f"), F.lpad(F.col("s_suppkey").cast("string"), 7, "0"))).alias("ror_id"), _site("s_name").alias("homepage"))

    @cached_property
    def grant(self) -> DataFrame:
        source = F.element_at(F.array(*[F.lit(s) for s in SOURCES]), (F.col("o_orderkey") % 4 + 1).cast("int"))
        return self.raw("orders").select(F.col("o_orderkey").alias("atlas_id"), F.col("o_totalprice").alias("amount_usd"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"), F.col("o_orderstatus").alias("status"), source.alias("source"))

    @cached_property
    def organization(self) -> DataFrame:
        n = self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country_code"))
        ror = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("https://ror.org/"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")))
        return self.raw("customer").join(F.broadcast(n), "c_nationkey").select(F.col("c_custkey").alias("atlas_id"), F.col("c_name").alias("name"), ror.alias("ror_id"), "country_code", F.col("c_mktsegment").alias("org_type"), F.concat(F.lit("City "), (F.col("c_custkey") % 97).cast("string")).alias("city"), _site("c_name").alias("homepage"))

    @cached_property
    def line(self) -> DataFrame:
        return self.raw("lineitem")

    @cached_property
    def work(self) -> DataFrame:
        use = self.line.groupBy("l_partkey").agg(F.count("*").alias("cited_by_count"), F.min(F.year("l_shipdate")).cast("long").alias("publication_year"))
        return self.raw("part").join(use, F.col("p_partkey") == F.col("l_partkey"), "left").select(F.col("p_partkey").alias("atlas_id"), F.col("p_name").alias("title"), F.concat(F.lit("10.5555/p"), F.col("p_partkey").cast("string")).alias("doi"), F.concat(F.lit("W"), F.col("p_partkey").cast("string")).alias("openalex_id"), "publication_year", F.col("p_type").alias("type"), F.coalesce("cited_by_count", F.lit(0)).alias("cited_by_count"), (F.col("p_size") % 2 == 0).alias("is_oa"))

    @cached_property
    def field(self) -> DataFrame:
        r = self.raw("region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("atlas_id"), F.col("r_name").alias("name"), F.lit("domain").alias("level"), F.lit(None).cast("string").alias("parent_atlas_id"))
        n = self.raw("nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")), F.col("n_name"), F.lit("field"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")))
        b = self.raw("part").select("p_brand").distinct().select(F.concat(F.lit("b"), F.col("p_brand")), F.col("p_brand"), F.lit("topic"), F.concat(F.lit("n"), (F.substring("p_brand", 7, 9).cast("int") % 25).cast("string")))
        return r.union(n).union(b)

    @cached_property
    def work_field(self) -> DataFrame:
        return self.raw("part").select(F.col("p_partkey").alias("src_id"), F.concat(F.lit("b"), F.col("p_brand")).alias("dst_id"), (F.col("p_size") / 50).alias("score"))

    @cached_property
    def funder_grant(self) -> DataFrame:
        return self.line.select(F.col("l_suppkey").alias("src_id"), F.col("l_orderkey").alias("dst_id")).distinct()

    @cached_property
    def grant_org(self) -> DataFrame:
        return self.raw("orders").select(F.col("o_orderkey").alias("src_id"), F.col("o_custkey").alias("dst_id"))

    @cached_property
    def grant_work(self) -> DataFrame:
        return self.line.select(F.col("l_orderkey").alias("src_id"), F.col("l_partkey").alias("dst_id")).distinct()

    @cached_property
    def person(self) -> DataFrame:
        return self.raw("events").select(F.col("user_id").alias("atlas_id")).distinct()

    @cached_property
    def grant_person(self) -> DataFrame:
        """The user of the event that has an order's number."""
        e = self.raw("events").select(F.col("event_id").alias("src_id"), F.col("user_id").alias("dst_id"), F.when(F.col("event_type").isin("click", "purchase"), "pi").otherwise("co-pi").alias("role"))
        return e.join(self.raw("orders").select(F.col("o_orderkey").alias("src_id")), "src_id", "left_semi").distinct()

    @cached_property
    def person_org(self) -> DataFrame:
        return self.person.select(F.col("atlas_id").alias("src_id"), (F.col("atlas_id") % 40 + 1).alias("dst_id"), F.lit("affiliation").alias("role"))

    @cached_property
    def citation(self) -> DataFrame:
        """``(src, dst)``: parts of one order in line order, without repeats and self links."""
        x = self.line.select("l_orderkey", F.col("l_partkey").alias("src"), F.col("l_linenumber").alias("i"))
        y = self.line.select("l_orderkey", F.col("l_partkey").alias("dst"), F.col("l_linenumber").alias("j"))
        return x.join(y, "l_orderkey").where("i < j and src <> dst").select("src", "dst").distinct()

    @cached_property
    def climb(self) -> DataFrame:
        """``(topic, field, dom)``: the hierarchy has three levels, so two joins climb it."""
        f = self.field.select("atlas_id", "name", "parent_atlas_id")
        up = lambda d, on, name: d.join(f.select(F.col("atlas_id").alias(on), F.col("name").alias(name), F.col("parent_atlas_id").alias(f"{on}_up")), on, "left")
        t = self.field.where("level = 'topic'").select(F.col("atlas_id").alias("topic"), F.col("parent_atlas_id").alias("fid"))
        return up(up(t, "fid", "field").withColumnRenamed("fid_up", "did"), "did", "dom").select("topic", "field", "dom")


VIEWS = {
    "funder": "SELECT s_suppkey AS atlas_id, s_name AS name, 'F' || s_suppkey AS short_name, n_name AS country_code, CASE WHEN s_acctbal > 0 THEN 'government' ELSE 'foundation' END AS funder_type, CASE WHEN s_suppkey % 2 = 0 THEN 'https://ror.org/0f' || lpad(s_suppkey::VARCHAR, 7, '0') END AS ror_id, 'https://' || lower(replace(s_name, '#', '')) || '.example' AS homepage FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "grants": "SELECT o_orderkey AS atlas_id, o_totalprice AS amount_usd, strftime(o_orderdate, '%Y-%m-%d') AS start_date, o_orderstatus AS status, ['nih', 'nsf', 'cordis', 'ukri'][o_orderkey % 4 + 1] AS source FROM orders",
    "org": "SELECT c_custkey AS atlas_id, c_name AS name, CASE WHEN c_custkey % 3 <> 0 THEN 'https://ror.org/' || lpad(c_custkey::VARCHAR, 9, '0') END AS ror_id, n_name AS country_code, c_mktsegment AS org_type, 'City ' || (c_custkey % 97) AS city, 'https://' || lower(replace(c_name, '#', '')) || '.example' AS homepage FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "work": "SELECT p_partkey AS atlas_id, p_name AS title, '10.5555/p' || p_partkey AS doi, 'W' || p_partkey AS openalex_id, publication_year, p_type AS type, coalesce(cited_by_count, 0) AS cited_by_count, p_size % 2 = 0 AS is_oa FROM part LEFT JOIN (SELECT l_partkey, count(*) AS cited_by_count, min(year(l_shipdate))::BIGINT AS publication_year FROM lineitem GROUP BY 1) ON p_partkey = l_partkey",
    "fields": "SELECT 'r' || r_regionkey AS atlas_id, r_name AS name, 'domain' AS level, NULL::VARCHAR AS parent_atlas_id FROM region UNION ALL SELECT 'n' || n_nationkey, n_name, 'field', 'r' || n_regionkey FROM nation UNION ALL SELECT DISTINCT 'b' || p_brand, p_brand, 'topic', 'n' || (substr(p_brand, 7)::INT % 25) FROM part",
    "work_field": "SELECT p_partkey AS src_id, 'b' || p_brand AS dst_id, p_size / 50 AS score FROM part",
    "fg": "SELECT DISTINCT l_suppkey AS src_id, l_orderkey AS dst_id FROM lineitem",
    "go": "SELECT o_orderkey AS src_id, o_custkey AS dst_id FROM orders",
    "gw": "SELECT DISTINCT l_orderkey AS src_id, l_partkey AS dst_id FROM lineitem",
    "persons": "SELECT DISTINCT user_id AS atlas_id FROM events",
    "grant_person": "SELECT DISTINCT event_id AS src_id, user_id AS dst_id, CASE WHEN event_type IN ('click', 'purchase') THEN 'pi' ELSE 'co-pi' END AS role FROM events WHERE event_id IN (SELECT o_orderkey FROM orders)",
    "person_org": "SELECT DISTINCT user_id AS src_id, user_id % 40 + 1 AS dst_id, 'affiliation' AS role FROM events",
    "citation": "SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber AND a.l_partkey <> b.l_partkey",
    "climb": "SELECT t.atlas_id AS topic, f.name AS field, d.name AS dom FROM fields t LEFT JOIN fields f ON t.parent_atlas_id = f.atlas_id LEFT JOIN fields d ON f.parent_atlas_id = d.atlas_id WHERE t.level = 'topic'",
}
_NEEDS = {"climb": ("fields",)}


def with_views(sql: str) -> str:
    """``sql`` with the views it names in front. A statement may bring its own leading WITH."""
    wanted: list[str] = []
    for v in VIEWS:
        if re.search(rf"\b{v}\b", sql):
            wanted += [x for x in (*_NEEDS.get(v, ()), v) if x not in wanted]
    ctes = ", ".join(f"{v} AS ({VIEWS[v]})" for v in wanted)
    rest = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql)
    if not wanted:
        return sql
    return f"WITH {'RECURSIVE ' if rest and rest[1] else ''}{ctes}, {sql[rest.end():]}" if rest else f"WITH {ctes} {sql}"
