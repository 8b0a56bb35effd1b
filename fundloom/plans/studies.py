"""Concentration and specialisation: the studies of money and portfolios (``people`` has those of careers)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundloom.operators.pairs import met_in_blocks
from fundloom.operators.ranks import concentration, gini_draws, lorenz, resampled, resampled_sql, spearman
from fundloom.plans.graph import Graph, with_views
from fundloom.plans.named import _FWF, EARLY, LATE, _funders_of_works, _ids, _path, org_grant_counts
from fundloom.sources.tables import table

def gini_hhi_topshare(s: SparkSession, d: str) -> DataFrame:
    return concentration(org_grant_counts(Graph(s, d)), "grants", "org_id")


def lorenz_curve(s: SparkSession, d: str) -> DataFrame:
    return lorenz(org_grant_counts(Graph(s, d)), "grants", "org_id")


def gini_bootstrap(s: SparkSession, d: str, draws: int = 2000) -> DataFrame:
    """Percentile interval of the Gini of institutions' grant counts."""
    g = gini_draws(org_grant_counts(Graph(s, d)), "grants", "org_id", draws, 1234)
    return g.agg(F.round(F.percentile("gini", 0.025), 6).alias("lo"), F.round(F.percentile("gini", 0.975), 6).alias("hi"))


def funder_field_matrix(s: SparkSession, d: str) -> DataFrame:
    """Works per funder and field. A work's funders are one array until its fields are known; what moves then are counts."""
    g = Graph(s, d)
    fields = _ids(g.work_field, "work_id", "topic").join(g.climb.select("topic", "field"), "topic").select("work_id", "field").distinct()
    return _funders_of_works(g).join(fields, "work_id").select(F.explode("funders").alias("funder_id"), "field").groupBy("funder_id", "field").agg(F.count("*").alias("works"))


def _shares(m: DataFrame) -> DataFrame:
    return m.withColumn("share", F.col("works") / F.sum("works").over(Window.partitionBy("funder_id")))


def specialization(s: SparkSession, d: str, least: int = 20) -> DataFrame:
    """From generalists to specialists: HHI of a funder's fields and its first field, of funders with ``least`` works."""
    x = _shares(funder_field_matrix(s, d))
    top = F.min_by(F.struct("field", "share"), F.struct(-F.col("works"), F.col("field")))
    a = x.groupBy("funder_id").agg(F.sum("works").alias("works"), F.sum(F.col("share") * F.col("share")).alias("h"), top.alias("top"), F.count("*").alias("fields")).where(F.col("works") >= least)
    named = a.join(Graph(s, d).funder.select(F.col("atlas_id").alias("funder_id"), "country_code"), "funder_id")
    return named.select("funder_id", "country_code", "works", F.round("h", 6).alias("hhi"), F.col("top.field").alias("top_field"), F.round("top.share", 6).alias("top_share"), "fields")


def _vectors(m: DataFrame) -> DataFrame:
    """``(funder_id, fields, works, norm)``: a row per funder; a field without a name counts in the norm only."""
    told = F.when(F.col("field").isNotNull(), F.struct("field", "works"))
    v = m.where("funder_id is not null").groupBy("funder_id").agg(F.array_sort(F.collect_list(told)).alias("x"), F.sqrt(F.sum(F.col("works") * F.col("works"))).alias("norm"))
    return v.select("funder_id", F.col("x.field").alias("fields"), F.col("x.works").alias("works"), "norm")


def _products(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of the vectors that share a field, smaller id first, and their cosines."""
    names = sorted({f for x in (a, b) for fields in x["fields"] for f in fields})
    place = {f: i for i, f in enumerate(names)}

    def dense(x: pd.DataFrame) -> np.ndarray:
        out = np.zeros((len(x), len(names)))
        for row, (fields, works, norm) in enumerate(zip(x["fields"], x["works"], x["norm"], strict=True)):
            out[row, [place[f] for f in fields]] = np.asarray(works, float) / norm
        return out

    c = dense(a) @ dense(b).T
    i, j = np.nonzero((c > 0) & (a["funder_id"].to_numpy()[:, None] < b["funder_id"].to_numpy()[None, :]))
    return i, j, c[i, j]


def funder_cosine(s: SparkSession, d: str) -> DataFrame:
    """All pairs of funders with a common field by cosine of their field vectors, block by block: pairs are written, never
    shuffled."""

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        i, j, c = _products(a, b)
        return pd.DataFrame({"a": a["funder_id"].to_numpy()[i], "b": b["funder_id"].to_numpy()[j], "cosine": c})

    return met_in_blocks(_vectors(funder_field_matrix(s, d)), "funder_id", run, "a long, b long, cosine double").select("a", "b", F.round("cosine", 6).alias("cosine"))


def cluster_cosine(s: SparkSession, d: str) -> DataFrame:
    """Mean cosine between, and within, the types of funders. A block of pairs gives its sums only."""
    t = Graph(s, d).funder.select(F.col("atlas_id").alias("funder_id"), F.col("funder_type").alias("type"))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        i, j, c = _products(a, b)
        types, at = np.unique(np.concatenate([a["type"].to_numpy(str), b["type"].to_numpy(str)]), return_inverse=True)
        x, y = at[: len(a)][i], at[len(a) :][j]
        kind = np.minimum(x, y) * len(types) + np.maximum(x, y)
        n, total = np.bincount(kind, minlength=len(types) ** 2), np.bincount(kind, np.round(c, 6), minlength=len(types) ** 2)
        k = np.flatnonzero(n)
        return pd.DataFrame({"type_a": types[k // len(types)], "type_b": types[k % len(types)], "pairs": n[k], "total": total[k]})

    sums = met_in_blocks(_vectors(funder_field_matrix(s, d)).join(t, "funder_id"), "funder_id", run, "type_a string, type_b string, pairs long, total double")
    return sums.groupBy("type_a", "type_b").agg(F.sum("pairs").alias("pairs"), F.round(F.sum("total") / F.sum("pairs"), 6).alias("mean_cosine"))


def stability(s: SparkSession, d: str, least: int = 20) -> DataFrame:
    """Whether funders' specialisation lasts: their HHI in two windows (``least`` works in each), ordinal Spearman,
    Pearson, and how far it moves."""
    g = Graph(s, d)
    y = F.col("publication_year")
    window = F.when(y.between(*EARLY), "early").when(y.between(*LATE), "late")
    w = g.work.select(F.col("atlas_id").alias("work_id"), window.alias("window")).where("window is not null")
    x = _path(g).select("funder_id", "work_id", "field_id").distinct().join(w, "work_id").join(g.climb.select(F.col("topic").alias("field_id"), "field"), "field_id")
    n = x.groupBy("funder_id", "window", "field").agg(F.count_distinct("work_id").cast("double").alias("n"))
    h = n.groupBy("funder_id", "window").agg(F.sum("n").alias("works"), (F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("hhi")).where(F.col("works") >= least)
    both = h.groupBy("funder_id").agg(F.max(F.when(F.col("window") == "early", F.col("hhi"))).alias("early"), F.max(F.when(F.col("window") == "late", F.col("hhi"))).alias("late")).where("early is not null and late is not null")
    moved = both.agg(F.round(F.avg(F.abs(F.col("late") - F.col("early"))), 6).alias("mean_delta"), F.round(F.max(F.abs(F.col("late") - F.col("early"))), 6).alias("max_delta"))
    return spearman(both, "early", "late", "funder_id").crossJoin(moved)  # one row each


def domain_by_year(s: SparkSession, d: str) -> DataFrame:
    g = Graph(s, d)
    x = g.work.select(F.col("atlas_id").alias("work_id"), F.col("publication_year").alias("year")).where("year is not null").join(_ids(g.work_field, "work_id", "topic"), "work_id").join(g.climb, "topic")
    n = x.groupBy("year", F.col("dom").alias("domain")).agg(F.count_distinct("work_id").alias("works"))
    return n.withColumn("share", F.round(F.col("works") / F.sum("works").over(Window.partitionBy("year")), 6))


def family_mix(s: SparkSession, d: str) -> DataFrame:
    """Each type of funder's works by domain, and the domain's share."""
    g = Graph(s, d)
    x = _path(g).select("funder_id", "field_id", "work_id").distinct().join(g.funder.select(F.col("atlas_id").alias("funder_id"), "funder_type"), "funder_id").join(g.climb.withColumnRenamed("topic", "field_id"), "field_id")
    n = x.groupBy("funder_type", F.col("dom").alias("domain")).agg(F.count_distinct("work_id").alias("works"))
    return n.withColumn("share", F.round(F.col("works") / F.sum("works").over(Window.partitionBy("funder_type")), 6))


def source_series(s: SparkSession, d: str, source: str = "nsf") -> DataFrame:
    """Domain shares by year within the works of one source's grants."""
    g = Graph(s, d)
    grants = g.grant.where(F.col("source") == source).select(F.col("atlas_id").alias("grant_id"))
    works = _ids(g.grant_work, "grant_id", "work_id").join(grants, "grant_id", "left_semi").select("work_id").distinct()
    x = works.join(g.work.select(F.col("atlas_id").alias("work_id"), F.col("publication_year").alias("year")).where("year is not null"), "work_id").join(_ids(g.work_field, "work_id", "topic"), "work_id").join(g.climb, "topic")
    n = x.groupBy("year", F.col("dom").alias("domain")).agg(F.count_distinct("work_id").alias("works"))
    return n.withColumn("share", F.round(F.col("works") / F.sum("works").over(Window.partitionBy("year")), 6))


def composition_shift(s: SparkSession, d: str, draws: int = 200) -> DataFrame:
    """Percentage points by which each domain's share changed between the windows, with a percentile interval over
    resampled works. Works are counted by domain and window in each draw, so draws are small."""
    g = Graph(s, d)
    y = F.col("publication_year")
    x = g.work.select(F.col("atlas_id").alias("work_id"), y.between(*EARLY).alias("e"), y.between(*LATE).alias("l")).where("e or l").join(_ids(g.work_field, "work_id", "topic"), "work_id").join(g.climb.select("topic", F.col("dom").alias("domain")), "topic")
    both = x.select("work_id", "domain", "e", "l", F.lit(-1).cast("long").alias("b"), F.lit(1).cast("long").alias("w")).unionByName(resampled(x.select("work_id", "domain", "e", "l"), F.col("work_id"), draws, 7))
    n = both.groupBy("b", "domain").agg(F.sum(F.when(F.col("e"), F.col("w")).otherwise(0)).alias("e"), F.sum(F.when(F.col("l"), F.col("w")).otherwise(0)).alias("l"))
    w = Window.partitionBy("b")  # a row per domain
    moved = n.select("b", "domain", (100 * (F.try_divide("l", F.sum("l").over(w)) - F.try_divide("e", F.sum("e").over(w)))).alias("pp"))
    drawn = F.when(F.col("b") >= 0, F.col("pp"))
    return moved.groupBy("domain").agg(F.round(F.max(F.when(F.col("b") < 0, F.col("pp"))), 4).alias("shift_pp"), F.round(F.percentile(drawn, 0.025), 4).alias("lo"), F.round(F.percentile(drawn, 0.975), 4).alias("hi"))


def grants_per_org(s: SparkSession, d: str) -> DataFrame:
    n = Graph(s, d).grant_org.groupBy("dst_id").agg(F.count("*").alias("grants"))
    return n.groupBy("grants").agg(F.count("*").alias("orgs"))


def multi_funder(s: SparkSession, d: str) -> DataFrame:
    n = Graph(s, d).funder_grant.groupBy("dst_id").agg(F.count("*").alias("funders"))
    return n.agg(F.count("*").alias("grants"), F.sum((F.col("funders") > 1).cast("long")).alias("multi"), F.round(F.avg((F.col("funders") > 1).cast("double")), 6).alias("share"), F.median("funders").alias("median"), F.max("funders").alias("most"))


def stratified_sample(s: SparkSession, d: str) -> DataFrame:
    """Forty documents per source, drawn by hash: a sampling operator."""
    x = table(s, d, "documents", "doc_id", "source")
    h = F.md5(F.concat_ws(":", F.lit("7"), F.col("doc_id").cast("string")))
    return x.withColumn("rn", F.row_number().over(Window.partitionBy("source").orderBy(h, "doc_id"))).where("rn <= 40").select("doc_id", "source")


def tranche(s: SparkSession, d: str) -> DataFrame:
    """The most cited hundred works per field and the first tranche each belongs to."""
    g = Graph(s, d)
    x = _ids(g.work_field, "work_id", "field_id").join(g.work.select(F.col("atlas_id").alias("work_id"), "cited_by_count"), "work_id")
    r = x.withColumn("rn", F.row_number().over(Window.partitionBy("field_id").orderBy(F.desc("cited_by_count"), "work_id"))).where("rn <= 100")
    return r.select("field_id", "work_id", F.when(F.col("rn") <= 10, 1).when(F.col("rn") <= 30, 2).otherwise(3).alias("tranche"))


_ALL = (
    gini_hhi_topshare, lorenz_curve, gini_bootstrap, funder_field_matrix, specialization, funder_cosine, cluster_cosine, stability, domain_by_year, family_mix, source_series, composition_shift, grants_per_org, multi_funder,
    stratified_sample, tranche,
)
QUERIES = {f.__name__: f for f in _ALL}

_COUNTS = "SELECT o.atlas_id AS k, count(DISTINCT g.atlas_id) AS x FROM go JOIN grants g ON go.src_id = g.atlas_id JOIN org o ON go.dst_id = o.atlas_id WHERE substr(start_date, 1, 4) BETWEEN '1995' AND '2001' AND source IN ('nih', 'nsf', 'cordis') AND ror_id IS NOT NULL GROUP BY 1"
_MATRIX = f"SELECT fg.src_id AS funder_id, c.field, count(DISTINCT gw.dst_id) AS works FROM {_FWF} JOIN climb c ON c.topic = wf.dst_id GROUP BY 1, 2"
_COSINE = f"WITH m AS ({_MATRIX}), n AS (SELECT funder_id, sqrt(sum(works * works)) AS n FROM m GROUP BY 1), cos AS (SELECT a.funder_id AS a, b.funder_id AS b, round(sum(a.works * b.works / (na.n * nb.n)), 6) AS cosine FROM m a JOIN m b ON a.field = b.field AND a.funder_id < b.funder_id JOIN n na ON na.funder_id = a.funder_id JOIN n nb ON nb.funder_id = b.funder_id GROUP BY 1, 2)"
_SHIFT = "SELECT w.atlas_id AS id, dom, publication_year = 1995 AS e, publication_year BETWEEN 1996 AND 2001 AS l FROM work w JOIN work_field wf ON wf.src_id = w.atlas_id JOIN climb c ON c.topic = wf.dst_id WHERE publication_year BETWEEN 1995 AND 2001"


_SQL = {
    "gini_hhi_topshare": f"WITH c AS ({_COUNTS}), r AS (SELECT x, row_number() OVER (ORDER BY x, k) AS i, count(*) OVER () AS n FROM c) SELECT count(*) AS n, sum(x)::BIGINT AS total, round(sum((2 * i - n - 1) * x) / (sum(x) * max(n)), 6) AS gini, round(sum(x * x) / (sum(x)::DOUBLE * sum(x)), 8) AS hhi, " + ", ".join(f"round(sum(x) FILTER (WHERE i > n - greatest(1, ceil(n * {s}))) / sum(x), 6) AS top_{round(s * 100)}" for s in (0.01, 0.05, 0.10)) + " FROM r",
    "lorenz_curve": f"WITH c AS ({_COUNTS}), r AS (SELECT row_number() OVER w AS i, sum(x) OVER w AS upto, sum(x) OVER () AS total, count(*) OVER () AS n FROM c WINDOW w AS (ORDER BY x, k ROWS UNBOUNDED PRECEDING)) SELECT step, round(upto / total, 6) AS share FROM r, range(1, 21) t(step) WHERE i = floor(step * n / 20)",
    "gini_bootstrap": f"""WITH v AS (SELECT b, x, sum(w)::BIGINT AS w FROM {resampled_sql(f"({_COUNTS})", "k", 2000, 1234)} GROUP BY 1, 2),
      c AS (SELECT b, x, w, coalesce(sum(w) OVER (PARTITION BY b ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM v), g AS (SELECT b, (sum(x * w * (2 * before + w)) - sum(w) * sum(x * w))::DOUBLE / (sum(w) * sum(x * w)) AS gini FROM c GROUP BY 1)
      SELECT round(quantile_cont(gini, 0.025), 6) AS lo, round(quantile_cont(gini, 0.975), 6) AS hi FROM g""",
    "funder_field_matrix": _MATRIX,
    "specialization": f"SELECT funder_id, country_code, works, hhi, top_field, top_share, fields FROM (SELECT funder_id, sum(works)::BIGINT AS works, round(sum(share * share), 6) AS hhi, first(field ORDER BY works DESC, field) AS top_field, round(max(share), 6) AS top_share, count(*) AS fields FROM (SELECT *, works / sum(works) OVER (PARTITION BY funder_id) AS share FROM ({_MATRIX})) GROUP BY 1) JOIN funder u ON u.atlas_id = funder_id WHERE works >= 20",
    "funder_cosine": f"{_COSINE} SELECT * FROM cos",
    "cluster_cosine": f"{_COSINE} SELECT least(x.funder_type, y.funder_type) AS type_a, greatest(x.funder_type, y.funder_type) AS type_b, count(*) AS pairs, round(avg(cosine), 6) AS mean_cosine FROM cos JOIN funder x ON x.atlas_id = a JOIN funder y ON y.atlas_id = b GROUP BY 1, 2",
    "stability": f"""WITH n AS (SELECT fg.src_id AS funder_id, c.field, CASE WHEN publication_year = 1995 THEN 'e' ELSE 'l' END AS era, count(DISTINCT w.atlas_id) AS n FROM {_FWF} JOIN work w ON w.atlas_id = gw.dst_id JOIN climb c ON c.topic = wf.dst_id WHERE publication_year BETWEEN 1995 AND 2001 GROUP BY 1, 2, 3),
      h AS (SELECT funder_id, era, sum(n * n)::DOUBLE / (sum(n) * sum(n)) AS hhi FROM n GROUP BY 1, 2 HAVING sum(n) >= 20), x AS (SELECT a.funder_id, a.hhi AS e, b.hhi AS l FROM h a JOIN h b ON a.funder_id = b.funder_id WHERE a.era = 'e' AND b.era = 'l'),
      r AS (SELECT e, l, row_number() OVER (ORDER BY e, funder_id) AS re, row_number() OVER (ORDER BY l, funder_id) AS rl FROM x) SELECT count(*) AS n, round(corr(re, rl), 6) AS spearman, round(corr(e, l), 6) AS pearson, round(avg(abs(l - e)), 6) AS mean_delta, round(max(abs(l - e)), 6) AS max_delta FROM r""",
    "domain_by_year": "SELECT *, round(works / sum(works) OVER (PARTITION BY year), 6) AS share FROM (SELECT publication_year AS year, dom AS domain, count(DISTINCT w.atlas_id) AS works FROM work w JOIN work_field wf ON wf.src_id = w.atlas_id JOIN climb c ON c.topic = wf.dst_id WHERE publication_year IS NOT NULL GROUP BY 1, 2)",
    "family_mix": f"SELECT *, round(works / sum(works) OVER (PARTITION BY funder_type), 6) AS share FROM (SELECT funder_type, dom AS domain, count(DISTINCT gw.dst_id) AS works FROM {_FWF} JOIN funder u ON u.atlas_id = fg.src_id JOIN climb c ON c.topic = wf.dst_id GROUP BY 1, 2)",
    "source_series": "SELECT *, round(works / sum(works) OVER (PARTITION BY year), 6) AS share FROM (SELECT publication_year AS year, dom AS domain, count(DISTINCT w.atlas_id) AS works FROM work w JOIN work_field wf ON wf.src_id = w.atlas_id JOIN climb c ON c.topic = wf.dst_id WHERE publication_year IS NOT NULL AND w.atlas_id IN (SELECT gw.dst_id FROM gw JOIN grants g ON g.atlas_id = gw.src_id WHERE source = 'nsf') GROUP BY 1, 2)",
    "composition_shift": f"""WITH y AS ({_SHIFT}), n AS (SELECT b, dom, coalesce(sum(w) FILTER (WHERE e), 0) AS e, coalesce(sum(w) FILTER (WHERE l), 0) AS l FROM (SELECT -1 AS b, dom, e, l, 1 AS w FROM y UNION ALL SELECT b, dom, e, l, w FROM {resampled_sql("y", "id", 200, 7)}) GROUP BY 1, 2),
      m AS (SELECT b, dom, 100 * (l / nullif(sum(l) OVER (PARTITION BY b), 0) - e / nullif(sum(e) OVER (PARTITION BY b), 0)) AS pp FROM n)
      SELECT dom AS domain, round(max(pp) FILTER (WHERE b < 0), 4) AS shift_pp, round(quantile_cont(pp, 0.025) FILTER (WHERE b >= 0), 4) AS lo, round(quantile_cont(pp, 0.975) FILTER (WHERE b >= 0), 4) AS hi FROM m GROUP BY 1""",
    "grants_per_org": "SELECT grants, count(*) AS orgs FROM (SELECT dst_id, count(*) AS grants FROM go GROUP BY 1) GROUP BY 1",
    "multi_funder": "SELECT count(*) AS grants, count(*) FILTER (WHERE n > 1) AS multi, round(avg((n > 1)::INT), 6) AS share, median(n) AS median, max(n) AS most FROM (SELECT dst_id, count(*) AS n FROM fg GROUP BY 1)",
    "stratified_sample": "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('7:' || doc_id), doc_id) AS rn FROM documents) WHERE rn <= 40",
    "tranche": "SELECT field_id, work_id, CASE WHEN rn <= 10 THEN 1 WHEN rn <= 30 THEN 2 ELSE 3 END AS tranche FROM (SELECT wf.dst_id AS field_id, w.atlas_id AS work_id, row_number() OVER (PARTITION BY wf.dst_id ORDER BY cited_by_count DESC, w.atlas_id) AS rn FROM work_field wf JOIN work w ON w.atlas_id = wf.src_id) WHERE rn <= 100",
}
ORACLES = {k: with_views(v) for k, v in _SQL.items()}
