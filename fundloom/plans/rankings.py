"""Citation graph, text retrieval, evaluation and resolution as queries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundloom.functions import text
from fundloom.operators import ranking, resolve
from fundloom.operators.ranks import concentration, global_order, resampled, resampled_sql
from fundloom.plans.graph import Graph, with_views
from fundloom.plans.named import _ids
from fundloom.plans.quality import NAME_PARTS, norm_sql, tokens_sql
from fundloom.session import cut
from fundloom.sources.tables import table

#: Iterations of the SQL twin of PageRank, by which it has settled to more digits than are compared.
ITERATIONS = 40


def citation_edges(s: SparkSession, d: str) -> DataFrame:
    return Graph(s, d).citation


def degrees(s: SparkSession, d: str) -> DataFrame:
    g = Graph(s, d)
    out, into = g.citation.groupBy("src").agg(F.count("*").alias("out_degree")), g.citation.groupBy("dst").agg(F.count("*").alias("in_degree"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return g.raw("part").select(F.col("p_partkey").alias("node")).join(out.withColumnRenamed("src", "node"), "node", "left").join(into.withColumnRenamed("dst", "node"), "node", "left").select("node", zero("out_degree"), zero("in_degree"))


def _pagerank(s: SparkSession, d: str) -> DataFrame:
    g = Graph(s, d)
    return ranking.pagerank(g.raw("part").select(F.col("p_partkey").alias("node")), cut(g.citation))


def pagerank(s: SparkSession, d: str) -> DataFrame:
    """PageRank of every work, to a tolerance of 1e-10."""
    return _pagerank(s, d).select("node", F.round("rank", 8).alias("rank"))


def graph_counts(s: SparkSession, d: str) -> DataFrame:
    """Raw references, repeats and self links included, against distinct edges within the corpus."""
    g = Graph(s, d)
    n = g.line.groupBy("l_orderkey").agg(F.count("*").alias("n")).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("n_edges_total"))
    return n.crossJoin(g.citation.agg(F.count("*").alias("n_edges_in_corpus"))).withColumn("coverage", F.round(F.try_divide("n_edges_in_corpus", "n_edges_total"), 6))  # one row each


def uniformity(s: SparkSession, d: str) -> DataFrame:
    """How far PageRank is from uniform: spread, Gini, first rank against a uniform one, mass of the first percent."""
    n = cut(_pagerank(s, d).select("node", F.col("rank").alias("x")))
    c = concentration(n, "x", "node")
    r = lambda c: F.round(c, 8)
    m = n.agg(r(F.min("x")).alias("min"), r(F.max("x")).alias("max"), r(F.avg("x")).alias("mean"), r(F.stddev_pop("x")).alias("std"), F.round(F.stddev_pop("x") / F.avg("x"), 6).alias("cv"), F.round(F.max("x") * F.count("*"), 5).alias("top1_over_uniform"))
    return m.crossJoin(c.select("n", "gini", F.col("top_1").alias("top1pct_mass")))  # one row each


def field_normalized_impact(s: SparkSession, d: str) -> DataFrame:
    g = Graph(s, d)
    w = g.work.join(_ids(g.work_field, "atlas_id", "field_id"), "atlas_id")
    mean = F.avg("cited_by_count").over(Window.partitionBy("field_id", "publication_year"))
    return w.select("atlas_id", "field_id", "publication_year", F.round(F.when(mean > 0, F.col("cited_by_count") / mean).otherwise(0.0), 6).alias("impact"))


def coupling_topk(s: SparkSession, d: str) -> DataFrame:
    g = Graph(s, d)
    return ranking.coupling(g.citation, g.raw("part").where("p_partkey % 50 = 0").select(F.col("p_partkey").alias("node")))


def interdisciplinarity(s: SparkSession, d: str) -> DataFrame:
    g = Graph(s, d)
    f = _ids(g.work_field, "node", "topic").join(g.climb, "topic").select("node", "dom")
    x = g.citation.join(f.select(F.col("node").alias("src"), F.col("dom").alias("a")), "src").join(f.select(F.col("node").alias("dst"), F.col("dom").alias("b")), "dst")
    return x.groupBy(F.col("a").alias("domain")).agg(F.count("*").alias("refs"), F.round(F.avg((F.col("a") != F.col("b")).cast("double")), 6).alias("cross_share"))


def _docs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents", "doc_id", "text")


def tfidf_norms(s: SparkSession, d: str) -> DataFrame:
    """Vocabulary size and weight sums per document."""
    return ranking.tfidf(_docs(s, d)).groupBy("doc_id").agg(F.count("*").alias("terms"), F.round(F.sum("weight"), 5).alias("weight"), F.round(F.max("weight"), 6).alias("top"))


def tfidf_topk(s: SparkSession, d: str) -> DataFrame:
    docs = _docs(s, d)
    return ranking.sparse_topk(ranking.tfidf(docs), docs.where("doc_id % 50 = 0"), 5).select("query", "pos", "score")


def latent_topk(s: SparkSession, d: str) -> DataFrame:
    """Nearest documents in the latent space of the TF-IDF matrix."""
    v = ranking.latent_vectors(ranking.tfidf(_docs(s, d))).withColumnRenamed("doc_id", "vec_id")
    return ranking.cosine_topk(v, v.where("vec_id % 50 = 0"), 5)


def ppmi(s: SparkSession, d: str) -> DataFrame:
    return ranking.ppmi(ranking.cooccurrence(_docs(s, d))).select("a", "b", "n", F.round("ppmi", 5).alias("ppmi"))


def word_vectors(s: SparkSession, d: str) -> DataFrame:
    """Word vectors of the words that at least five documents hold."""
    return ranking.word_vectors(ranking.ppmi(ranking.cooccurrence(_docs(s, d))))


def document_vectors(s: SparkSession, d: str) -> DataFrame:
    """Each document as the mean of its words' vectors."""
    return ranking.document_vectors(_docs(s, d), word_vectors(s, d))


def _vectors(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "embeddings", "vec_id", "embedding", "label")


def cosine_knn(s: SparkSession, d: str) -> DataFrame:
    v = _vectors(s, d)
    return ranking.cosine_topk(v, v.where("vec_id % 50 = 0"), 10)


def _metrics(v: DataFrame) -> DataFrame:
    every = ranking.cosine_topk(v, v.where("vec_id % 50 = 0"), None).select("query", F.col("vec_id").alias("item"), "pos")
    lab = v.select("vec_id", "label")
    gold = lab.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), "label").join(lab.select(F.col("vec_id").alias("item"), "label"), "label").where("query <> item").select("query", "item")
    return ranking.metrics(every, gold)


def retrieval_metrics(s: SparkSession, d: str) -> DataFrame:
    """Average precision, reciprocal rank and recall of the query vectors' label, over all other vectors ranked."""
    return _metrics(_vectors(s, d))


def evaluation(s: SparkSession, d: str, draws: int = 2000) -> DataFrame:
    """Means of the metrics over all queries, and a percentile interval of the mean average precision."""
    m = cut(retrieval_metrics(s, d))
    maps = resampled(m, F.col("query"), draws, 3).groupBy("b").agg((F.sum(F.col("ap") * F.col("w")) / F.sum("w")).alias("map"))
    mean = m.agg(F.count("*").alias("queries"), F.round(F.avg("ap"), 6).alias("map"), F.round(F.avg("rr"), 6).alias("mrr"), *[F.round(F.avg(f"recall_{k}"), 6).alias(f"recall_{k}") for k in (5, 10, 20, 50)])
    return mean.crossJoin(maps.agg(F.round(F.percentile("map", 0.025), 6).alias("map_lo"), F.round(F.percentile("map", 0.975), 6).alias("map_hi")))  # one row each


def dense_sample(s: SparkSession, d: str) -> DataFrame:
    """The 200 works that are cited most from within the corpus."""
    return Graph(s, d).citation.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("in_degree")).orderBy(F.desc("in_degree"), "node").limit(200)


def _split(s: SparkSession, d: str) -> DataFrame:
    """References of works divisible by 50 with at least five of them; three in ten (one at least) are held out."""
    g = Graph(s, d)
    e = g.citation.where("src % 50 = 0")
    h = F.md5(F.concat_ws(":", F.lit("0"), F.col("src").cast("string"), F.col("dst").cast("string")))
    w = Window.partitionBy("src")
    return e.select("src", "dst", F.row_number().over(w.orderBy(h, "dst")).alias("rn"), F.count("*").over(w).alias("n")).where("n >= 5").select("src", "dst", (F.col("rn") <= F.greatest(F.lit(1), F.bround(F.col("n") * 0.3))).alias("held"))


def split_and_rank(s: SparkSession, d: str) -> DataFrame:
    """Rank of each held-out reference by popularity, the query itself and its visible references left out."""
    g = Graph(s, d)
    x = _split(s, d)
    # Its rank among all, less the query's own and visible references above it. A query's references are few.
    pop = global_order(g.citation.groupBy("dst").agg(F.count("*").alias("c")), F.desc("c"), F.asc("dst")).select("dst", "rank")
    own = x.select("src").distinct().select("src", F.col("src").alias("dst"), F.lit(False).alias("held"))
    out = x.unionByName(own).join(pop, "dst").withColumn("above", F.sum((~F.col("held")).cast("long")).over(Window.partitionBy("src").orderBy("rank")))
    return out.where("held").select(F.col("src").alias("query"), F.col("dst").alias("item"), (F.col("rank") - F.col("above")).alias("pos"))


def paired_bootstrap(s: SparkSession, d: str, draws: int = 2000) -> DataFrame:
    """Whether whole vectors rank better than their first sixteen coordinates: difference of mean average precision, and
    how often it falls to zero or below over resampled queries."""
    v = _vectors(s, d)
    less = _metrics(v.withColumn("embedding", F.slice("embedding", 1, 16))).select("query", F.col("ap").alias("less"))
    m = cut(_metrics(v).join(less, "query").select("query", (F.col("ap") - F.col("less")).alias("diff")))
    means = resampled(m, F.col("query"), draws, 0).groupBy("b").agg((F.sum(F.col("diff") * F.col("w")) / F.sum("w")).alias("mean"))
    return means.agg(F.round(F.avg((F.col("mean") <= 0).cast("double")), 6).alias("p")).crossJoin(m.agg(F.round(F.avg("diff"), 6).alias("delta_map")))  # one row each


def sign_test(s: SparkSession, d: str) -> DataFrame:
    """Exact two-sided sign test: in how many domains works of even id are cited more than the others."""
    g = Graph(s, d)
    x = g.work.select(F.col("atlas_id").alias("node"), "cited_by_count").join(_ids(g.work_field, "node", "field_id"), "node")
    f = x.groupBy("field_id").agg(F.avg(F.when(F.col("node") % 2 == 0, F.col("cited_by_count"))).alias("a"), F.avg(F.when(F.col("node") % 2 == 1, F.col("cited_by_count"))).alias("b")).where("a <> b")
    r = f.agg(F.sum((F.col("a") > F.col("b")).cast("long")).alias("wins"), F.count("*").alias("n")).first()
    return s.createDataFrame([(r.wins, r.n, round(sign_p(r.wins, r.n), 6))], "wins bigint, n bigint, p double")


def sign_p(wins: int, n: int) -> float:
    if not n:
        return 1.0
    k = min(wins, n - wins)
    return min(1.0, 2 * sum(math.comb(n, i) for i in range(k + 1)) / 2**n)


# Resolution -----------------------------------------------------------------------------------------------------------


def _register(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "registry_org")
    other = r.select("reg_id", F.explode(F.split("other_names", ";")).alias("name"), "country").withColumn("name", F.btrim("name"))
    kind = F.when(F.col("name").rlike("^[A-Z]{2,8}$"), "acronym").otherwise("alias")
    names = r.select("reg_id", F.col("legal_name").alias("name"), F.lit("display").alias("kind"), "country").unionByName(other.select("reg_id", "name", kind.alias("kind"), "country"))
    code = F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv])
    return names.select(F.col("reg_id").alias("ror"), "name", "kind", F.try_element_at(code, F.upper(F.regexp_replace("country", r"[\s.]", ""))).alias("country"))


# Country codes by the ways the register writes countries.
CODES = {
    "AUSTRALIA": "AU", "AUS": "AU", "AUSTRIA": "AT", "AUT": "AT", "BRAZIL": "BR", "BRASIL": "BR", "BRA": "BR", "CANADA": "CA", "CAN": "CA", "SWITZERLAND": "CH", "SCHWEIZ": "CH", "CHE": "CH", "GERMANY": "DE", "DEUTSCHLAND": "DE", "DEU": "DE",
    "SPAIN": "ES", "ESPAÑA": "ES", "ESP": "ES", "FRANCE": "FR", "FRA": "FR", "UNITEDKINGDOM": "GB", "UK": "GB", "GBR": "GB", "INDIA": "IN", "IND": "IN", "ITALY": "IT", "ITALIA": "IT", "ITA": "IT", "JAPAN": "JP", "JPN": "JP", "KENYA": "KE", "KEN": "KE",
    "NETHERLANDS": "NL", "NEDERLAND": "NL", "NLD": "NL", "POLAND": "PL", "POLSKA": "PL", "POL": "PL", "SWEDEN": "SE", "SVERIGE": "SE", "SWE": "SE", "UNITEDSTATES": "US", "USA": "US", "SOUTHAFRICA": "ZA", "ZAF": "ZA",
}


def org_match_cascade(s: SparkSession, d: str) -> DataFrame:
    """Every institution's name against the register, with the tier that resolved it."""
    q = table(s, d, "organization", "name", "country_code").withColumnRenamed("country_code", "country")
    return resolve.match_institutions(q, resolve.register_index(_register(s, d)))


def org_exact(s: SparkSession, d: str) -> DataFrame:
    return org_match_cascade(s, d).where("method = 'exact'").select("name", "country", "ror")


def org_match_methods(s: SparkSession, d: str) -> DataFrame:
    return org_match_cascade(s, d).groupBy("method").agg(F.count("*").alias("names"), F.round(F.avg("score"), 4).alias("mean_score"))


def org_resolution(s: SparkSession, d: str) -> DataFrame:
    """Every institution's id: its own, or the one that its name is matched to, or none."""
    q = table(s, d, "organization", "name", "country_code", "ror_id").withColumnRenamed("country_code", "country")
    return resolve.resolve_institutions(q, resolve.register_index(_register(s, d)))


def award_grant_links(s: SparkSession, d: str) -> DataFrame:
    """Works that name a grant's number in another notation than the grant's source, linked to the grant; four sources."""
    g = table(s, d, "grant_record", "atlas_id", "source_id").distinct().withColumn("n", F.regexp_extract("source_id", r"(\d+)$", 1).cast("int")).withColumn("d", F.lpad(F.col("n").cast("string"), 6, "0"))
    pick = lambda *x: F.element_at(F.array(*[c if isinstance(c, Column) else F.lit(c) for c in x]), F.col("n") % 4 + 1)
    number = pick(F.concat(F.lit("5R01CA"), "d", F.lit("-0"), (F.col("n") % 9 + 1).cast("string")), F.concat(F.lit("DEB-"), "d"), F.concat(F.lit("EP/"), "d", F.lit("/1")), F.concat(F.lit("10"), "d"))
    named = pick(F.concat(F.lit("R01 CA "), "d"), F.concat(F.lit("NSF grant "), "d"), F.concat(F.lit("ep "), "d", F.lit("-1")), F.concat(F.lit("Grant agreement No. 10"), "d"))
    grants = g.select("atlas_id", pick("nih", "nsf", "ukri", "cordis").alias("source"), number.alias("source_id"))
    awards = g.select(F.concat(F.lit("w:"), "atlas_id").alias("work_id"), pick("nih", "nsf", "ukri", "ec").alias("source"), named.alias("award"))
    return resolve.link_awards(awards, grants)


def grant_modal_recipient(s: SparkSession, d: str) -> DataFrame:
    """Each grant's recipient: the role first, then frequency, then the key."""
    e = table(s, d, "grant_org", "src_id", "dst_id", "role").where("src_id is not null")
    return resolve.modal(e, "src_id", "dst_id", F.coalesce(F.col("role") == "recipient", F.lit(False)))


def grant_modal_field(s: SparkSession, d: str) -> DataFrame:
    g = Graph(s, d)
    x = _ids(g.grant_work, "grant_id", "work_id").join(_ids(g.work_field, "work_id", "topic"), "work_id").join(g.climb, "topic")
    return resolve.modal(x.select("grant_id", "field"), "grant_id", "field")


def pi_resolve(s: SparkSession, d: str) -> DataFrame:
    """People of the table against each other, as principal investigators against authors: the source stands in for the
    organisation, the length of the name for the field; every fifth shows its ORCID."""
    p = table(s, d, "person", "atlas_id", "full_name", "first_name", "last_name", "orcid", "source").distinct()
    n = F.length("full_name")
    field = lambda *x: F.element_at(F.array(*[F.lit(v).cast("string") for v in x]), F.coalesce(n % len(x), F.lit(0)) + 1)
    known = p.select(F.col("atlas_id").alias("person_id"), "full_name", "first_name", "last_name", "orcid", F.col("source").alias("org"), field("bio", "chem", None).alias("field"))
    asked = p.select(F.concat_ws("|", "atlas_id", "full_name", "first_name", "last_name", "orcid", "source").alias("qid"), "full_name", "first_name", "last_name", F.when(n % 5 == 0, F.col("orcid")).alias("orcid"), F.when(n % 7 > 0, F.col("source")).alias("org"), field(None, "bio", "chem", None, "other", None).alias("field"))
    return resolve.resolve_people(asked, known)


def pi_coverage(s: SparkSession, d: str) -> DataFrame:
    return pi_resolve(s, d).groupBy(F.coalesce("method", "reason").alias("outcome")).agg(F.count("*").alias("people"))


_ALL = (citation_edges, graph_counts, degrees, pagerank, uniformity, field_normalized_impact, coupling_topk, interdisciplinarity, tfidf_norms, tfidf_topk, latent_topk, ppmi, word_vectors, document_vectors, cosine_knn, retrieval_metrics, evaluation, dense_sample, split_and_rank, paired_bootstrap, sign_test,
        org_match_cascade, org_exact, org_match_methods, org_resolution, award_grant_links, grant_modal_recipient, grant_modal_field, pi_resolve, pi_coverage)
QUERIES = {f.__name__: f for f in _ALL}

_PR = "WITH n AS (SELECT p_partkey AS node FROM part), c AS (SELECT count(*) AS n FROM n), e AS MATERIALIZED (SELECT src, dst, 0.85::DOUBLE / count(*) OVER (PARTITION BY src) AS w FROM citation), r0 AS (SELECT node, 1.0::DOUBLE / c.n AS rank FROM n, c)" + "".join(
    f", r{i} AS MATERIALIZED (SELECT n.node, (0.15::DOUBLE + 0.85::DOUBLE * coalesce(lost, 0)) / c.n + coalesce(got, 0) AS rank FROM n CROSS JOIN c CROSS JOIN (SELECT sum(rank) AS lost FROM r{i - 1} WHERE node NOT IN (SELECT src FROM citation)) LEFT JOIN (SELECT e.dst, sum(r.rank * w) AS got FROM e JOIN r{i - 1} r ON r.node = e.src GROUP BY 1) g ON g.dst = n.node)"
    for i in range(1, ITERATIONS + 1)
) + f", pr AS (SELECT node, rank / sum(rank) OVER () AS rank FROM r{ITERATIONS})"
_DEG = "SELECT p_partkey AS node, coalesce(o, 0) AS out_degree, coalesce(i, 0) AS in_degree FROM part LEFT JOIN (SELECT src, count(*) AS o FROM citation GROUP BY 1) ON src = p_partkey LEFT JOIN (SELECT dst, count(*) AS i FROM citation GROUP BY 1) ON dst = p_partkey"
_TOK = r"regexp_extract_all(lower(text), '[a-z][a-z0-9\-]+')"
_TFIDF = f"""t AS (SELECT doc_id, unnest({_TOK}) AS term FROM documents WHERE text IS NOT NULL), tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
  v AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY 1 HAVING count(*) >= 2 ORDER BY count(*) DESC, term LIMIT 20000),
  x AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN v USING (term)), tfidf AS (SELECT x.doc_id, term, w / l.len AS weight FROM x JOIN (SELECT doc_id, sqrt(sum(w * w)) AS len FROM x GROUP BY 1) l ON l.doc_id = x.doc_id)"""


def _knn(vector: str = "embedding") -> str:
    score = f"round(list_cosine_similarity(q.{vector}::DOUBLE[], v.{vector}::DOUBLE[]), 6)"
    return f"SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS pos FROM (SELECT q.vec_id AS query, v.vec_id, q.label AS ql, v.label, {score} AS score FROM (SELECT *, embedding[1:16] AS less FROM embeddings) q JOIN (SELECT *, embedding[1:16] AS less FROM embeddings) v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)"


def _metrics_sql(name: str, vector: str = "embedding") -> str:
    """A CTE with the metrics of every query vector over all others."""
    recalls = ", ".join(f"round(count(*) FILTER (WHERE pos <= {k}) / any_value(g), 6) AS recall_{k}" for k in (5, 10, 20, 50))
    return f"{name} AS (SELECT query, round(sum(nth / pos) / any_value(g), 6) AS ap, round(1 / min(pos), 6) AS rr, {recalls} FROM (SELECT query, pos, row_number() OVER (PARTITION BY query ORDER BY pos) AS nth, count(*) OVER (PARTITION BY query) AS g FROM ({_knn(vector)}) WHERE ql = label) GROUP BY query)"


_SPLIT = "x AS (SELECT src, dst, rn <= greatest(1, round_even(n * 0.3, 0)) AS held FROM (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY md5('0:' || src || ':' || dst), dst) AS rn, count(*) OVER (PARTITION BY src) AS n FROM citation WHERE src % 50 = 0) WHERE n >= 5)"
_CODES = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in CODES.items()) + "}"
_CC = "CASE upper(trim(country)) WHEN 'EL' THEN 'GR' WHEN 'UK' THEN 'GB' ELSE nullif(upper(trim(country)), '') END"
_WORDS = lambda e: f"list_transform(string_split({e}, ' '), lambda w: coalesce(MAP {{{', '.join(f'{chr(39)}{a}{chr(39)}: {chr(39)}{b}{chr(39)}' for a, b in text.ABBREVIATIONS.items())}}}[w], w))"


def _tier_sql(n: int, method: str, score: str, kind: str, key: str, need: bool = False) -> str:
    """Candidates with an equal key, those of the country if there are any, the one of highest priority."""
    there = "here" if need else "(here OR NOT any_here OR cc IS NULL)"
    prio = "0" if need else "prio"
    return f"""t{n} AS (SELECT qid, ror, '{method}' AS method, {score} AS score, {n} AS t FROM (SELECT *, count(*) OVER (PARTITION BY qid) AS tied FROM (SELECT *, max(prio) OVER (PARTITION BY qid) AS top FROM (SELECT *, bool_or(here) OVER (PARTITION BY qid) AS any_here
      FROM (SELECT q.qid, q.cc, i.ror, max({prio}) AS prio, bool_or(coalesce(i.country = q.cc, false)) AS here FROM q JOIN idx i ON q.{key} = i.{"norm" if need else key} WHERE kind {kind} 'acronym' GROUP BY 1, 2, 3)) WHERE {there}) WHERE prio = top) WHERE tied = 1)"""


_CASCADE = f"""reg AS (SELECT reg_id, legal_name AS name, 'display' AS kind, country FROM registry_org UNION ALL SELECT reg_id, name, CASE WHEN regexp_matches(name, '^[A-Z]{{2,8}}$') THEN 'acronym' ELSE 'alias' END, country FROM (SELECT reg_id, trim(unnest(string_split(other_names, ';'))) AS name, country FROM registry_org)),
  idx AS (SELECT DISTINCT ror, kind, country, norm, CASE WHEN norm LIKE '% %' THEN array_to_string({_WORDS("norm")}, ' ') ELSE norm END AS expanded, {tokens_sql("norm")} AS tokens, CASE kind WHEN 'display' THEN 3 WHEN 'alias' THEN 1 ELSE 0 END AS prio, string_split(norm, ' ')[-1] IN ({", ".join(f"'{w}'" for w in text.UMBRELLA)}) AS umbrella
    FROM (SELECT reg_id AS ror, kind, {_CODES}[upper(regexp_replace(country, '[\\s.]', '', 'g'))] AS country, {norm_sql("name")} AS norm FROM reg) WHERE norm <> ''),
  q AS (SELECT *, row_number() OVER () AS qid, CASE WHEN norm LIKE '% %' THEN array_to_string({_WORDS("norm")}, ' ') ELSE norm END AS expanded, {tokens_sql("norm")} AS tokens, {_CC} AS cc FROM (SELECT DISTINCT name, country_code AS country, {norm_sql("name")} AS norm FROM organization WHERE true) WHERE norm <> ''),
  {_tier_sql(1, "exact", "1.0::DOUBLE", "<>", "norm")}, {_tier_sql(2, "expanded", "0.99::DOUBLE", "<>", "expanded")}, {_tier_sql(3, "acronym", "0.97::DOUBLE", "=", "norm", True)},
  nm AS (SELECT * FROM idx WHERE kind <> 'acronym' AND country IS NOT NULL), cn AS (SELECT country, count(*) AS n FROM nm GROUP BY 1), cd AS (SELECT country, w, count(*) AS df FROM (SELECT country, unnest(tokens) AS w FROM nm) GROUP BY 1, 2),
  qw AS (SELECT qid, cc, a.w, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 AS idf FROM (SELECT qid, cc, unnest(tokens) AS w FROM q WHERE len(tokens) >= 2 AND cc IS NOT NULL) a JOIN cn ON cn.country = cc LEFT JOIN cd ON cd.country = cc AND cd.w = a.w),
  qk AS (SELECT qid, cc, sum(idf) AS total, first(w ORDER BY idf DESC, w) AS key FROM qw GROUP BY 1, 2),
  ca AS (SELECT qk.qid, nm.ror, nm.tokens, nm.prio, nm.umbrella, q.tokens AS asked, round((SELECT sum(idf) FROM qw WHERE qw.qid = qk.qid AND list_contains(nm.tokens, qw.w)) / total, 6) AS w FROM qk JOIN q ON q.qid = qk.qid JOIN nm ON nm.country = qk.cc AND list_contains(nm.tokens, qk.key)),
  cb AS (SELECT qid, ror, max(struct_pack(w := w, own := NOT umbrella, prio := prio, j := len(list_intersect(asked, tokens)) / len(list_distinct(list_concat(asked, tokens))))) AS k FROM ca GROUP BY 1, 2),
  t4 AS (SELECT qid, ror, 'fuzzy' AS method, round(k.w, 4) AS score, 4 AS t FROM (SELECT *, row_number() OVER o AS rn, lead(k) OVER o AS nx FROM cb WINDOW o AS (PARTITION BY qid ORDER BY k DESC, ror)) WHERE rn = 1 AND k.w >= 0.85 AND NOT coalesce(k.w = nx.w AND k.own = nx.own, false)),
  won AS (SELECT qid, first(ror ORDER BY t) AS ror, first(method ORDER BY t) AS method, first(score ORDER BY t) AS score FROM (FROM t1 UNION ALL FROM t2 UNION ALL FROM t3 UNION ALL FROM t4) GROUP BY 1), res AS (SELECT name, country, ror, method, score FROM q JOIN won USING (qid))"""
_FIELD = lambda *x: "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in x) + f"][coalesce(length(full_name) % {len(x)}, 0) + 1]"
_FITS = "coalesce(g[1] = kg[1] OR (length(g[1]) = 1 OR length(kg[1]) = 1) AND substr(g[1], 1, 1) = substr(kg[1], 1, 1), false)"
_PI = f"""p AS (SELECT DISTINCT atlas_id, full_name, first_name, last_name, orcid, source FROM person), pn AS (SELECT *, {NAME_PARTS} AS n FROM p),
  k AS (SELECT atlas_id AS person_id, orcid, source AS org, {_FIELD("bio", "chem", None)} AS kf, n.surname AS sur, n.given AS kg FROM pn),
  a AS (SELECT x.*, o.by_orcid FROM (SELECT concat_ws('|', atlas_id, full_name, first_name, last_name, orcid, source) AS qid, CASE WHEN length(full_name) % 5 = 0 THEN orcid END AS orcid, CASE WHEN length(full_name) % 7 > 0 THEN source END AS org, {_FIELD(None, "bio", "chem", None, "other", None)} AS field, n.surname AS sur, n.given AS g FROM pn) x
    LEFT JOIN (SELECT orcid, min(person_id) AS by_orcid FROM k WHERE orcid IS NOT NULL GROUP BY 1) o ON o.orcid = x.orcid),
  pr AS (SELECT qid, person_id, fits, fits AND (field IS NULL OR field = 'other' OR coalesce(kf = field, false)) AS ok, fits AND (field IS NULL OR field = 'other' OR coalesce(kf = field, false)) AND coalesce(length(g[1]) > 1 AND g[1] = kg[1], false) AS strong
    FROM (SELECT a.qid, a.field, a.g, k.person_id, k.kf, k.kg, {_FITS} AS fits FROM a JOIN (SELECT DISTINCT person_id, org, kf, sur, kg FROM k WHERE sur IS NOT NULL AND org IS NOT NULL) k ON a.org = k.org AND a.sur = k.sur WHERE a.by_orcid IS NULL)),
  su AS (SELECT qid, bool_or(fits) AS fits, count(DISTINCT person_id) FILTER (WHERE ok) AS oks, count(DISTINCT person_id) FILTER (WHERE strong) AS strongs, min(person_id) FILTER (WHERE ok) AS o1, min(person_id) FILTER (WHERE strong) AS s1 FROM pr GROUP BY 1),
  f AS (SELECT a.*, su.* EXCLUDE (qid), coalesce(field <> 'other', false) AS told, CASE WHEN by_orcid IS NOT NULL THEN by_orcid WHEN oks = 1 THEN o1 WHEN oks > 1 AND strongs = 1 THEN s1 END AS person_id FROM a LEFT JOIN su ON su.qid = a.qid),
  pi AS (SELECT qid, person_id, CASE WHEN by_orcid IS NOT NULL THEN 'orcid' WHEN person_id IS NOT NULL THEN CASE WHEN told THEN 'name+org+field' ELSE 'name+org' END END AS method,
    CASE WHEN by_orcid IS NOT NULL THEN 1.0 WHEN person_id IS NOT NULL THEN CASE WHEN told THEN 0.97 ELSE 0.9 END END::DOUBLE AS score,
    CASE WHEN person_id IS NOT NULL THEN NULL WHEN sur IS NULL THEN 'unparseable-name' WHEN fits IS NULL THEN 'no-org-overlap' WHEN NOT fits THEN 'no-name-overlap' WHEN told AND oks > 0 THEN 'ambiguous-field' WHEN told THEN 'field-conflict' ELSE 'ambiguous' END AS reason FROM f)"""
_SQL = {
    "citation_edges": "SELECT * FROM citation",
    "degrees": _DEG,
    "graph_counts": "SELECT *, round(n_edges_in_corpus / n_edges_total, 6) AS coverage FROM (SELECT sum(n * (n - 1) // 2)::BIGINT AS n_edges_total FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)), (SELECT count(*) AS n_edges_in_corpus FROM citation)",
    "pagerank": f"{_PR} SELECT node, round(rank, 8) AS rank FROM pr",
    "uniformity": f"{_PR}, r AS (SELECT rank AS x, row_number() OVER (ORDER BY rank, node) AS i, count(*) OVER () AS n FROM pr) SELECT round(min(x), 8) AS min, round(max(x), 8) AS max, round(avg(x), 8) AS mean, round(stddev_pop(x), 8) AS std, round(stddev_pop(x) / avg(x), 6) AS cv, round(max(x) * count(*), 5) AS top1_over_uniform, count(*) AS n, round(sum((2 * i - n - 1) * x) / (sum(x) * max(n)), 6) AS gini, round(sum(x) FILTER (WHERE i > n - greatest(1, ceil(n * 0.01))) / sum(x), 6) AS top1pct_mass FROM r",
    "field_normalized_impact": "SELECT atlas_id, field_id, publication_year, round(CASE WHEN m > 0 THEN cited_by_count / m ELSE 0 END, 6) AS impact FROM (SELECT w.atlas_id, wf.dst_id AS field_id, publication_year, cited_by_count, avg(cited_by_count) OVER (PARTITION BY wf.dst_id, publication_year) AS m FROM work w JOIN work_field wf ON wf.src_id = w.atlas_id)",
    "coupling_topk": "SELECT * FROM (SELECT query, node, shared, row_number() OVER (PARTITION BY query ORDER BY shared DESC, node) AS pos FROM (SELECT a.src AS query, b.src AS node, count(*) AS shared FROM citation a JOIN citation b ON a.dst = b.dst AND a.src <> b.src WHERE a.src % 50 = 0 GROUP BY 1, 2)) WHERE pos <= 5",
    "interdisciplinarity": "WITH f AS (SELECT src_id AS node, dom FROM work_field JOIN climb ON topic = dst_id) SELECT a.dom AS domain, count(*) AS refs, round(avg((a.dom <> b.dom)::INT), 6) AS cross_share FROM citation c JOIN f a ON a.node = c.src JOIN f b ON b.node = c.dst GROUP BY 1",
    "tfidf_norms": f"WITH {_TFIDF} SELECT doc_id, count(*) AS terms, round(sum(weight), 5) AS weight, round(max(weight), 6) AS top FROM tfidf GROUP BY 1",
    "tfidf_topk": f"WITH {_TFIDF}, s AS (SELECT q.doc_id AS query, d.doc_id, round(sum(q.weight * d.weight), 6) AS score FROM tfidf q JOIN tfidf d ON q.term = d.term AND q.doc_id <> d.doc_id WHERE q.doc_id % 50 = 0 GROUP BY 1, 2) SELECT query, pos, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS pos FROM s) WHERE pos <= 5",
    "ppmi": f"""WITH w AS (SELECT doc_id, {_TOK} AS t FROM documents WHERE text IS NOT NULL), k AS (SELECT w FROM (SELECT DISTINCT doc_id, unnest(t) AS w FROM w) GROUP BY 1 HAVING count(*) >= 5),
      p AS (SELECT t[i] AS a, t[j] AS b FROM (SELECT t, unnest(range(1, len(t) + 1)) AS i FROM w), range(1, 6) o(k), LATERAL (SELECT i + k AS j) WHERE j <= len(t)),
      n AS (SELECT a, b, count(*) AS n FROM (SELECT a, b FROM p UNION ALL SELECT b, a FROM p) WHERE a <> b AND a IN (FROM k) AND b IN (FROM k) GROUP BY 1, 2),
      r AS (SELECT a, sum(n) AS s FROM n GROUP BY 1)
      SELECT n.a, n.b, n.n, round(ln(n.n * (SELECT sum(n) FROM n) / (x.s * y.s)), 5) AS ppmi FROM n JOIN r x ON x.a = n.a JOIN r y ON y.a = n.b WHERE ln(n.n * (SELECT sum(n) FROM n) / (x.s * y.s)) > 0""",
    "cosine_knn": f"SELECT query, vec_id, score, pos FROM ({_knn()}) WHERE pos <= 10",
    "retrieval_metrics": f"WITH {_metrics_sql('m')} SELECT * FROM m",
    "evaluation": f"WITH {_metrics_sql('m')}, maps AS (SELECT b, sum(ap * w) / sum(w) AS map FROM {resampled_sql('m', 'query', 2000, 3)} GROUP BY 1) SELECT * FROM (SELECT count(*) AS queries, round(avg(ap), 6) AS map, round(avg(rr), 6) AS mrr, " + ", ".join(f"round(avg(recall_{k}), 6) AS recall_{k}" for k in (5, 10, 20, 50)) + " FROM m), (SELECT round(quantile_cont(map, 0.025), 6) AS map_lo, round(quantile_cont(map, 0.975), 6) AS map_hi FROM maps)",
    "dense_sample": "SELECT dst AS node, count(*) AS in_degree FROM citation GROUP BY 1 ORDER BY in_degree DESC, node LIMIT 200",
    "split_and_rank": f"WITH {_SPLIT}, pop AS (SELECT dst, count(*) AS c FROM citation GROUP BY 1), r AS (SELECT q.src, pop.dst, row_number() OVER (PARTITION BY q.src ORDER BY c DESC, pop.dst) AS pos FROM (SELECT DISTINCT src FROM x) q JOIN pop ON q.src <> pop.dst WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.src = q.src AND x.dst = pop.dst AND NOT held)) SELECT r.src AS query, r.dst AS item, pos FROM r JOIN x ON x.src = r.src AND x.dst = r.dst AND held",
    "paired_bootstrap": f"WITH {_metrics_sql('m')}, {_metrics_sql('k', 'less')}, x AS (SELECT query, m.ap - k.ap AS diff FROM m JOIN k USING (query)), e AS (SELECT b, sum(diff * w) / sum(w) AS mean FROM {resampled_sql('x', 'query', 2000, 0)} GROUP BY 1) SELECT * FROM (SELECT round(avg((mean <= 0)::INT), 6) AS p FROM e), (SELECT round(avg(diff), 6) AS delta_map FROM x)",
    "sign_test": """SELECT wins, n, round(least(1, 2 * (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) - n * ln(2))) FROM range(0, 1 + least(wins, n - wins)) t(i))), 6) AS p FROM (SELECT count(*) FILTER (WHERE a > b) AS wins, count(*) AS n
      FROM (SELECT wf.dst_id, avg(cited_by_count) FILTER (WHERE w.atlas_id % 2 = 0) AS a, avg(cited_by_count) FILTER (WHERE w.atlas_id % 2 = 1) AS b FROM work w JOIN work_field wf ON wf.src_id = w.atlas_id GROUP BY 1) WHERE a <> b)""",
    "org_match_cascade": f"WITH {_CASCADE} SELECT * FROM res",
    "org_exact": f"WITH {_CASCADE} SELECT name, country, ror FROM res WHERE method = 'exact'",
    "org_match_methods": f"WITH {_CASCADE} SELECT method, count(*) AS names, round(avg(score), 4) AS mean_score FROM res GROUP BY 1",
    "org_resolution": f"""WITH {_CASCADE}, o AS (SELECT DISTINCT name, country_code AS country, nullif(trim(ror_id), '') AS given FROM organization) SELECT name, country, given, given AS ror, 'prematched' AS method, 1.0::DOUBLE AS score FROM o WHERE given IS NOT NULL
      UNION ALL SELECT o.name, o.country, given, ror::VARCHAR, method, score FROM o LEFT JOIN res ON res.name IS NOT DISTINCT FROM o.name AND res.country IS NOT DISTINCT FROM o.country WHERE given IS NULL""",
    "award_grant_links": r"SELECT DISTINCT 'w:' || atlas_id AS work_id, max(atlas_id) OVER (PARTITION BY regexp_extract(source_id, '(\d+)$', 1)::INT) AS grant_id FROM grant_record",
    "pi_resolve": f"WITH {_PI} SELECT * FROM pi",
    "pi_coverage": f"WITH {_PI} SELECT coalesce(method, reason) AS outcome, count(*) AS people FROM pi GROUP BY 1",
    "grant_modal_recipient": "SELECT src_id, dst_id, n FROM (SELECT *, row_number() OVER (PARTITION BY src_id ORDER BY f DESC, n DESC, dst_id) AS rn FROM (SELECT src_id, dst_id, count(*) AS n, max(coalesce(role = 'recipient', false)) AS f FROM grant_org WHERE src_id IS NOT NULL AND dst_id IS NOT NULL GROUP BY 1, 2)) WHERE rn = 1",
    "grant_modal_field": "SELECT grant_id, field, n FROM (SELECT *, row_number() OVER (PARTITION BY grant_id ORDER BY n DESC, field) AS rn FROM (SELECT gw.src_id AS grant_id, field, count(*) AS n FROM gw JOIN work_field wf ON wf.src_id = gw.dst_id JOIN climb c ON c.topic = wf.dst_id GROUP BY 1, 2)) WHERE rn = 1",
}
ORACLES = {k: with_views(v) for k, v in _SQL.items()}
