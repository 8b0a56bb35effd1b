"""Researchers: profiles of the people behind the works, segments, aggregates, and matched comparisons.

The event stream stands in for authorship: an event that says something about k is a work of its user, and the lines of
the order of the same number give the work's topics, a row each. The people's home institutions are customers. A purchase
with a high k is a grant that was traced to its principal investigator (the bridge).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundloom.operators.ranks import resampled, resampled_sql
from fundloom.plans.graph import Graph, with_views
from fundloom.plans.named import clamp_limit
from fundloom.sources.tables import table

# The short name of each top-level field.
FIELD_SLUGS = {
    "Agricultural and Biological Sciences": "biomed-bio",
    "Arts and Humanities": "econ-social",
    "Biochemistry, Genetics and Molecular Biology": "biomed-bio",
    "Business, Management and Accounting": "econ-social",
    "Chemical Engineering": "chemistry",
    "Chemistry": "chemistry",
    "Computer Science": "cs-ml",
    "Decision Sciences": "cs-ml",
    "Dentistry": "biomed-bio",
    "Earth and Planetary Sciences": "earth-climate",
    "Economics, Econometrics and Finance": "econ-social",
    "Energy": "earth-climate",
    "Engineering": "engineering",
    "Environmental Science": "earth-climate",
    "Health Professions": "biomed-bio",
    "Immunology and Microbiology": "biomed-bio",
    "Materials Science": "materials",
    "Mathematics": "math",
    "Medicine": "biomed-bio",
    "Neuroscience": "biomed-bio",
    "Nursing": "biomed-bio",
    "Pharmacology, Toxicology and Pharmaceutics": "biomed-bio",
    "Physics and Astronomy": "physics-astro",
    "Psychology": "econ-social",
    "Social Sciences": "econ-social",
    "Veterinary": "biomed-bio",
}
# The tools that fit a field.
TOOLS = {
    "biomed-bio": "seq-pipelines imaging-analysis structure-pred fair-data-mgmt stats-reproducibility",
    "chemistry": "reaction-informatics spectra-analysis molecular-sim lab-eln fair-data-mgmt",
    "physics-astro": "hpc-sim large-data-pipelines instrument-control ml-surrogates fair-data-mgmt",
    "materials": "molecular-sim ml-surrogates high-throughput-screening lab-eln fair-data-mgmt",
    "cs-ml": "reproducibility-mlops compute-orchestration benchmark-tooling model-cards-eval",
    "earth-climate": "large-data-pipelines geospatial-analysis hpc-sim fair-data-mgmt model-intercomparison",
    "econ-social": "stats-reproducibility survey-data-mgmt causal-inference-tooling fair-data-mgmt",
    "math": "proof-assistants symbolic-compute reproducibility-mlops",
    "engineering": "hpc-sim ml-surrogates lab-eln fair-data-mgmt",
    "other": "fair-data-mgmt stats-reproducibility",
}
#: The year that counts as this one, and how many years back a work makes its author active.
THIS_YEAR, WINDOW = 2012, 3
STAGES = ("eminent", "established", "rising-star", "early/unknown")


def _lookup(values: dict[str, str], key: Column, default: str) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key), F.lit(default))


def field_slug(name: Column) -> Column:
    """The field's short name, ``other`` for null and unknown ones."""
    return _lookup(FIELD_SLUGS, F.btrim(name), "other")


def tool_fit(slug: Column) -> Column:
    """The tools that fit a field, one after another."""
    return F.replace(_lookup(TOOLS, slug, TOOLS["other"]), F.lit(" "), F.lit(";"))


def seniority(first: Column, last: Column, total: Column, most: Column, h: Column, corresponding: Column) -> Column:
    """Stage of a career by impact and span; what isn't known counts as little."""
    span, c, m, n = last - first + 1, F.coalesce(total, F.lit(0)), F.coalesce(most, F.lit(0)), F.coalesce(h, F.lit(0))
    return (
        F.when(first.isNull() | last.isNull(), "early/unknown")
        .when((n >= 25) | (c >= 5000) | (m >= 1500), "eminent")
        .when((span >= 8) & ((n >= 8) | (c >= 600)), "established")
        .when((span <= 7) & ((c >= 80) | (m >= 50) | (F.coalesce(corresponding, F.lit(False)) & (c >= 30))), "rising-star")
        .otherwise("early/unknown")
    )


def activity(last: Column, corresponding: Column, this_year: int = THIS_YEAR) -> Column:
    recent = F.coalesce(this_year - last <= WINDOW, F.lit(False))
    return F.when(~recent, "dormant").when(F.coalesce(corresponding, F.lit(False)), "active-pi").otherwise("active")


def high_value(stage: Column, active: Column, corresponding: Column) -> Column:
    """Active principal investigators, and active corresponding authors of some standing."""
    return (active == "active-pi") | ((stage != "early/unknown") & (active == "active") & F.coalesce(corresponding, F.lit(False)))


def authored(s: SparkSession, d: str) -> DataFrame:
    """``(work, person, year, cited, corresponding, topic, field)``, a row per topic of a work and author."""
    k = F.from_json("props", "k bigint")["k"]
    e = table(s, d, "events", "event_id", "user_id", "event_type", "ts", "props").withColumn("k", k).where((F.col("k") >= 60) & F.col("event_type").isin("view", "click", "purchase"))
    cited = F.when((F.col("k") == 99) & (F.col("event_type") == "click"), 1600).otherwise(F.col("k") - 60).cast("long")
    work = e.select(F.col("event_id").alias("work"), F.col("user_id").alias("person"), (2000 + F.floor(F.dayofmonth("ts") / 3)).cast("long").alias("year"), cited.alias("cited"), (F.col("event_type") == "click").alias("corresponding"))
    names = F.array(*[F.lit(n) for n in FIELD_SLUGS])
    part = table(s, d, "part", "p_partkey", "p_brand").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("topic"), F.element_at(names, F.substring("p_brand", 7, 9).cast("int") % 26 + 1).alias("field"))
    line = table(s, d, "lineitem", "l_orderkey", "l_partkey").select(F.col("l_orderkey").alias("work"), "l_partkey")
    return work.join(line, "work").join(part, "l_partkey").drop("l_partkey")


def _once(a: DataFrame) -> DataFrame:
    """A work counts once per person, whatever the number of its rows."""
    return a.groupBy("person", "work").agg(F.max("year").alias("year"), F.max("cited").alias("cited"))


def _h(once: DataFrame) -> DataFrame:
    """Largest h with h works cited h times or more, from counts per citation number: a prolific person is few rows."""
    c = once.groupBy("person", "cited").agg(F.count("*").alias("c"))
    steps = F.array_sort(F.collect_list(F.struct((-F.col("cited")).alias("down"), "c")))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("h"))
    more = lambda acc, x: F.struct((acc["n"] + x["c"]).alias("n"), F.greatest(acc["h"], F.least(-x["down"], acc["n"] + x["c"])).alias("h"))
    return c.groupBy("person").agg(steps.alias("steps")).select("person", F.aggregate("steps", zero, more)["h"].alias("h_index"))


def h_index(s: SparkSession, d: str) -> DataFrame:
    return _h(_once(authored(s, d)))


def _ranked(a: DataFrame, column: str, n: int) -> DataFrame:
    """``(person, <column>s, most)``: a person's ``n`` most frequent values, ties by name, and how often the first occurs."""
    c = a.groupBy("person", column).agg(F.count("*").alias("c"))
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("c")).alias("n"), column))), 1, n)
    return c.groupBy("person").agg(F.transform(top, lambda x: x[column]).alias(f"{column}s"), F.max("c").alias("most"))


def frequent(s: SparkSession, d: str) -> DataFrame:
    """Each person's modal field, and its five most frequent topics."""
    a = authored(s, d)
    f, t = _ranked(a, "field", 1), _ranked(a, "topic", 5).drop("most")
    return f.join(t, "person").select("person", F.get("fields", F.lit(0)).alias("field"), "most", F.array_join("topics", ";").alias("topics"))


def profiles(s: SparkSession, d: str) -> DataFrame:
    """A row per person. Corresponding authorships are counted by row, works and citations once per work."""
    a = authored(s, d)
    once = _once(a)
    of = once.groupBy("person").agg(F.count("*").alias("works"), F.sum("cited").alias("citations"), F.max("cited").alias("max_citations"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    corr = a.groupBy("person").agg(F.sum(F.col("corresponding").cast("long")).alias("corresponding"))
    return of.join(_h(once), "person").join(corr, "person").join(frequent(s, d).select("person", "field", "topics"), "person")


def researchers(s: SparkSession, d: str) -> DataFrame:
    """The public researchers' view: profile, home institution, stage, activity, segment and tools; no contact data."""
    g = Graph(s, d)
    lead = F.col("corresponding") > 0
    p = profiles(s, d).withColumn("field_slug", field_slug(F.col("field"))).withColumn("seniority", seniority(*[F.col(c) for c in ("first_year", "last_year", "citations", "max_citations", "h_index")], lead)).withColumn("activity_tier", activity(F.col("last_year"), lead))
    home = g.person_org.select(F.col("src_id").alias("person"), F.col("dst_id").alias("org_id")).join(g.organization.select(F.col("atlas_id").alias("org_id"), F.col("name").alias("primary_org_name"), F.col("ror_id").alias("primary_org_ror"), "country_code"), "org_id")
    full = F.concat(F.lit("Person "), F.col("person").cast("string"))
    return p.join(home, "person", "left").select(
        "person", full.alias("full_name"), "field", "field_slug", "topics", F.col("works").alias("works_count"), F.col("citations").alias("total_citations"), "max_citations", F.col("h_index").alias("h_index_proxy"), "first_year", "last_year", "corresponding", lead.alias("is_corresponding_author"),
        "primary_org_name", "primary_org_ror", "country_code", "seniority", "activity_tier", F.concat_ws("/", "field_slug", "seniority", "activity_tier").alias("segment"), tool_fit(F.col("field_slug")).alias("tool_fit"),
        high_value(F.col("seniority"), F.col("activity_tier"), lead).alias("high_value"),
    )


def segments(s: SparkSession, d: str) -> DataFrame:
    return researchers(s, d).select("person", "field_slug", "seniority", "activity_tier", "segment", "tool_fit", "high_value")


def researchers_by_segment(s: SparkSession, d: str, limit: int = 30) -> DataFrame:
    a = researchers(s, d).groupBy("field_slug", "seniority", "activity_tier").agg(F.count("*").alias("researchers"), F.sum(F.col("is_corresponding_author").cast("long")).alias("corresponding"))
    return a.orderBy(F.desc("researchers"), "field_slug", "seniority", "activity_tier").limit(clamp_limit(limit, 30))


def tool_targets(s: SparkSession, d: str, tool: str = "fair-data-mgmt", limit: int = 25) -> DataFrame:
    """Active principal investigators whom a tool fits."""
    r = researchers(s, d).where(F.col("tool_fit").like(f"%{tool}%") & (F.col("activity_tier") == "active-pi")).orderBy(F.desc("h_index_proxy"), F.desc("works_count"), "person").limit(clamp_limit(limit))
    return r.select("field_slug", "full_name", "primary_org_name", "country_code", "works_count", "h_index_proxy", "seniority", "segment")


def profile_aggregates(s: SparkSession, d: str) -> DataFrame:
    """Coverage and means per field, without a person in sight."""
    share = lambda c: F.round(100 * F.avg(c.cast("double")), 4)
    return researchers(s, d).groupBy("field_slug").agg(
        F.count("*").alias("people"), F.round(F.avg("works_count"), 4).alias("mean_works"), F.median("total_citations").alias("median_citations"), share(F.col("primary_org_ror").isNotNull()).alias("pct_ror"), share(F.col("is_corresponding_author")).alias("pct_corresponding"), share(F.col("high_value")).alias("pct_high_value")
    )


def per_field_sample(s: SparkSession, d: str, n: int = 5) -> DataFrame:
    """The ``n`` high-value people of each field that are tried first: by h-index, then works."""
    r = researchers(s, d).where("high_value").select("field_slug", "person", "h_index_proxy", "works_count")
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("h_index_proxy")).alias("h"), (-F.col("works_count")).alias("w"), "person"))), 1, n)
    return r.groupBy("field_slug").agg(best.alias("b")).select("field_slug", F.explode("b").alias("x")).select("field_slug", "x.person")


# Matched comparisons --------------------------------------------------------------------------------------------------


def bridge(s: SparkSession, d: str) -> DataFrame:
    """``(person, grant)``: grants traced to their principal investigator."""
    k = F.from_json("props", "k bigint")["k"]
    return table(s, d, "events", "event_id", "user_id", "event_type", "props").where((k >= 95) & (F.col("event_type") == "purchase")).select(F.col("user_id").alias("person"), F.col("event_id").alias("grant"))


def cohort(s: SparkSession, d: str) -> DataFrame:
    """Everyone whose home institution employs someone on the bridge, labelled by being on it."""
    r = researchers(s, d).select("person", "field_slug", "seniority", "first_year", "primary_org_ror", F.col("works_count").cast("double").alias("works"), F.col("h_index_proxy").cast("double").alias("h"), F.col("total_citations").cast("double").alias("citations"))
    on = bridge(s, d).select("person").distinct().withColumn("funded", F.lit(True))
    labelled = r.where("first_year is not null").join(on, "person", "left").withColumn("funded", F.coalesce("funded", F.lit(False)))
    return labelled.join(labelled.where("funded").select("primary_org_ror").distinct(), "primary_org_ror", "left_semi")


OUTCOMES = ("works", "h", "citations")


def strata(x: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Strata that hold at least ``least`` people on both sides: their funded people (n), and means of each outcome."""
    f = F.col("funded")
    means = [F.avg(F.when(side, F.col(o))).alias(f"{o}_{n}") for o in OUTCOMES for n, side in (("f", f), ("c", ~f))]
    return x.groupBy(*keys).agg(F.sum(f.cast("long")).alias("n"), F.sum((~f).cast("long")).alias("others"), *means).where((F.col("n") >= least) & (F.col("others") >= least))


def _ratio(o: str, weight: Column) -> Column:
    """Funded to other means, both weighted by the funded people of each stratum."""
    return F.try_divide(F.sum(weight * F.col(f"{o}_f")), F.sum(weight * F.col(f"{o}_c")))


def _era(years: int) -> Column:
    return F.floor(F.col("first_year") / years) * years


def matched_productivity(s: SparkSession, d: str, least: int = 2) -> DataFrame:
    """Matched ratios of works, h and citations over field, stage and era of entry, by five years and by exact year."""
    x = cohort(s, d)
    out = None
    for years in (5, 1):
        a = strata(x.withColumn("era", _era(years)), ["field_slug", "seniority", "era"], least).agg(F.count("*").alias("strata"), F.sum("n").alias("funded"), *[F.round(_ratio(o, F.col("n")), 6).alias(o) for o in OUTCOMES]).select(F.lit(years).alias("bin"), "*")
        out = a if out is None else out.unionByName(a)
    return out


def matched_bootstrap(s: SparkSession, d: str, least: int = 2, draws: int = 2000) -> DataFrame:
    """Percentile intervals of the three ratios over resampled strata (five-year eras)."""
    a = strata(cohort(s, d).withColumn("era", _era(5)), ["field_slug", "seniority", "era"], least)
    r = resampled(a, F.concat_ws("|", "field_slug", "seniority", F.col("era").cast("string")), draws, 42).groupBy("b").agg(*[_ratio(o, F.col("n") * F.col("w")).alias(o) for o in OUTCOMES])
    return r.agg(*[F.round(F.percentile(o, q), 6).alias(f"{o}_{n}") for o in OUTCOMES for n, q in (("lo", 0.025), ("hi", 0.975))])


def matched_by_stage(s: SparkSession, d: str, least: int = 2) -> DataFrame:
    a = strata(cohort(s, d).withColumn("era", _era(5)), ["field_slug", "seniority", "era"], least)
    return a.groupBy("seniority").agg(F.count("*").alias("strata"), F.sum("n").alias("funded"), F.round(_ratio("works", F.col("n")), 6).alias("works"))


def resolution_bias(s: SparkSession, d: str) -> DataFrame:
    """Moments of all people, and of those on the bridge."""
    p = researchers(s, d).join(bridge(s, d).select("person").distinct().withColumn("on", F.lit(True)), "person", "left")
    part = lambda df, name: df.agg(F.lit(name).alias("population"), F.count("*").alias("people"), F.round(F.avg("works_count"), 4).alias("mean"), F.median("works_count").alias("median"), F.max("works_count").alias("most"))
    return part(p, "all").unionByName(part(p.where("on"), "funded"))


def bridge_coverage(s: SparkSession, d: str) -> DataFrame:
    """How much of the people and grants the bridge covers, by field."""
    on = bridge(s, d).groupBy("person").agg(F.count_distinct("grant").alias("grants"))
    return researchers(s, d).join(on, "person", "left").groupBy("field_slug").agg(F.count("*").alias("people"), F.count("grants").alias("bridged"), F.coalesce(F.sum("grants"), F.lit(0)).alias("grants"), F.round(F.count("grants") / F.count("*"), 6).alias("share"))


def stage_mix(s: SparkSession, d: str) -> DataFrame:
    """Stages of the people each funder's bridged grants went to."""
    fg = Graph(s, d).funder_grant.select(F.col("src_id").alias("funder_id"), F.col("dst_id").alias("grant"))
    x = bridge(s, d).join(fg, "grant").select("funder_id", "person").distinct().join(researchers(s, d).select("person", "seniority"), "person")
    n = x.groupBy("funder_id", "seniority").agg(F.count("*").alias("people"))
    return n.join(n.groupBy("funder_id").agg(F.sum("people").alias("all")), "funder_id").select("funder_id", "seniority", "people", F.round(F.col("people") / F.col("all"), 6).alias("share"))


_ALL = (h_index, frequent, profiles, segments, researchers_by_segment, tool_targets, profile_aggregates, per_field_sample, matched_productivity, matched_bootstrap, matched_by_stage, resolution_bias, bridge_coverage, stage_mix)
QUERIES = {f.__name__: f for f in _ALL}

_NAMES = "[" + ", ".join(f"'{n}'" for n in FIELD_SLUGS) + "]"
_MAP = lambda m, sep=" ": "MAP {" + ", ".join(f"'{k}': '{v.replace(' ', sep)}'" for k, v in m.items()) + "}"
_AUTHORED = f"""authored AS (SELECT event_id AS work, user_id AS person, 2000 + day(ts) // 3 AS year, CASE WHEN k = 99 AND event_type = 'click' THEN 1600 ELSE k - 60 END AS cited, event_type = 'click' AS corresponding, p_brand AS topic,
    {_NAMES}[substr(p_brand, 7)::INT % 26 + 1] AS field FROM (SELECT *, (props::JSON ->> 'k')::BIGINT AS k FROM events) JOIN lineitem ON l_orderkey = event_id JOIN part ON p_partkey = l_partkey WHERE k >= 60 AND event_type IN ('view', 'click', 'purchase')),
  once AS (SELECT person, work, max(year) AS year, max(cited) AS cited FROM authored GROUP BY 1, 2),
  hs AS (SELECT person, max(least(cited, n)) AS h_index FROM (SELECT person, cited, row_number() OVER (PARTITION BY person ORDER BY cited DESC) AS n FROM once) GROUP BY 1),
  ff AS (SELECT person, list(field ORDER BY c DESC, field)[1] AS field, max(c) AS most FROM (SELECT person, field, count(*) AS c FROM authored GROUP BY 1, 2) GROUP BY 1),
  tt AS (SELECT person, array_to_string(list(topic ORDER BY c DESC, topic)[1:5], ';') AS topics FROM (SELECT person, topic, count(*) AS c FROM authored GROUP BY 1, 2) GROUP BY 1),
  p AS (SELECT * FROM (SELECT person, count(*) AS works, sum(cited)::BIGINT AS citations, max(cited) AS max_citations, min(year) AS first_year, max(year) AS last_year FROM once GROUP BY 1) JOIN hs USING (person) JOIN (SELECT person, sum(corresponding::INT)::BIGINT AS corresponding FROM authored GROUP BY 1) USING (person) JOIN (SELECT person, field FROM ff) USING (person) JOIN tt USING (person)),
  r0 AS (SELECT *, coalesce({_MAP(FIELD_SLUGS).replace("MAP", "MAP", 1)}[field], 'other') AS field_slug, CASE WHEN h_index >= 25 OR citations >= 5000 OR max_citations >= 1500 THEN 'eminent' WHEN last_year - first_year + 1 >= 8 AND (h_index >= 8 OR citations >= 600) THEN 'established'
    WHEN last_year - first_year + 1 <= 7 AND (citations >= 80 OR max_citations >= 50 OR corresponding > 0 AND citations >= 30) THEN 'rising-star' ELSE 'early/unknown' END AS seniority, CASE WHEN {THIS_YEAR} - last_year > {WINDOW} THEN 'dormant' WHEN corresponding > 0 THEN 'active-pi' ELSE 'active' END AS activity_tier FROM p),
  r AS (SELECT r0.*, o.name AS org_name, o.ror_id, o.country_code, field_slug || '/' || seniority || '/' || activity_tier AS segment, {_MAP(TOOLS, ";")}[field_slug] AS tool_fit, activity_tier = 'active-pi' AS high_value FROM r0 LEFT JOIN person_org po ON po.src_id = person LEFT JOIN org o ON o.atlas_id = po.dst_id),
  bridge AS (SELECT DISTINCT user_id AS person, event_id AS grant_id FROM events WHERE (props::JSON ->> 'k')::BIGINT >= 95 AND event_type = 'purchase'),
  lab AS (SELECT r.*, r.person IN (SELECT person FROM bridge) AS funded FROM r), coh AS (SELECT * FROM lab WHERE ror_id IN (SELECT ror_id FROM lab WHERE funded AND ror_id IS NOT NULL))"""
_MEANS = ", ".join(f"avg({c}) FILTER (WHERE {'' if n == 'f' else 'NOT '}funded) AS {o}_{n}" for o, c in zip(OUTCOMES, ("works", "h_index", "citations"), strict=True) for n in "fc")


def _strata(years: int) -> str:
    return f"(SELECT field_slug, seniority, first_year // {years} * {years} AS era, count(*) FILTER (WHERE funded) AS n, count(*) FILTER (WHERE NOT funded) AS others, {_MEANS} FROM coh GROUP BY 1, 2, 3 HAVING n >= 2 AND others >= 2)"


def _ratio_sql(o: str, w: str = "n") -> str:
    return f"sum({w} * {o}_f) / nullif(sum({w} * {o}_c), 0)"


_STRATUM = "field_slug || '|' || seniority || '|' || era"
_SQL = {
    "h_index": "SELECT * FROM hs",
    "frequent": "SELECT person, field, most, topics FROM ff JOIN tt USING (person)",
    "profiles": "SELECT * FROM p",
    "segments": "SELECT person, field_slug, seniority, activity_tier, segment, tool_fit, high_value FROM r",
    "researchers_by_segment": "SELECT field_slug, seniority, activity_tier, count(*) AS researchers, count(*) FILTER (WHERE corresponding > 0) AS corresponding FROM r GROUP BY 1, 2, 3 ORDER BY researchers DESC, 1, 2, 3 LIMIT 30",
    "tool_targets": "SELECT field_slug, 'Person ' || person AS full_name, org_name AS primary_org_name, country_code, works AS works_count, h_index AS h_index_proxy, seniority, segment FROM r WHERE tool_fit LIKE '%fair-data-mgmt%' AND activity_tier = 'active-pi' ORDER BY h_index DESC, works DESC, person LIMIT 25",
    "profile_aggregates": "SELECT field_slug, count(*) AS people, round(avg(works), 4) AS mean_works, median(citations) AS median_citations, round(100 * avg((ror_id IS NOT NULL)::INT), 4) AS pct_ror, round(100 * avg((corresponding > 0)::INT), 4) AS pct_corresponding, round(100 * avg(high_value::INT), 4) AS pct_high_value FROM r GROUP BY 1",
    "per_field_sample": "SELECT field_slug, person FROM (SELECT *, row_number() OVER (PARTITION BY field_slug ORDER BY h_index DESC, works DESC, person) AS rn FROM r WHERE high_value) WHERE rn <= 5",
    "matched_productivity": " UNION ALL ".join(f"SELECT {y} AS bin, count(*) AS strata, sum(n)::BIGINT AS funded, " + ", ".join(f"round({_ratio_sql(o)}, 6) AS {o}" for o in OUTCOMES) + f" FROM {_strata(y)}" for y in (5, 1)),
    "matched_bootstrap": "SELECT " + ", ".join(f"round(quantile_cont({o}, {q}), 6) AS {o}_{n}" for o in OUTCOMES for n, q in (("lo", 0.025), ("hi", 0.975))) + " FROM (SELECT b, " + ", ".join(f"{_ratio_sql(o, 'n * w')} AS {o}" for o in OUTCOMES) + f" FROM {resampled_sql(_strata(5), _STRATUM, 2000, 42)} GROUP BY 1)",
    "matched_by_stage": f"SELECT seniority, count(*) AS strata, sum(n)::BIGINT AS funded, round({_ratio_sql('works')}, 6) AS works FROM {_strata(5)} GROUP BY 1",
    "resolution_bias": "SELECT 'all' AS population, count(*) AS people, round(avg(works), 4) AS mean, median(works) AS median, max(works) AS most FROM r UNION ALL SELECT 'funded', count(*), round(avg(works), 4), median(works), max(works) FROM lab WHERE funded",
    "bridge_coverage": "SELECT field_slug, count(*) AS people, count(g) AS bridged, coalesce(sum(g), 0)::BIGINT AS grants, round(count(g) / count(*), 6) AS share FROM r LEFT JOIN (SELECT person AS q, count(DISTINCT grant_id) AS g FROM bridge GROUP BY 1) ON q = person GROUP BY 1",
    "stage_mix": "SELECT *, round(people / sum(people) OVER (PARTITION BY funder_id), 6) AS share FROM (SELECT fg.src_id AS funder_id, seniority, count(DISTINCT r.person) AS people FROM bridge b JOIN fg ON fg.dst_id = b.grant_id JOIN r ON r.person = b.person GROUP BY 1, 2)",
}
ORACLES = {k: with_views(f"WITH {_AUTHORED} {v}") for k, v in _SQL.items()}
