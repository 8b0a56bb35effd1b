"""Conservative resolution: institutions to a register, people to people, awards to grants. No match rather than a wrong one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundloom.functions import text
from fundloom.session import cut

#: How much a kind of register name counts.
PRIORITY = {"display": 3, "label": 2, "alias": 1, "acronym": 0}


def register_index(register: DataFrame) -> DataFrame:
    """Names of a register ``(ror, name, kind, country)``, normalised: adds ``norm, expanded, tokens, prio, umbrella``."""
    prio = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in PRIORITY.items() for x in kv]), F.col("kind")), F.lit(0))
    x = register.withColumn("norm", text.normalize_name(F.col("name"))).where("norm <> ''").withColumn("country", text.canon_country(F.col("country")))
    last = F.element_at(F.split("norm", " "), -1)
    return x.select("ror", "kind", "country", "norm", text.expand_abbreviations(F.col("norm")).alias("expanded"), text.name_tokens(F.col("norm")).alias("tokens"), prio.alias("prio"), last.isin(*text.UMBRELLA).alias("umbrella")).distinct()


def _picked(cand: DataFrame) -> DataFrame:
    """``(qid, ror, t)`` of candidates ``(qid, cc, ror, country, prio, t)``, tier by tier: those of the query's country if
    there are any (tier 3 takes no others), of these the one of highest priority, nothing on a tie."""
    best = cand.groupBy("qid", "t", "cc", "ror").agg(F.max("prio").alias("prio"), F.max(F.coalesce(F.col("country") == F.col("cc"), F.lit(False))).alias("here"))
    w = Window.partitionBy("qid", "t")
    x = best.where("here or t <> 3").withColumn("any_here", F.max("here").over(w)).where("here or not any_here or cc is null")
    x = x.withColumn("top", F.max("prio").over(w)).where("prio = top").withColumn("tied", F.count("*").over(w)).where("tied = 1")
    return x.select("qid", "ror", "t")


def match_institutions(queries: DataFrame, index: DataFrame, min_fuzzy: float = 0.85) -> DataFrame:
    """``(name, country, ror, method, score)`` for each distinct (name, country) that resolves.

    Tiers: equal normalised name (1.0), equal after abbreviations are spelt out (0.99), acronym within the country
    (0.97), rarity-weighted containment within the country (its value). A tier that refuses a tie hands on to the next.
    Candidates come from equi-joins on names, or on (country, rarest word) for the last tier. Null and empty names give
    no row; repeated names are matched once.
    """
    q = queries.select("name", "country").distinct().withColumn("norm", text.normalize_name(F.col("name"))).where("norm <> ''")
    q = q.select("name", "country", "norm", text.canon_country(F.col("country")).alias("cc"), text.expand_abbreviations(F.col("norm")).alias("expanded"), text.name_tokens(F.col("norm")).alias("tokens"), F.md5(F.concat_ws("\x1f", "name", F.coalesce("country", F.lit("\x00")))).alias("qid"))
    q, index = cut(q), cut(index)
    named = index.where("kind <> 'acronym'")
    parts = ((named, "norm", "norm", F.col("prio")), (named, "expanded", "expanded", F.col("prio")), (index.where("kind = 'acronym'"), "norm", "norm", F.lit(0)))
    cand = [q.select("qid", "cc", F.col(mine).alias("key")).join(df.select(F.col(theirs).alias("key"), "ror", "country", prio.alias("prio")), "key").withColumn("t", F.lit(t)) for t, (df, mine, theirs, prio) in enumerate(parts, 1)]
    tiers = _picked(reduce(DataFrame.unionByName, cand)).groupBy("qid").agg(F.min(F.struct("t", "ror")).alias("m")).select("qid", "m.ror", "m.t")
    tiers = cut(tiers)
    method = F.element_at(F.array(F.lit("exact"), F.lit("expanded"), F.lit("acronym")), F.col("t"))
    score = F.element_at(F.array(F.lit(1.0), F.lit(0.99), F.lit(0.97)), F.col("t"))
    # Only names that no tier above resolves go on to the last one.
    fuzzy = _fuzzy(q.join(tiers, "qid", "left_anti"), named.where("country is not null"), min_fuzzy).select("qid", "ror", F.lit("fuzzy").alias("method"), F.round("w", 4).alias("score"))
    return q.select("qid", "name", "country").join(tiers.select("qid", "ror", method.alias("method"), score.alias("score")).unionByName(fuzzy), "qid").select("name", "country", "ror", "method", "score")


def resolve_institutions(orgs: DataFrame, index: DataFrame, min_fuzzy: float = 0.85) -> DataFrame:
    """``(name, country, given, ror, method, score)`` for each distinct (name, country, ror_id) of ``orgs``.

    An institution that carries an id keeps it (``prematched``, 1.0), whatever its name; the others are matched by name,
    and those that no tier resolves stay, with nulls.
    """
    o = orgs.select("name", "country", F.nullif(F.btrim("ror_id"), F.lit("")).alias("given")).distinct()
    got = match_institutions(o.where("given is null"), index, min_fuzzy)
    told = o.where("given is not null").select("name", "country", "given", F.col("given").alias("ror"), F.lit("prematched").alias("method"), F.lit(1.0).alias("score"))
    on = [o["name"].eqNullSafe(got["name"]), o["country"].eqNullSafe(got["country"])]
    rest = o.where("given is null").join(got, on, "left").select(o["name"], o["country"], "given", F.col("ror").cast("string").alias("ror"), "method", "score")
    return told.unionByName(rest)


def _fuzzy(q: DataFrame, named: DataFrame, least: float) -> DataFrame:
    """The last tier: ``(qid, ror, w)``. Weights are ``ln((n + 1) / (df + 1)) + 1`` within the country, over its names.

    The rarest word of the query (ties: the first in order) must be in the candidate; a tie on weight and on being an
    umbrella organisation is refused.
    """
    n = named.groupBy("country").agg(F.count("*").alias("n"))
    df = named.select("country", F.explode("tokens").alias("t")).groupBy("country", "t").agg(F.count("*").alias("df"))
    asked = q.where((F.size("tokens") >= 2) & F.col("cc").isNotNull()).select("qid", F.col("cc").alias("country"), "tokens")
    words = asked.select("qid", "country", F.explode("tokens").alias("t")).join(n, "country").join(df, ["country", "t"], "left")
    words = words.withColumn("idf", F.log((F.col("n") + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1)
    per = words.groupBy("qid", "country").agg(F.sum("idf").alias("total"), F.min_by("t", F.struct(-F.col("idf"), "t")).alias("key"), F.map_from_entries(F.collect_list(F.struct("t", "idf"))).alias("idf"))
    posting = named.select("country", F.explode("tokens").alias("key"), "ror", "tokens", "prio", "umbrella")
    c = per.join(asked.select("qid", F.col("tokens").alias("asked")), "qid").join(posting, ["country", "key"])
    common = F.array_intersect("asked", "tokens")
    c = c.withColumn("w", F.round(F.aggregate(common, F.lit(0.0), lambda a, t: a + F.element_at("idf", t)) / F.col("total"), 6)).withColumn("j", F.size(common) / F.size(F.array_union("asked", "tokens")))
    best = c.groupBy("qid", "ror").agg(F.max(F.struct("w", (~F.col("umbrella")).alias("own"), "prio", "j")).alias("k"))
    w = Window.partitionBy("qid").orderBy(F.desc("k"), "ror")
    top = best.select("qid", "ror", "k", F.row_number().over(w).alias("rn"), F.lead("k").over(w).alias("next"))
    tied = F.coalesce((F.col("k.w") == F.col("next.w")) & (F.col("k.own") == F.col("next.own")), F.lit(False))
    return top.where((F.col("rn") == 1) & (F.col("k.w") >= least) & ~tied).select("qid", "ror", F.col("k.w").alias("w"))


def link_awards(awards: DataFrame, grants: DataFrame) -> DataFrame:
    """``(work_id, grant_id)`` once each: awards ``(work_id, source, award)`` and grants ``(atlas_id, source, source_id)``
    that share a key. Of several grants under one key the greatest id counts; of several keys of an award the first."""
    index = grants.select("atlas_id", F.explode(text.award_keys(F.col("source"), F.col("source_id"))).alias("key")).groupBy("key").agg(F.max("atlas_id").alias("grant_id"))
    asked = awards.select("work_id", "source", "award", F.explode(text.award_keys(F.col("source"), F.col("award"))).alias("key"))
    return asked.join(index, "key").groupBy("work_id", "source", "award").agg(F.min_by("grant_id", "key").alias("grant_id")).select("work_id", "grant_id").distinct()


def _given_fits(a: str, b: str) -> Column:
    """Equal first given names, or equal initials where one side is an initial; neither may be missing."""
    x, y = F.get(a, F.lit(0)), F.get(b, F.lit(0))
    initial = (F.length(x) == 1) | (F.length(y) == 1)
    return F.coalesce((x == y) | (initial & (F.substring(x, 1, 1) == F.substring(y, 1, 1))), F.lit(False))


def resolve_people(asked: DataFrame, known: DataFrame) -> DataFrame:
    """``(qid, person_id, method, score, reason)`` for each asked person, resolved or with the reason for refusing.

    ``asked``: qid, full_name, first_name, last_name, orcid, org, field; ``known``: person_id and the same. An ORCID
    decides (1.0). Otherwise people meet on (org, surname); given names must fit; where the asked person's field is known
    it must agree (0.97), else name and organisation suffice (0.90). Several candidates: the only one with an equal full
    given name, or nobody. Copies of a known person count once.
    """
    p = lambda: text.name_parts(F.col("full_name"), F.col("first_name"), F.col("last_name"))
    a = asked.select("qid", "orcid", "org", "field", p().alias("n")).select("qid", "orcid", "org", "field", F.col("n.surname").alias("sur"), F.col("n.given").alias("g"))
    k = known.select("person_id", "orcid", "org", "field", p().alias("n"))
    by_orcid = k.where("orcid is not null").groupBy("orcid").agg(F.min("person_id").alias("by_orcid"))
    a = a.join(by_orcid, "orcid", "left")
    c = k.where("n is not null and org is not null").select("person_id", "org", F.col("field").alias("kf"), F.col("n.surname").alias("sur"), F.col("n.given").alias("kg")).distinct()
    pair = a.where("by_orcid is null").join(c, ["org", "sur"]).withColumn("fits", _given_fits("g", "kg"))
    has_field = F.col("field").isNotNull() & (F.col("field") != "other")
    same = F.coalesce(F.col("kf") == F.col("field"), F.lit(False))
    strong = (F.length(F.get("g", F.lit(0))) > 1) & (F.get("g", F.lit(0)) == F.get("kg", F.lit(0)))
    pair = pair.withColumn("ok", F.col("fits") & (~has_field | same)).withColumn("strong", F.col("ok") & F.coalesce(strong, F.lit(False)))
    one = lambda c: F.count_distinct(F.when(F.col(c), F.col("person_id")))
    sums = pair.groupBy("qid").agg(F.max("fits").alias("fits"), one("ok").alias("oks"), one("strong").alias("strongs"), F.min(F.when(F.col("ok"), F.col("person_id"))).alias("only"), F.min(F.when(F.col("strong"), F.col("person_id"))).alias("strongest"))
    x = a.join(sums, "qid", "left")
    found = F.when(F.col("by_orcid").isNotNull(), F.col("by_orcid")).when(F.col("oks") == 1, F.col("only")).when((F.col("oks") > 1) & (F.col("strongs") == 1), F.col("strongest"))
    method = F.when(F.col("by_orcid").isNotNull(), "orcid").when(found.isNotNull(), F.when(has_field, "name+org+field").otherwise("name+org"))
    reason = F.when(found.isNotNull(), None).when(F.col("sur").isNull(), "unparseable-name").when(F.col("fits").isNull(), "no-org-overlap").when(~F.col("fits"), "no-name-overlap").when(has_field & (F.col("oks") > 0), "ambiguous-field").when(has_field, "field-conflict").otherwise("ambiguous")
    score = F.when(method == "orcid", 1.0).when(method == "name+org+field", 0.97).when(method == "name+org", 0.90)
    return x.select("qid", found.alias("person_id"), method.alias("method"), score.alias("score"), reason.alias("reason"))


def modal(df: DataFrame, key: str, value: str, first: Column | None = None) -> DataFrame:
    """``(key, value, n)``: the most frequent value per key; ``first`` (a flag) outranks frequency, the smaller value settles ties."""
    c = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"), F.max(first if first is not None else F.lit(False)).alias("f"))
    return c.groupBy(key).agg(F.min_by(F.struct(value, "n"), F.struct(~F.col("f"), -F.col("n"), F.col(value))).alias("m")).select(key, f"m.{value}", "m.n")
