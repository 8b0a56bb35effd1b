"""Linking the spellings of one institution or person: rewriting, equi-join on forms, rarity, evidence.

1. Every record is rewritten to all its forms (``names``): canonical words in alphabetical order, with one letter of a
   telling word left out (so that one typo on either side still meets), acronyms; for people surname with given name,
   with initials, with nicknames resolved, in both orders where the order isn't told. A ROR id, host or ORCID is a form too.
2. Records alike in all that counts are one profile, so copies cost nothing.
3. Profiles that share a form meet and are scored by rarity: how surely the form is written (``WEIGHT``), divided by how
   many it may stand for - places for institutions, given names behind initials for people. A form that only one can hold
   scores in full; one that several hold says too little by itself.
4. Evidence adds to the score (an id, a host, the very place), and what contradicts (other id, host, country, place, given
   name, initial) rules a pair out. Pairs that reach ``LEAST`` are links.
5. Links are closed to components; a component's members stand for one entity.

A form that more than ``PAIRWISE`` profiles share is paired out in blocks of about so many, spread over tasks. All pairs
are judged by the same rules, however many share a form; their number is quadratic in that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundloom.llm import names as N
from fundloom.llm.survivors import host, ror_key
from fundloom.operators.components import components
from fundloom.session import cut

PAIRWISE = 200
#: What a shared form is worth by its kind: canonical words, a letter left out, an acronym.
WEIGHT = {"c": 1.0, "d": 0.95, "a": 0.5}
#: Least score of a link. A kind with a letter left out reaches it if it can stand for one only.
LEAST = 0.9

_ORG = "id string, main string, forms array<string>, city string, country string, ror string, host string, lat double, lon double"
_PERSON = "id string, forms array<string>, sur string, giv string, gi string, mid string, orcid string, alone boolean"


def org_rows(df: DataFrame) -> DataFrame:
    """Rewritten institutions of ``df`` (id, name, city, country, ror, host, lat, lon); names that say nothing drop out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                got = N.org_forms(r.name, r.city)
                if got is None:
                    continue
                canon, acro = got
                forms = {f"c:{c}" for c in canon} | {f"a:{a}" for a in acro} | {f"d:{c}" for c in canon}
                for c in canon:
                    ws = c.split()
                    for i, w in enumerate(ws):
                        if len(w) >= 5 and w not in N.GENERIC:
                            forms |= {"d:" + " ".join([*ws[:i], d, *ws[i + 1 :]]) for d in N.deletions(w)}
                forms |= {f"r:{r.ror}"} if r.ror else set()
                forms |= {f"h:{r.host}"} if r.host else set()
                out.append((r.id, canon[0] if canon else None, sorted(forms), N.place(r.city), N.country(r.country), r.ror, r.host, r.lat, r.lon))
            yield pd.DataFrame(out, columns=["id", "main", "forms", "city", "country", "ror", "host", "lat", "lon"])

    return df.select("id", "name", "city", "country", "ror", "host", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).mapInPandas(run, _ORG)


def person_rows(df: DataFrame) -> DataFrame:
    """Rewritten people of ``df`` (id, full_name, first_name, last_name, orcid), a row per reading of the name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                for sur, giv, gi, mid in N.person_forms(r.full_name, r.first_name, r.last_name):
                    forms = {f"o:{r.orcid}"} if r.orcid else set()
                    if giv:
                        forms.add(f"f:{sur}|{giv}")
                        forms |= {f"s:{d}|{giv}" for d in N.deletions(sur)} if len(sur) >= 5 else set()
                        forms |= {f"g:{sur}|{d}" for d in N.deletions(giv)} if len(giv) >= 5 else set()
                    forms |= {f"i:{d}|{gi}" for d in (N.deletions(sur) if len(sur) >= 5 else [sur])}
                    out.append((r.id, sorted(forms), sur, giv, gi, mid, r.orcid, giv is None))
            yield pd.DataFrame(out, columns=["id", "forms", "sur", "giv", "gi", "mid", "orcid", "alone"])

    return df.select("id", "full_name", "first_name", "last_name", "orcid").mapInPandas(run, _PERSON)


def orcid_key(c: Column) -> Column:
    k = F.regexp_extract(F.upper(c), r"(\d{4}-?\d{4}-?\d{4}-?\d{3}[\dX])[\s/]*$", 1)
    return F.when(k != "", F.replace(k, F.lit("-")))


def _profiles(rows: DataFrame, attributes: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows alike in ``attributes`` as one profile: ``(pid, attributes, forms)`` and ``(id, pid)``."""
    keyed = rows.withColumn("k", F.to_json(F.struct(*attributes)))
    one = keyed.groupBy("k").agg(F.min(F.struct("id", "forms", *attributes)).alias("m"))
    prof = cut(one.select(F.concat_ws("\x1f", "m.id", F.hex(F.xxhash64("k"))).alias("pid"), "k", "m.forms", *[f"m.{c}" for c in attributes]))
    member = cut(keyed.select("id", "k").join(prof.select("k", "pid"), "k").select("id", "pid").distinct())
    return prof.drop("k"), member


def _meet(form: DataFrame) -> DataFrame:
    """All pairs of profiles that share a form, with the form."""
    size = form.groupBy("form").agg(F.count("*").alias("held")).where("held > 1")
    kept = form.join(size, "form").withColumn("blocks", F.ceil(F.col("held") / PAIRWISE)).withColumn("block", F.pmod(F.xxhash64("pid"), F.col("blocks")))
    # Each profile goes to every pair of blocks that its own is part of; two of one block meet where it is paired with itself.
    cell = kept.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    a, b = cell.select("form", "lo", "hi", F.col("pid").alias("a"), F.col("block").alias("i")), cell.select("form", "lo", "hi", F.col("pid").alias("b"), F.col("block").alias("j"))
    return a.join(b, ["form", "lo", "hi"]).where("a < b and (i <> j or lo = hi)").select("form", "a", "b")


def _sided(df: DataFrame, x: str, columns: list[str]) -> DataFrame:
    return df.select(F.col("pid").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in columns])


def _both(c: str) -> Column:
    return F.col(f"{c}_a").isNotNull() & F.col(f"{c}_b").isNotNull()


def _same(c: str) -> Column:
    return F.coalesce(F.col(f"{c}_a") == F.col(f"{c}_b"), F.lit(False))


def _differ(c: str) -> Column:
    return F.coalesce(F.col(f"{c}_a") != F.col(f"{c}_b"), F.lit(False))


def org_links(prof: DataFrame) -> DataFrame:
    """``(a, b, score)``: profiles that rarity and evidence link."""
    attributes = ["main", "city", "country", "ror", "host", "lat", "lon"]
    form = cut(prof.select("pid", F.explode("forms").alias("form")))
    kind = F.substring("form", 1, 1)
    worth = F.coalesce(*[F.when(kind == k, w) for k, w in WEIGHT.items()], F.lit(0.0))
    told = _meet(form).groupBy("a", "b").agg(F.max(worth).alias("worth"))
    # Rarity of a canonical form: in how many places it is found, by country and altogether.
    found = prof.where("main is not null").groupBy("main", "country").agg(F.count_distinct(F.soundex("city")).alias("towns"))
    lands = found.groupBy("main").agg(F.count("country").alias("lands"), F.max("towns").alias("most_towns"))
    side = lambda x: _sided(prof, x, attributes).join(found.select(F.col("main").alias(f"main_{x}"), F.col("country").alias(f"country_{x}"), F.col("towns").alias(f"towns_{x}")), [f"main_{x}", f"country_{x}"], "left").join(lands.select(F.col("main").alias(f"main_{x}"), F.col("lands").alias(f"lands_{x}"), F.col("most_towns").alias(f"most_{x}")), f"main_{x}", "left")
    p = told.join(cut(side("a")), "a").join(cut(side("b")), "b")
    far = F.greatest(F.abs(F.col("lat_a") - F.col("lat_b")), F.abs(F.col("lon_a") - F.col("lon_b")))
    against = _differ("ror") | _differ("host") | _differ("country") | F.coalesce(far > 0.5, F.lit(False))
    near_city = _same("city") | F.coalesce(F.levenshtein("city_a", "city_b") <= F.least(F.lit(2), F.floor(F.length("city_a") / 4)), F.lit(False)) | F.coalesce(F.col("city_a").contains(F.col("city_b")) | F.col("city_b").contains(F.col("city_a")), F.lit(False))
    other_city = _both("city") & ~near_city
    known = _same("ror") | _same("host")
    here = F.coalesce(far <= 0.1, F.lit(False))
    held = lambda c: F.greatest(F.lit(1), F.coalesce(f"{c}_a", F.lit(1)), F.coalesce(f"{c}_b", F.lit(1)))
    named = F.col("worth") > WEIGHT["a"]
    # How many institutions a form may stand for: towns of the country where that is known, of all countries where not.
    several = F.when(_both("city"), F.lit(None)).when(_same("country"), held("towns")).when(~_both("country"), held("lands") * held("most"))
    rarity = F.coalesce(F.when(named, F.col("worth") / several), F.lit(0.0))
    # An acronym alone is little: it needs the very place.
    place = ~other_city & ((named & (here | near_city)) | ((F.col("worth") == WEIGHT["a"]) & (here | _same("city"))))
    score = rarity + known.cast("double") + F.when(place, F.col("worth") * 0.1 + 0.85).otherwise(0.0)
    return p.where(~against).withColumn("score", score).where(F.col("score") >= LEAST).groupBy("a", "b").agg(F.max("score").alias("score"))


def person_links(prof: DataFrame) -> DataFrame:
    """``(a, b, score)``: profiles that rarity and evidence link; a profile that agrees with several people links to none of them."""
    attributes = ["sur", "giv", "gi", "mid", "orcid", "alone"]
    form = cut(prof.select("pid", "alone", "giv", F.explode("forms").alias("form")))
    # Rarity of an initial form: how many given names are behind it. Only a name of initials is looked up by initials.
    heads = form.where("form like 'i:%'").groupBy("form").agg(F.count_distinct(F.soundex("giv")).alias("givens"), F.max("alone").alias("asked"))
    plainly = form.where("form not like 'i:%'").select("pid", "form").withColumn("givens", F.lit(1).cast("long"))
    initial = form.join(heads.where("asked"), "form").select("pid", "form", "givens")
    forms = cut(plainly.unionByName(initial))
    pairs = _meet(forms.select("pid", "form"))
    told = pairs.join(heads.select("form", "givens"), "form", "left").groupBy("a", "b").agg(F.max(F.col("form").like("o:%")).alias("id"), F.max(~F.col("form").like("i:%")).alias("full"), F.max(F.coalesce("givens", F.lit(1))).alias("givens"))
    p = told.join(_sided(prof, "a", attributes), "a").join(_sided(prof, "b", attributes), "b")
    near = lambda c: _same(c) | F.coalesce(F.levenshtein(f"{c}_a", f"{c}_b") <= 2, F.lit(False))
    against = _differ("orcid") | _differ("mid") | (_both("giv") & ~near("giv")) | _differ("gi") & ~F.col("id") | ~near("sur")
    # A full name, or initials shared by so many given names, unless the middle initial tells which.
    initials = F.when(F.col("alone_a") | F.col("alone_b"), F.when(_same("mid") & _both("mid"), F.lit(WEIGHT["d"])).otherwise(WEIGHT["d"] / F.greatest(F.lit(1), "givens")))
    score = F.col("id").cast("double") + F.greatest(F.when(F.col("full"), F.lit(WEIGHT["c"])).otherwise(0.0), F.coalesce(initials, F.lit(0.0)))
    p = p.withColumn("score", score)
    ok = cut(p.where(~against & (F.col("score") >= LEAST)).select("a", "b", "score", "orcid_a", "orcid_b", "mid_a", "mid_b", "giv_a", "giv_b", "alone_a", "alone_b"))
    # A profile that says less than its partners, and whose partners contradict each other, could be any of them.
    ends = ok.select(F.col("a").alias("p"), F.col("orcid_a").alias("po"), F.col("mid_a").alias("pm"), F.col("orcid_b").alias("o"), F.col("mid_b").alias("m"), F.soundex("giv_b").alias("g"), F.col("alone_a").alias("pa")).unionByName(
        ok.select(F.col("b").alias("p"), F.col("orcid_b").alias("po"), F.col("mid_b").alias("pm"), F.col("orcid_a").alias("o"), F.col("mid_a").alias("m"), F.soundex("giv_a").alias("g"), F.col("alone_b").alias("pa"))
    )
    torn = ends.groupBy("p", "po", "pm", "pa").agg(F.count_distinct("o").alias("os"), F.count_distinct("m").alias("ms"), F.count_distinct("g").alias("gs"))
    torn = torn.where("(po is null and os > 1) or (pm is null and po is null and ms > 1) or (pa and pm is null and po is null and gs > 1)").select("p")
    return ok.join(torn.withColumnRenamed("p", "a"), "a", "left_anti").join(torn.withColumnRenamed("p", "b"), "b", "left_anti").groupBy("a", "b").agg(F.max("score").alias("score"))


def _closed(member: DataFrame, links: DataFrame) -> DataFrame:
    """``(id, entity)``: members of linked profiles, and of profiles with several ids."""
    comp = components(links)
    tied = member.join(comp.withColumnRenamed("node", "pid"), "pid", "left").select("id", F.coalesce("component", "pid").alias("entity")).distinct()
    twice = tied.groupBy("id").agg(F.count("*").alias("c")).where("c > 1")
    if twice.isEmpty():  # readings of one name in two components tie these together
        return tied
    again = components(tied.select(F.concat(F.lit("e"), "entity").alias("a"), F.concat(F.lit("i"), "id").alias("b")))
    return again.where("node like 'i%'").select(F.expr("substring(node, 2)").alias("id"), F.col("component").alias("entity"))


def org_entities(orgs: DataFrame, with_ror: bool = True) -> DataFrame:
    """``(id, entity)`` for institutions ``(id, name, city, country, ror, host, lat, lon)``."""
    rows = org_rows(orgs if with_ror else orgs.withColumn("ror", F.lit(None).cast("string")))
    prof, member = _profiles(rows, ORG_PROFILE)
    return _closed(member, org_links(prof))


def person_entities(people: DataFrame, with_orcid: bool = True) -> DataFrame:
    """``(id, entity)`` for people ``(id, full_name, first_name, last_name, orcid)``."""
    rows = person_rows(people if with_orcid else people.withColumn("orcid", F.lit(None).cast("string")))
    prof, member = _profiles(rows, PERSON_PROFILE)
    return _closed(member, person_links(prof))


def scored_links(rows: DataFrame, attributes: list[str], link: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``(key_a, key_b, score)``: the links themselves, between the least ids of their profiles, the smaller first; of
    several profiles of the same ids the best score."""
    prof, member = _profiles(rows, attributes)
    low = member.groupBy("pid").agg(F.min("id").alias("id"))
    named = link(prof).join(low.select(F.col("pid").alias("a"), F.col("id").alias("x")), "a").join(low.select(F.col("pid").alias("b"), F.col("id").alias("y")), "b").where("x <> y")
    return named.groupBy(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")).agg(F.round(F.max("score"), 6).alias("score"))


ORG_PROFILE = ["main", "city", "country", "ror", "host", "lat", "lon"]
PERSON_PROFILE = ["sur", "giv", "gi", "mid", "orcid", "alone"]


def variant_scores(organization: DataFrame, person: DataFrame) -> DataFrame:
    """``(kind, key_a, key_b, score)``: the direct links behind ``variants`` with their score; rows as for ``variants``."""
    o = scored_links(org_rows(organizations(organization)), ORG_PROFILE, org_links).select(F.lit("organization").alias("kind"), "*")
    return o.unionByName(scored_links(person_rows(people(person)), PERSON_PROFILE, person_links).select(F.lit("person").alias("kind"), "*"))


def organizations(df: DataFrame) -> DataFrame:
    return df.where("atlas_id is not null").select(F.col("atlas_id").alias("id"), "name", "city", F.col("country_code").alias("country"), ror_key(F.col("ror_id")).alias("ror"), host(F.col("homepage")).alias("host"), "lat", "lon")


def recipients(df: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.where("`Internal ID` is not null").select(
        F.concat(F.lit("\x02"), "Internal ID").alias("id"), F.col("Recipient Org:Name").alias("name"), F.col("Recipient Org:City").alias("city"), F.col("Recipient Org:Country").alias("country"),
        none.alias("ror"), none.alias("host"), none.cast("double").alias("lat"), none.cast("double").alias("lon"),
    )


def people(df: DataFrame) -> DataFrame:
    return df.where("atlas_id is not null").select(F.col("atlas_id").alias("id"), "full_name", "first_name", "last_name", orcid_key(F.col("orcid")).alias("orcid"))


def variants(organization: DataFrame, person: DataFrame, sample_rows: DataFrame) -> DataFrame:
    """``(kind, key_a, key_b)``: linked pairs of institutions and of people (smaller key first), and of each sample row's
    recipient with institutions.

    Null keys and names that say nothing take no part; repeated rows count once; further columns are ignored; a name
    that nothing is linked to gives no row. The pairs of an entity are all given, as the query asks for them.
    """
    org = cut(org_entities(organizations(organization).unionByName(recipients(sample_rows))))
    per = cut(person_entities(people(person)))
    pair = lambda e: e.alias("x").join(e.alias("y"), "entity").where("x.id < y.id").select(F.col("x.id").alias("key_a"), F.col("y.id").alias("key_b")).distinct()
    own = pair(org.where("id not like '\x02%'")).select(F.lit("organization").alias("kind"), "*")
    rec = org.where("id like '\x02%'").alias("x").join(org.where("id not like '\x02%'").alias("y"), "entity").select(F.lit("recipient").alias("kind"), F.expr("substring(x.id, 2)").alias("key_a"), F.col("y.id").alias("key_b")).distinct()
    return own.unionByName(rec).unionByName(pair(per).select(F.lit("person").alias("kind"), "*"))
