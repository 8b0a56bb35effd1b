"""Landed raw files of funders to the tables of the graph.

A connector reads what was landed (no network here) with a declared schema and maps it to *records*: one row per award
with arrays of its funders, institutions, people and fields. ``graph_tables`` turns records of any source into the
published tables: each is an independent projection, exploded and deduplicated on its key; nothing is gathered.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundloom.functions import dates, keys, text
from fundloom.operators.consolidate import dedup_edges, dedup_entities

FUNDER = "struct<parts: array<string>, name: string, short_name: string, country_code: string, funder_type: string, crossref: string, awards: boolean>"
ORG = "struct<name: string, role: string, country_code: string, city: string, region: string, org_type: string, homepage: string, ror: string, lat: double, lon: double>"
PERSON = "struct<full_name: string, first_name: string, last_name: string, role: string, pid: string, orcid: string>"
RECORD = {
    "source": "string", "key": "string", "url": "string", "title": "string", "abstract": "string", "amount": "double", "currency": "string", "start_date": "string", "end_date": "string", "status": "string", "program": "string",
    "funders": f"array<{FUNDER}>", "orgs": f"array<{ORG}>", "people": f"array<{PERSON}>", "fields": "array<string>",
}
# Rates to USD and the day they were taken.
RATES, RATES_AS_OF = {"USD": 1.0, "EUR": 1.08, "GBP": 1.27}, "2026-06-01"


blank = lambda c: F.nullif(keys.strip(c), F.lit(""))


def _struct(kind: str, **columns: Column) -> Column:
    names = [x.split(":")[0].strip() for x in kind[len("struct<") : -1].split(", ")]
    return F.struct(*[columns.get(n, F.lit(None)).alias(n) for n in names]).cast(kind)


def funder(parts: list[str], name: str, short: str, country: str, kind: str = "government", crossref: str | None = None, awards: bool = True) -> Column:
    return _struct(FUNDER, parts=F.array(*map(F.lit, parts)), name=F.lit(name), short_name=F.lit(short), country_code=F.lit(country), funder_type=F.lit(kind), crossref=F.lit(crossref), awards=F.lit(awards))


def org(**c: Column) -> Column:
    return _struct(ORG, **c)


def person(**c: Column) -> Column:
    return _struct(PERSON, **c)


def named(items: Column, field: str = "name") -> Column:
    """Structs whose name isn't blank."""
    return F.filter(items, lambda x: F.coalesce(keys.strip(x[field]) != "", F.lit(False)))


def records(df: DataFrame, source: str, **columns: Column) -> DataFrame:
    """``df`` as records; what a source doesn't have is null or an empty array. Rows without a key drop out."""
    cols = {"source": F.lit(source)} | columns
    default = lambda k, t: F.array().cast(t) if t.startswith("array") else F.lit(None).cast(t)
    out = df.select(*[F.coalesce(cols[k].cast(t), default(k, t)).alias(k) if k in cols else default(k, t).alias(k) for k, t in RECORD.items()])
    return out.withColumn("key", blank(F.col("key"))).where("key is not null")


def graph_tables(rec: DataFrame, as_of: str, rates: dict[str, float] = RATES) -> dict[str, DataFrame]:
    """Published tables of records. Money that isn't known, or whose currency has no rate, is null in all its columns. A
    source that gives no status has that of the end date on the day of ``as_of``: unknown without one."""
    rec = rec.withColumn("status", F.coalesce("status", dates.status_by_end(F.col("end_date"), as_of[:10])))
    prov = {"source": F.col("source"), "source_id": F.col("key"), "source_url": F.col("url"), "as_of": F.lit(as_of)}
    grant_id = keys.surrogate_key("grant", F.col("source"), F.col("key"))
    rate = F.try_element_at(F.create_map(*[F.lit(x) for kv in rates.items() for x in kv]), F.col("currency"))
    known = F.col("amount").isNotNull() & rate.isNotNull()
    money = {"amount_original": F.when(known, F.col("amount")), "currency": F.when(known, F.col("currency")), "amount_usd": F.when(known, F.round(F.col("amount") * rate, 2)), "fx_rate_to_usd": F.when(known, rate), "fx_as_of": F.when(known, F.lit(RATES_AS_OF))}
    base = rec.withColumn("grant_id", grant_id)
    fid = keys.surrogate_key("funder", F.col("x.parts")[0], F.get("x.parts", F.lit(1)), F.get("x.parts", F.lit(2)))
    oid = F.when(blank(F.col("x.ror")).isNotNull(), keys.surrogate_key("organization", F.col("x.ror"))).otherwise(keys.surrogate_key("organization", F.col("source"), F.col("x.name")))
    known_as = F.when(blank(F.col("x.pid")).isNotNull(), keys.surrogate_key("person", F.col("source"), F.col("x.pid")))
    pid = F.coalesce(keys.surrogate_key("person", F.col("x.orcid")), known_as, keys.surrogate_key("person", F.col("source"), F.col("x.full_name")))
    xf, xo, xp = (base.select("source", "key", "url", "grant_id", F.explode(c).alias("x")) for c in ("funders", "orgs", "people"))
    xp = xp.dropDuplicates(["grant_id", "x"]).withColumn("n", F.lower("x.full_name"))
    xp = xp.groupBy("source", "key", "url", "grant_id", "n").agg(F.min("x").alias("x"))  # a name once per award
    lead = base.select("source", "key", "url", "grant_id", F.get(F.filter("orgs", lambda o: o["role"] == "recipient"), F.lit(0)).alias("x"))
    at = xp.select("source", "key", "url", "grant_id", pid.alias("src_id")).join(lead.where("x is not null").select("grant_id", oid.alias("dst_id")), "grant_id")

    def table(to: str, df: DataFrame, /, **c: Column) -> DataFrame:
        out = keys.enforce_schema(df.select(*[v.alias(k) for k, v in (c | prov).items()]), to)
        return dedup_edges(out) if to in keys.EDGES else dedup_entities(out)

    field = base.select("source", "key", "url", F.explode("fields").alias("f"))
    return {
        "grant": table("grant", base, atlas_id=F.col("grant_id"), title=F.col("title"), abstract=F.col("abstract"), start_date=F.col("start_date"), end_date=F.col("end_date"), status=F.col("status"), program=F.col("program"), **money),
        "funder": table("funder", xf, atlas_id=fid, name=F.col("x.name"), short_name=F.col("x.short_name"), country_code=F.col("x.country_code"), funder_type=F.col("x.funder_type"), crossref_funder_id=F.col("x.crossref")),
        "organization": table("organization", xo, atlas_id=oid, name=F.col("x.name"), ror_id=F.col("x.ror"), country_code=F.col("x.country_code"), city=F.col("x.city"), region=F.col("x.region"), org_type=F.col("x.org_type"), homepage=F.col("x.homepage"), lat=F.col("x.lat"), lon=F.col("x.lon")),
        "person": table("person", xp, atlas_id=pid, full_name=F.col("x.full_name"), first_name=F.col("x.first_name"), last_name=F.col("x.last_name"), orcid=F.col("x.orcid")),
        "field": table("field", field, atlas_id=keys.surrogate_key("field", F.col("source"), F.col("f")), name=F.col("f"), level=F.lit("topic")),
        "funder_grant": table("funder_grant", xf.where("x.awards"), src_id=fid, dst_id=F.col("grant_id"), role=F.lit("awarder")),
        "grant_org": table("grant_org", xo, src_id=F.col("grant_id"), dst_id=oid, role=F.col("x.role")),
        "grant_person": table("grant_person", xp, src_id=F.col("grant_id"), dst_id=pid, role=F.col("x.role")),
        "person_org": table("person_org", at, src_id=F.col("src_id"), dst_id=F.col("dst_id"), role=F.lit("affiliation")),
    }


# Readers: what was landed, with a declared schema -----------------------------------------------------------------------

SCHEMAS = {
    "nsf": "response struct<award: array<struct<id: string, title: string, abstractText: string, awardeeName: string, awardeeCity: string, awardeeStateCode: string, awardeeCountryCode: string, pdPIName: string, piFirstName: string, piLastName: string, coPDPI: array<string>, startDate: string, expDate: string, estimatedTotalAmt: string, fundsObligatedAmt: string, fundProgramName: string, orgLongName2: string, orgLongName: string, divAbbr: string, dirAbbr: string>>>",
    "nih": "results array<struct<project_num: string, project_title: string, abstract_text: string, fiscal_year: int, award_amount: double, project_start_date: string, project_end_date: string, organization: struct<org_name: string, org_city: string, org_state: string, org_country: string>, principal_investigators: array<struct<profile_id: bigint, first_name: string, last_name: string, full_name: string, is_contact_pi: boolean>>, agency_ic_admin: struct<abbreviation: string, name: string>>>",
    "ukri": "totalPages int, project array<struct<id: string, identifiers: struct<identifier: array<struct<value: string, type: string>>>, title: string, abstractText: string, grantCategory: string, leadFunder: string, start: bigint, `end`: bigint, researchTopics: struct<researchTopic: array<struct<id: string, text: string>>>, participantValues: struct<participant: array<struct<organisationName: string, role: string, projectCost: double, grantOffer: double>>>, links: struct<link: array<struct<rel: string, href: string>>>>>",
    "ukri_person": "id string, firstName string, otherNames string, surname string, orcidId string",
    "ukri_organisation": "id string, name string, addresses struct<address: array<struct<region: string>>>",
    "czi": "grants string",
    "openalex": "results array<struct<id: string, doi: string, title: string, display_name: string, publication_year: bigint, publication_date: string, type: string, cited_by_count: bigint, open_access: struct<is_oa: boolean>, abstract_inverted_index: string, primary_topic: struct<id: string, display_name: string, score: double, subfield: struct<id: string, display_name: string>, field: struct<id: string, display_name: string>, domain: struct<id: string, display_name: string>>, authorships: array<struct<author: struct<id: string, display_name: string, orcid: string>, is_corresponding: boolean, institutions: array<struct<id: string, display_name: string, ror: string, country_code: string, type: string>>>>, referenced_works: array<string>, awards: array<struct<id: string, funder_award_id: string, funder_id: string, funder_display_name: string>>>>",
    "ror": "id string, status string, types array<string>, names array<struct<value: string, types: array<string>>>, locations array<struct<geonames_details: struct<country_code: string, name: string, lat: double, lng: double>>>, links array<struct<type: string, value: string>>, external_ids array<struct<type: string, preferred: string, all: array<string>>>",
}


def pages(spark: SparkSession, source: str, path: str) -> DataFrame:
    """Landed JSON pages, one document per file."""
    return spark.read.schema(SCHEMAS[source]).option("multiLine", True).json(path)


def zipped_csv(spark: SparkSession, path: str, member: str, columns: list[str], sep: str = ";") -> DataFrame:
    """The rows of the member whose base name is ``member`` in each zip file, as text columns; a task reads a file, in
    pieces. A column that the member doesn't have is null; files without the member give no rows."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in (n for n in z.namelist() if n.rpartition("/")[2] == member):
                        for part in pd.read_csv(z.open(name), sep=sep, dtype=str, keep_default_na=False, na_values=[""], chunksize=20_000):
                            yield part.reindex(columns=columns).astype(object).where(lambda x: x.notna(), None)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


def zipped_json(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The documents of the JSON lists in each zip file, with the schema of ``kind``; a task reads a file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in (n for n in z.namelist() if n.endswith(".json")):
                        rows = json.load(z.open(name))
                        yield pd.DataFrame({"j": [json.dumps(r) for r in (rows if isinstance(rows, list) else [rows])]}, dtype=object)

    text_rows = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "j string")
    return text_rows.select(F.from_json("j", SCHEMAS[kind]).alias("r")).select("r.*")


def _each(df: DataFrame, array: str) -> DataFrame:
    return df.select(F.explode(array).alias("a")).select("a.*")


def nsf(df: DataFrame, others: bool = True) -> DataFrame:
    """Award pages; without ``others`` (the bulk feed's contract) co-investigators stay out."""
    a = _each(df, "response.award")
    co = F.transform(F.coalesce("coPDPI", F.array().cast("array<string>")), lambda n: person(full_name=blank(F.regexp_replace(n, r"\s+\S+@\S+$", "")), role=F.lit("co-pi")))
    lead = F.array(person(full_name=blank(F.coalesce(blank(F.col("pdPIName")), F.concat_ws(" ", "piFirstName", "piLastName"))), first_name=blank(F.col("piFirstName")), last_name=blank(F.col("piLastName")), role=F.lit("pi")))
    at = org(name=F.col("awardeeName"), role=F.lit("recipient"), country_code=F.col("awardeeCountryCode"), city=F.col("awardeeCity"), region=F.col("awardeeStateCode"), org_type=F.lit("education"))
    topic = F.coalesce(*[blank(F.col(c)) for c in ("orgLongName2", "orgLongName", "divAbbr", "dirAbbr")])
    return records(
        a, "nsf", key=F.col("id"), url=F.concat(F.lit("https://www.nsf.gov/awardsearch/showAward?AWD_ID="), "id"), title=blank(F.col("title")), abstract=blank(F.col("abstractText")), amount=F.coalesce(dates.decimal_point(F.col("estimatedTotalAmt")), dates.decimal_point(F.col("fundsObligatedAmt"))), currency=F.lit("USD"),
        start_date=dates.us_date(F.col("startDate")), end_date=dates.us_date(F.col("expDate")), program=blank(F.col("fundProgramName")), funders=F.array(funder(["100000001"], "National Science Foundation", "NSF", "US", crossref="100000001")), orgs=named(F.array(at)), people=named(F.concat(lead, co) if others else lead, "full_name"), fields=F.filter(F.array(topic), lambda x: x.isNotNull()),
    )


def nih(df: DataFrame) -> DataFrame:
    a = _each(df, "results")
    pis = F.transform(F.coalesce("principal_investigators", F.array().cast("array<struct<profile_id: bigint, first_name: string, last_name: string, full_name: string, is_contact_pi: boolean>>")), lambda p: person(full_name=blank(p["full_name"]), first_name=blank(p["first_name"]), last_name=blank(p["last_name"]), role=F.when(p["is_contact_pi"], "pi").otherwise("co-pi"), pid=F.concat(F.lit("profile:"), p["profile_id"].cast("string"))))
    us = F.when(F.upper("organization.org_country").isin("UNITED STATES", "USA", "US"), "US")
    ic = _struct(FUNDER, parts=F.array(F.lit("nih"), F.col("agency_ic_admin.abbreviation")), name=F.col("agency_ic_admin.name"), short_name=F.col("agency_ic_admin.abbreviation"), country_code=F.lit("US"), funder_type=F.lit("government"), awards=F.lit(True))
    at = org(name=F.col("organization.org_name"), role=F.lit("recipient"), country_code=us, city=F.col("organization.org_city"), region=F.col("organization.org_state"), org_type=F.lit("education"))
    return records(
        a, "nih", key=F.col("project_num"), url=F.concat(F.lit("https://reporter.nih.gov/project-details/"), "project_num"), title=blank(F.col("project_title")), abstract=blank(F.col("abstract_text")), amount=dates.positive(F.col("award_amount")), currency=F.lit("USD"), start_date=dates.first_ten(F.col("project_start_date")), end_date=dates.first_ten(F.col("project_end_date")),
        funders=F.array(funder(["100000002"], "National Institutes of Health", "NIH", "US", crossref="100000002", awards=False), ic), orgs=named(F.array(at)), people=named(pis, "full_name"), fields=F.filter(F.array(F.col("agency_ic_admin.name")), lambda x: x.isNotNull()),
    )


_ERC = r"^(ERC-|HORIZON-ERC)"


def cordis(projects: DataFrame, organizations: DataFrame, topics: DataFrame | None = None, erc_only: bool = False) -> DataFrame:
    """Three tables joined on the project. With ``erc_only`` the ERC slice, as a source of its own."""
    erc = F.upper(keys.strip(F.coalesce("fundingScheme", F.lit("")))).rlike(_ERC)
    p = projects.where(erc) if erc_only else projects
    geo = dates.lat_lon(F.col("geolocation"))
    kind = F.when(F.col("activityType") == "HES", "education").when(F.col("activityType") == "REC", "facility").when(F.col("activityType") == "PRC", "company").when(F.col("activityType") == "PUB", "government").otherwise("other")
    one = org(name=blank(F.col("name")), role=F.when(F.lower("role") == "coordinator", "recipient").otherwise("host"), country_code=text.canon_country(F.col("country")), city=blank(F.col("city")), region=F.lit(None) if erc_only else blank(F.col("nutsCode")), org_type=kind, homepage=blank(F.col("organizationURL")), lat=geo["lat"], lon=geo["lon"])
    o = organizations.select(F.col("projectID").alias("id"), one.alias("o")).groupBy("id").agg(F.array_sort(F.collect_set("o")).alias("orgs"))
    x = p.join(o, "id", "left")
    if topics is not None:
        x = x.join(topics.groupBy(F.col("projectID").alias("id")).agg(F.array_sort(F.collect_set(F.coalesce(blank(F.col("euroSciVocTitle")), blank(F.col("euroSciVocCode"))))).alias("topics")), "id", "left")
    else:
        x = x.withColumn("topics", F.array().cast("array<string>"))
    ec = funder(["501100000780"], "European Commission", "EC", "EU", crossref="501100000780")
    council = funder(["501100000781"], "European Research Council", "ERC", "EU", crossref="501100000781")
    who = F.array(council) if erc_only else F.when(erc, F.array(ec, council)).otherwise(F.array(ec))
    return records(
        x, "erc" if erc_only else "cordis", key=F.col("id"), url=F.concat(F.lit("https://cordis.europa.eu/project/id/"), "id"), title=blank(F.col("title")), abstract=blank(F.col("objective")), amount=F.coalesce(dates.decimal_comma(F.col("ecMaxContribution")), dates.decimal_comma(F.col("totalCost"))), currency=F.lit("EUR"),
        start_date=dates.first_ten(F.col("startDate")), end_date=dates.first_ten(F.col("endDate")), status=dates.status_word(F.col("status")), program=blank(F.col("fundingScheme")), funders=who, orgs=named(F.col("orgs")), fields=F.col("topics"),
    )


def cordis_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", ";").option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)


def _linked(a: DataFrame, pages: DataFrame, roles: dict[str, str], make: Callable[[Column], Column], name: str) -> DataFrame:
    """``(id, <name>)``: what the links of each project lead to, in the order of the links. A link's relation gives the
    role, the last part of its address the page's id; links to pages that weren't landed lead nowhere."""
    link = a.select("id", F.posexplode(F.col("links.link")).alias("at", "l")).withColumn("role", F.try_element_at(F.create_map(*[F.lit(x) for kv in roles.items() for x in kv]), F.upper("l.rel")))
    asked = link.where("role is not null").select("id", "at", "role", text.last_segment(F.col("l.href")).alias("page"))
    got = asked.join(pages.where("id is not null").dropDuplicates(["id"]).select(F.col("id").alias("page"), F.struct("*").alias("p")), "page")
    listed = F.array_sort(F.collect_list(F.struct("at", make(F.col("role")).alias("x"))))
    return got.groupBy("id").agg(F.transform(listed, lambda x: x["x"]).alias(name))


def ukri(df: DataFrame, persons: DataFrame | None = None, organisations: DataFrame | None = None) -> DataFrame:
    """Project pages, with the landed person and organisation pages that their links name.

    A council has its own key from its name, since two share a registry number. Organisations come from the participants;
    from the links (lead and participants) where a project has none.
    """
    a = _each(df, "project")
    members = F.coalesce("participantValues.participant", F.array().cast("array<struct<organisationName: string, role: string, projectCost: double, grantOffer: double>>"))
    offers = F.filter(F.transform(members, lambda m: dates.positive(m["grantOffer"])), lambda v: v.isNotNull())
    costs = F.filter(F.transform(members, lambda m: dates.positive(m["projectCost"])), lambda v: v.isNotNull())
    add = lambda v: F.when(F.size(v) > 0, F.aggregate(v, F.lit(0.0), lambda x, y: x + y))
    orgs = named(F.transform(members, lambda m: org(name=blank(m["organisationName"]), role=F.when(F.upper(m["role"]).startswith("LEAD"), "recipient").otherwise("host"), country_code=F.lit("GB"), org_type=F.lit("education"))))
    council = _struct(FUNDER, parts=F.array(F.lit("ukri"), F.col("leadFunder")), name=F.col("leadFunder"), short_name=F.col("leadFunder"), country_code=F.lit("GB"), funder_type=F.lit("government"), awards=F.lit(True))
    topics = F.filter(F.transform(F.col("researchTopics.researchTopic"), lambda t: blank(t["text"])), lambda t: t.isNotNull() & (F.lower(t) != "unclassified"))
    people = F.array().cast(f"array<{PERSON}>")
    if persons is not None:
        full = blank(F.concat_ws(" ", *[blank(F.col(f"p.{n}")) for n in ("firstName", "otherNames", "surname")]))
        made = lambda role: person(full_name=full, first_name=blank(F.col("p.firstName")), last_name=blank(F.col("p.surname")), role=role, pid=F.col("page"), orcid=blank(F.col("p.orcidId")))
        a = a.join(_linked(a, persons, {"PI_PER": "pi", "COI_PER": "co-pi"}, made, "linked_people"), "id", "left")
        people = named(F.coalesce("linked_people", people), "full_name")
    if organisations is not None:
        made = lambda role: org(name=blank(F.col("p.name")), role=role, country_code=F.lit("GB"), region=F.get("p.addresses.address", F.lit(0))["region"], org_type=F.lit("education"))
        a = a.join(_linked(a, organisations, {"LEAD_ORG": "recipient", "PARTICIPANT_ORG": "host"}, made, "linked_orgs"), "id", "left")
        orgs = F.when(F.size(orgs) > 0, orgs).otherwise(named(F.coalesce("linked_orgs", F.array().cast(f"array<{ORG}>"))))
    reference = F.get(F.filter(F.transform(F.col("identifiers.identifier"), lambda i: blank(i["value"])), lambda v: v.isNotNull()), F.lit(0))
    return records(
        a, "ukri", key=F.col("id"), url=F.concat(F.lit("https://gtr.ukri.org/projects?ref="), F.coalesce(reference, "id")), title=blank(F.col("title")), abstract=blank(F.col("abstractText")), amount=F.coalesce(add(offers), add(costs)), currency=F.lit("GBP"),
        start_date=dates.millis_date(F.col("start")), end_date=dates.millis_date(F.col("end")), program=blank(F.col("grantCategory")),
        funders=F.array(funder(["100014013"], "UK Research and Innovation", "UKRI", "GB", crossref="100014013", awards=False), council), orgs=orgs, people=people, fields=topics,
    )


def _between(html: str, pattern: str) -> Column:
    return blank(text.html_text(F.regexp_extract(html, f"(?s){pattern}", 1)))


def dfg(df: DataFrame) -> DataFrame:
    """Project pages ``(key, html)``: a heading, then pairs of name and value."""
    value = lambda label: _between("html", rf'<span class="name">\s*{label}[^<]*</span>\s*<span class="value">(.*?)</span>\s*(?:</div>|<div|<span class="name"|$)')
    span = dates.term(value("Term"))
    names = lambda c, role: F.transform(F.coalesce(F.filter(F.split(c, r"\s*;\s*"), lambda n: n != ""), F.array().cast("array<string>")), lambda n: person(full_name=blank(F.regexp_replace(n, r"^(?:(?:Professor|Prof|Dr|PD|Privatdozent)(?:in)?\.?,?\s+)+", "")), role=F.lit(role)))
    return records(
        df, "dfg", key=F.col("key"), url=F.concat(F.lit("https://gepris.dfg.de/gepris/projekt/"), "key"), title=_between("html", r'<h1 class="facelift">(.*?)</h1>'), start_date=span["start"], end_date=span["end"], status=F.when(span["end"].isNotNull(), "completed").otherwise("active"), program=value("DFG Programme"),
        funders=F.array(funder(["501100001659"], "Deutsche Forschungsgemeinschaft", "DFG", "DE", crossref="501100001659")), orgs=named(F.array(org(name=value("Applicant Institution"), role=F.lit("recipient"), country_code=F.lit("DE"), org_type=F.lit("education")))),
        people=named(F.concat(names(F.coalesce(value("Spokesperson"), value("Applicant")), "pi"), names(value("Participating Researchers"), "co-pi")), "full_name"), fields=F.filter(F.array(value("Subject Area")), lambda x: x.isNotNull()),
    )


def gates(df: DataFrame) -> DataFrame:
    """Rows of the grants CSV, its banner line already dropped (``gates_csv``)."""
    span = dates.month_span(F.col("DATE COMMITTED"), F.col("DURATION (MONTHS)"))
    where = org(name=blank(F.col("GRANTEE")), role=F.lit("recipient"), country_code=_country("GRANTEE COUNTRY"), city=blank(F.col("GRANTEE CITY")), region=blank(F.col("GRANTEE STATE")), org_type=F.lit("nonprofit"), homepage=blank(F.col("GRANTEE WEBSITE")))
    return records(
        df, "gates", key=F.col("GRANT ID"), url=F.concat(F.lit("https://www.gatesfoundation.org/about/committed-grants?q="), "GRANT ID"), title=blank(F.col("PURPOSE")), amount=dates.decimal_point(F.col("AMOUNT COMMITTED")), currency=F.lit("USD"), start_date=span["start"], end_date=span["end"], program=F.nullif(F.concat_ws(" / ", blank(F.col("DIVISION")), blank(F.col("TOPIC"))), F.lit("")),
        funders=F.array(funder(["100000865"], "Gates Foundation", "Gates", "US", "foundation", "100000865")), orgs=named(F.array(where)), fields=F.filter(F.array(blank(F.col("TOPIC"))), lambda x: x.isNotNull()),
    )


# The columns of the grants file as published.
GATES_COLUMNS = ("GRANT ID", "GRANTEE", "PURPOSE", "DIVISION", "DATE COMMITTED", "DURATION (MONTHS)", "AMOUNT COMMITTED", "GRANTEE WEBSITE", "GRANTEE CITY", "GRANTEE STATE", "GRANTEE COUNTRY", "REGION SERVED", "TOPIC")


def gates_csv(spark: SparkSession, path: str) -> DataFrame:
    """The banner becomes the header of a read without one; the true header is the first row with GRANT ID."""
    raw = spark.read.option("multiLine", True).option("escape", '"').schema(", ".join(f"c{i} string" for i in range(13))).csv(path)
    first = raw.where("trim(c0) = 'GRANT ID'").first()  # one row; the columns as published where a file has no header
    head = [x.strip() for x in first if x] if first else list(GATES_COLUMNS)
    return raw.where("c0 is not null and trim(c0) <> 'GRANT ID' and c1 is not null").toDF(*head, *[f"x{i}" for i in range(13 - len(head))])


# Country codes by name, as the foundations write them.
_COUNTRY = {
    "argentina": "AR", "australia": "AU", "austria": "AT", "bangladesh": "BD", "belgium": "BE", "brazil": "BR", "burkina faso": "BF", "cameroon": "CM", "canada": "CA", "chile": "CL", "china": "CN", "colombia": "CO",
    "cote d'ivoire": "CI", "democratic republic of the congo": "CD", "denmark": "DK", "egypt": "EG", "england": "GB", "ethiopia": "ET", "finland": "FI", "france": "FR", "gambia": "GM", "germany": "DE", "ghana": "GH", "india": "IN",
    "indonesia": "ID", "ireland": "IE", "israel": "IL", "italy": "IT", "japan": "JP", "kenya": "KE", "korea, republic of": "KR", "malawi": "MW", "mali": "ML", "mexico": "MX", "mozambique": "MZ", "myanmar": "MM", "nepal": "NP",
    "netherlands": "NL", "new zealand": "NZ", "niger": "NE", "nigeria": "NG", "northern ireland": "GB", "norway": "NO", "pakistan": "PK", "peru": "PE", "philippines": "PH", "portugal": "PT", "rwanda": "RW", "scotland": "GB",
    "senegal": "SN", "singapore": "SG", "south africa": "ZA", "south korea": "KR", "spain": "ES", "sweden": "SE", "switzerland": "CH", "tanzania": "TZ", "thailand": "TH", "uganda": "UG", "uk": "GB", "united kingdom": "GB",
    "united states": "US", "united states of america": "US", "usa": "US", "vietnam": "VN", "wales": "GB", "zambia": "ZM", "zimbabwe": "ZW",
}
_STATES = "AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY".split()


def _country(column: str) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in _COUNTRY.items() for x in kv]), F.lower(keys.strip(F.col(column))))


def wellcome(df: DataFrame) -> DataFrame:
    """Award rows with the columns of the ``sample_rows`` table."""
    c = lambda n: blank(F.col(f"`{n}`"))
    cur = F.upper(c("Currency"))
    others = F.transform(F.coalesce(F.filter(F.split(c("Other Applicant(s)"), ";"), lambda n: keys.strip(n) != ""), F.array().cast("array<string>")), lambda n: person(full_name=_untitled(n), role=F.lit("co-pi")))
    ror = F.when(F.lower(c("Recipient Org:Identifier")).contains("ror.org/"), c("Recipient Org:Identifier"))
    where = org(name=c("Recipient Org:Name"), ror=ror, role=F.lit("recipient"), country_code=_country("Recipient Org:Country"), city=c("Recipient Org:City"), region=c("Region"), org_type=F.lit("education"))
    return records(
        df, "wellcome", key=F.coalesce(c("Identifier"), c("Internal ID")), url=F.concat(F.lit("https://grantnav.threesixtygiving.org/grant/"), F.coalesce(c("Identifier"), c("Internal ID"))), title=c("Title"), abstract=c("Description"), amount=F.when(cur.isin("GBP", "USD"), dates.decimal_point(F.col("`Amount Awarded`"))), currency=F.when(cur.isin("GBP", "USD"), cur),
        start_date=dates.first_ten(F.col("`Planned Dates:Start Date`")), end_date=dates.first_ten(F.col("`Planned Dates:End Date`")), program=c("Grant Programme:Title"), funders=F.array(funder(["100010269"], "Wellcome Trust", "Wellcome", "GB", "foundation", "100010269")), orgs=named(F.array(where)),
        people=named(F.concat(F.array(person(full_name=_untitled(F.col("Lead Applicant")), role=F.lit("pi"))), others), "full_name"), fields=F.filter(F.array(c("Grant Programme:Title")), lambda x: x.isNotNull()),
    )


def _untitled(n: Column) -> Column:
    return blank(F.regexp_replace(keys.strip(n), r"^(?:(?:Professor|Prof|Dr|Mr|Mrs|Ms|Miss|Sir|Dame)\.?\s+)+", ""))


def sloan(df: DataFrame) -> DataFrame:
    """Listing pages ``(html)``: a card per grant, split at its list item."""
    card = df.select(F.explode(F.slice(F.split("html", r"<li>\s*<header"), 2, 1_000_000)).alias("html"))
    of = lambda cls: _between("html", rf'class="{cls}[^"]*"[^>]*>(.*?)</(?:div|span|h\d|p|a)>')
    label = lambda name: _between("html", rf'<span class="label">\s*{name}:?\s*</span>(.*?)</(?:li|div|p)>')
    place = of("city")
    state = F.upper(F.regexp_extract(place, r",\s*([A-Za-z]{2})$", 1))
    pi = F.transform(F.coalesce(F.filter(F.split(label("Investigator"), r"\s*;\s*"), lambda n: n != ""), F.array().cast("array<string>")), lambda n: person(full_name=blank(n), role=F.lit("pi")))
    where = org(name=of("grantee"), role=F.lit("recipient"), city=blank(F.regexp_replace(place, r",\s*[A-Za-z]{2}$", "")), region=F.nullif(state, F.lit("")), country_code=F.when(state.isin(_STATES), "US"), org_type=F.lit("nonprofit"))
    return records(
        card, "sloan", key=F.regexp_extract("html", r'href="[^"]*grant-detail/([^"/]+)', 1), url=F.concat(F.lit("https://sloan.org/grant-detail/"), F.regexp_extract("html", r'href="[^"]*grant-detail/([^"/]+)', 1)), title=of("brief-description"), amount=dates.decimal_point(of("amount")), currency=F.lit("USD"), start_date=dates.year_start(of("year")), program=label("Program"),
        funders=F.array(funder(["100000879"], "Alfred P. Sloan Foundation", "Sloan", "US", "foundation", "100000879")), orgs=named(F.array(where)), people=named(pi, "full_name"), fields=F.filter(F.array(label("Program"), label("Sub-program")), lambda x: x.isNotNull()),
    )


_CZI_ROW = "struct<id: string, createdTime: string, fields: string>"


def czi(df: DataFrame) -> DataFrame:
    """One document whose ``grants`` is a list of records, or a list of such lists; initiatives are a list or a text."""
    g = F.coalesce(F.flatten(F.from_json("grants", f"array<array<{_CZI_ROW}>>", {"mode": "PERMISSIVE"})), F.from_json("grants", f"array<{_CZI_ROW}>"))
    a = df.select(F.explode(g).alias("a")).where("a.id is not null").select("a.id", "a.fields")
    f = lambda n: blank(F.get_json_object("fields", f"$['{n}']"))
    initiative = F.coalesce(F.from_json(f("Initiative"), "array<string>"), F.filter(F.array(f("Initiative")), lambda x: x.isNotNull()))
    return records(
        a, "czi", key=F.col("id"), url=F.lit("https://chanzuckerberg.com/grants-ventures/grants/"), title=f("Grant Purpose"), amount=dates.decimal_point(f("Amount")), currency=F.lit("USD"), start_date=dates.year_start(f("Commitment Year")), funders=F.array(funder(["100014989"], "Chan Zuckerberg Initiative", "CZI", "US", "foundation", "100014989")),
        orgs=named(F.array(org(name=f("Account Name"), role=F.lit("recipient"), org_type=F.lit("nonprofit"), homepage=f("Account Website (Plaintext)")))), fields=initiative,
    )


def openalex(df: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """Works with authors, institutions and the chain of topics: ``work, person, organization, person_org, field,
    work_field, award`` (awards as named, for ``link_awards``) and ``corpus`` (texts and references)."""
    w = _each(df, "results").where("id is not null").dropDuplicates(["id"]).withColumn("wid", keys.surrogate_key("work", text.last_segment(F.col("id"))))
    prov = {"source": F.lit("openalex"), "source_id": text.last_segment(F.col("id")), "source_url": F.col("id"), "as_of": F.lit(as_of)}
    put = lambda to, d, /, **c: (dedup_edges if to in keys.EDGES else dedup_entities)(keys.enforce_schema(d.select(*[v.alias(k) for k, v in (c | prov).items()]), to))
    a = w.select("id", "wid", F.explode("authorships").alias("x"))
    orcid = text.last_segment(F.col("x.author.orcid"))
    pid = F.coalesce(keys.surrogate_key("person", orcid), keys.surrogate_key("person", text.last_segment(F.col("x.author.id"))), keys.surrogate_key("person", F.col("x.author.display_name")))
    inst = a.select("id", pid.alias("pid"), F.explode("x.institutions").alias("i")).where("i.ror is not null")
    oid = keys.surrogate_key("organization", F.col("i.ror"))
    t = F.col("primary_topic")
    level = lambda n, node, *up: F.struct(F.lit(n).alias("level"), node["id"].alias("id"), node["display_name"].alias("name"), F.coalesce(*[u["id"] for u in up], F.lit(None).cast("string")).alias("parent"))
    chain = F.array(level("domain", t["domain"]), level("field", t["field"], t["domain"]), level("subfield", t["subfield"], t["field"], t["domain"]), level("topic", t, t["subfield"], t["field"], t["domain"]))
    node = w.select("id", F.explode(chain).alias("f")).where("f.id is not null")
    fid = lambda c: keys.surrogate_key("field", text.last_segment(c))
    leaf = F.coalesce(t["id"], t["subfield"]["id"], t["field"]["id"], t["domain"]["id"])
    return {
        "work": put("work", w, atlas_id=F.col("wid"), title=F.coalesce("title", "display_name"), doi=F.col("doi"), openalex_id=text.last_segment(F.col("id")), publication_year=F.col("publication_year"), publication_date=F.col("publication_date"), type=F.col("type"), cited_by_count=F.col("cited_by_count"), is_oa=F.col("open_access.is_oa")),
        "person": put("person", a.where(pid.isNotNull()), atlas_id=pid, full_name=F.col("x.author.display_name"), orcid=orcid, openalex_author_id=text.last_segment(F.col("x.author.id"))),
        "organization": put("organization", inst, atlas_id=oid, name=F.col("i.display_name"), ror_id=F.col("i.ror"), country_code=F.col("i.country_code"), org_type=F.col("i.type")),
        "person_org": put("person_org", inst.where("pid is not null"), src_id=F.col("pid"), dst_id=oid, role=F.lit("affiliation")),
        "field": put("field", node, atlas_id=fid(F.col("f.id")), name=F.col("f.name"), openalex_id=text.last_segment(F.col("f.id")), level=F.col("f.level"), parent_atlas_id=fid(F.col("f.parent"))),
        "work_field": put("work_field", w.where(leaf.isNotNull()), src_id=F.col("wid"), dst_id=fid(leaf), score=t["score"]),
        "award": w.select(F.col("wid").alias("work_id"), F.explode("awards").alias("x")).select("work_id", F.col("x.funder_display_name").alias("funder"), F.col("x.funder_award_id").alias("award")).where("award is not null"),
        "corpus": w.select(text.last_segment(F.col("id")).alias("work_id"), "title", text.inverted_abstract(F.col("abstract_inverted_index")).alias("abstract"), F.col("publication_year").alias("year"), "cited_by_count", F.col("primary_topic.display_name").alias("topic"), F.filter(F.transform("referenced_works", text.last_segment), lambda x: x.isNotNull()).alias("refs")).withColumn("text", text.title_and_abstract(F.col("title"), F.col("abstract"))),
    }


def ror_names(df: DataFrame) -> DataFrame:
    """``(ror, name, kind, country, city, lat, lon, homepage)`` of active register entries, a row per name, for ``register_index``."""
    a = df.where("status is null or status = 'active'").select("id", F.explode("names").alias("n"), F.get("locations", F.lit(0))["geonames_details"].alias("g"), F.get(F.filter("links", lambda l: l["type"] == "website"), F.lit(0))["value"].alias("homepage"))
    t = F.col("n.types")
    kind = F.when(F.array_contains(t, "ror_display"), "display").when(F.array_contains(t, "label"), "label").when(F.array_contains(t, "acronym"), "acronym").otherwise("alias")
    return a.select(F.col("id").alias("ror"), F.col("n.value").alias("name"), kind.alias("kind"), F.col("g.country_code").alias("country"), F.col("g.name").alias("city"), "g.lat", F.col("g.lng").alias("lon"), "homepage")


def fundref(df: DataFrame) -> DataFrame:
    """``(fundref, ror)``: funder numbers to register ids, the smaller id where two claim one."""
    x = df.where("status is null or status = 'active'").select("id", F.explode("external_ids").alias("e")).where("lower(e.type) = 'fundref'")
    return x.select(F.explode(F.array_distinct(F.concat(F.filter(F.array("e.preferred"), lambda v: v.isNotNull()), F.coalesce("e.all", F.array().cast("array<string>"))))).alias("fundref"), "id").groupBy("fundref").agg(F.min("id").alias("ror"))


CONNECTORS: dict[str, Callable[..., DataFrame]] = {"nsf": nsf, "nsf_bulk": lambda df: nsf(df, others=False), "nih": nih, "cordis": cordis, "erc": lambda p, o, t=None: cordis(p, o, t, erc_only=True), "ukri": ukri, "dfg": dfg, "gates": gates, "wellcome": wellcome, "sloan": sloan, "czi": czi}
