"""Every connector over pages made up from the order tables: an order is an award, its customer the recipient.

Pages have the shape in which each source lands them, so that reading, parsing and mapping run as on real ones; each query
gives the grants that come out. ``wellcome_grants`` and its companions run over the delivered award rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundloom.plans.graph import with_views
from fundloom.sources import connectors as c
from fundloom.sources.tables import table

AS_OF = "1998-01-01T00:00:00Z"
GRANT = ("atlas_id", "title", "amount_original", "currency", "amount_usd", "start_date", "end_date", "status", "program", "source_id", "source_url")


def _orders(s: SparkSession, d: str) -> DataFrame:
    """``(k, day, cents, org)`` with k the order's number as text."""
    o = table(s, d, "orders", "o_orderkey", "o_orderdate", "o_totalprice", "o_custkey")
    return o.select(F.col("o_orderkey").cast("string").alias("k"), F.col("o_orderkey").alias("n"), F.col("o_orderdate").cast("date").alias("day"), F.round(F.col("o_totalprice"), 2).alias("usd"), F.concat(F.lit("Org "), F.col("o_custkey").cast("string")).alias("org"))


def _grants(rec: DataFrame) -> DataFrame:
    return c.graph_tables(rec, AS_OF)["grant"].select(*GRANT)


def _page(df: DataFrame, source: str, **columns: Column) -> DataFrame:
    """One page per row, through JSON and the source's declared schema."""
    return df.select(F.from_json(F.to_json(F.struct(*[v.alias(k) for k, v in columns.items()])), c.SCHEMAS[source]).alias("p")).select("p.*")


def _nsf_page(s: SparkSession, d: str) -> DataFrame:
    award = F.struct(F.col("k").alias("id"), F.concat(F.lit("Order "), "k").alias("title"), F.col("org").alias("awardeeName"), F.lit("US").alias("awardeeCountryCode"), F.lit("Ann Bee").alias("pdPIName"), F.array(F.lit("Cid Dee cd@x.example")).alias("coPDPI"), F.date_format("day", "MM/dd/yyyy").alias("startDate"), F.date_format(F.date_add("day", 365), "MM/dd/yyyy").alias("expDate"), F.when(F.col("n") % 3 > 0, F.col("usd").cast("string")).otherwise("0").alias("estimatedTotalAmt"), F.lit("1,000.50").alias("fundsObligatedAmt"), F.lit("OPP").alias("divAbbr"))
    return _page(_orders(s, d), "nsf", response=F.struct(F.array(award).alias("award")))


def landed_nsf(s: SparkSession, d: str) -> DataFrame:
    return _grants(c.CONNECTORS["nsf"](_nsf_page(s, d)))


def landed_nsf_people(s: SparkSession, d: str) -> DataFrame:
    """Roles by feed: the bulk feed has principal investigators only."""
    out = None
    for name in ("nsf", "nsf_bulk"):
        e = c.graph_tables(c.CONNECTORS[name](_nsf_page(s, d)), AS_OF)["grant_person"].groupBy("role").agg(F.count("*").alias("edges")).select(F.lit(name).alias("feed"), "*")
        out = e if out is None else out.unionByName(e)
    return out


def landed_nih(s: SparkSession, d: str) -> DataFrame:
    result = F.struct(F.concat(F.lit("5R01CA"), "k").alias("project_num"), F.concat(F.lit("Order "), "k").alias("project_title"), F.when(F.col("n") % 3 > 0, F.col("usd")).otherwise(F.lit(0.0)).alias("award_amount"), F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T00:00:00")).alias("project_start_date"), F.struct(F.col("org").alias("org_name"), F.lit("UNITED STATES").alias("org_country")).alias("organization"), F.struct(F.lit("NCI").alias("abbreviation"), F.lit("Cancer").alias("name")).alias("agency_ic_admin"))
    return _grants(c.nih(_page(_orders(s, d), "nih", results=F.array(result))))


def landed_ukri(s: SparkSession, d: str) -> DataFrame:
    """People and organisations come through links to pages of their own."""
    o = _orders(s, d)
    link = lambda rel, kind, key: F.struct(F.lit(rel).alias("rel"), F.concat(F.lit(f"https://gtr.example/{kind}/"), key).alias("href"))
    project = F.struct(F.col("k").alias("id"), F.struct(F.array(F.struct(F.lit(" ").alias("value")), F.struct(F.concat(F.lit("EP/"), "k").alias("value"))).alias("identifier")).alias("identifiers"), F.concat(F.lit("Order "), "k").alias("title"), F.lit("EPSRC").alias("leadFunder"), (F.unix_date("day") * F.lit(86_400_000).cast("long")).alias("start"), F.lit(0).alias("end"), F.struct(F.array(F.struct(F.lit("").alias("organisationName"), F.lit("LEAD").alias("role"), F.col("usd").alias("grantOffer")), F.struct(F.lit(" ").alias("organisationName"), F.lit("X").alias("role"), F.lit(1.5).alias("grantOffer"))).alias("participant")).alias("participantValues"), F.struct(F.array(link("PI_PER", "persons", F.col("k")), link("COI_PER", "persons", F.lit("gone")), link("LEAD_ORG", "organisations", F.col("k"))).alias("link")).alias("links"))
    people = o.select(F.col("k").alias("id"), F.lit("Ann").alias("firstName"), F.lit(None).cast("string").alias("otherNames"), F.col("org").alias("surname"), F.lit(None).cast("string").alias("orcidId"))
    orgs = o.select(F.col("k").alias("id"), F.col("org").alias("name"), F.struct(F.array(F.struct(F.lit("Wales").alias("region"))).alias("address")).alias("addresses"))
    t = c.graph_tables(c.ukri(_page(o, "ukri", project=F.array(project)), people, orgs), AS_OF)
    ends = t["grant_person"].groupBy(F.col("src_id").alias("atlas_id")).agg(F.count("*").alias("people")).join(t["grant_org"].groupBy(F.col("src_id").alias("atlas_id")).agg(F.count("*").alias("orgs")), "atlas_id")
    return t["grant"].select(*GRANT).join(ends, "atlas_id", "left")


def _cordis(s: SparkSession, d: str, erc: bool) -> DataFrame:
    o = _orders(s, d)
    p = o.select(F.col("k").alias("id"), F.concat(F.lit("Order "), "k").alias("title"), F.lit("what for").alias("objective"), F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T00:00")).alias("startDate"), F.lit("").alias("endDate"), F.lit("7").alias("totalCost"), F.when(F.col("n") % 3 > 0, F.replace(F.col("usd").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))).otherwise("0").alias("ecMaxContribution"), F.when(F.col("n") % 2 == 0, "SIGNED").otherwise("CLOSED").alias("status"), F.when(F.col("n") % 5 == 0, " erc-STG").otherwise("RIA").alias("fundingScheme"))
    g = o.select(F.col("k").alias("projectID"), F.col("org").alias("name"), F.lit("EL").alias("country"), F.lit("Ath").alias("city"), F.lit("X").alias("nutsCode"), F.lit("1.5,2.5").alias("geolocation"), F.lit("").alias("organizationURL"), F.lit("HES").alias("activityType"), F.lit("coordinator").alias("role"))
    return _grants(c.CONNECTORS["erc" if erc else "cordis"](p, g))


def landed_cordis(s: SparkSession, d: str) -> DataFrame:
    return _cordis(s, d, False)


def landed_erc(s: SparkSession, d: str) -> DataFrame:
    return _cordis(s, d, True)


def landed_orgs(s: SparkSession, d: str) -> DataFrame:
    """Institutions as two sources give them: country notations, kinds of institution, places on the map."""
    o = _orders(s, d).select("k", "org")
    g = o.select(F.col("k").alias("projectID"), F.col("org").alias("name"), F.element_at(F.array(F.lit("EL"), F.lit("UK"), F.lit(" fr ")), F.col("k").cast("int") % 3 + 1).alias("country"), F.lit(" ").alias("city"), F.lit("X").alias("nutsCode"), F.element_at(F.array(F.lit("(1.5, 2.5)"), F.lit("1.5"), F.lit("a,b")), F.col("k").cast("int") % 3 + 1).alias("geolocation"), F.lit("").alias("organizationURL"), F.element_at(F.array(F.lit("HES"), F.lit("REC"), F.lit("PRC"), F.lit("PUB"), F.lit("OTH")), F.col("k").cast("int") % 5 + 1).alias("activityType"), F.lit("participant").alias("role"))
    text = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    p = o.select(F.col("k").alias("id"), *text("title", "objective", "startDate", "endDate", "totalCost", "ecMaxContribution", "status", "fundingScheme"))
    of = lambda rec: c.graph_tables(rec, AS_OF)["organization"]
    name = F.concat(F.lit("Org "), "projectID")
    lands = F.element_at(F.array(F.lit("Burkina Faso"), F.lit(" UNITED STATES "), F.lit("Atlantis")), F.col("k").cast("int") % 3 + 1)
    gates = o.select(F.col("k").alias("GRANT ID"), F.concat(F.lit("Org "), "k").alias("GRANTEE"), lands.alias("GRANTEE COUNTRY"), *text("PURPOSE", "DIVISION", "DATE COMMITTED", "DURATION (MONTHS)", "AMOUNT COMMITTED", "GRANTEE WEBSITE", "GRANTEE CITY", "GRANTEE STATE", "REGION SERVED", "TOPIC"))
    both = of(c.cordis(p, g.withColumn("name", name))).unionByName(of(c.gates(gates)))
    return both.select("source", "atlas_id", "name", "country_code", "city", "org_type", "lat", "lon")


def landed_register(s: SparkSession, d: str) -> DataFrame:
    """Register entries through the register's own documents: a row per name with its kind; withdrawn entries stay out."""
    r = table(s, d, "registry_org", "reg_id", "legal_name", "other_names", "town", "lat", "lon")
    kinds = lambda *k: F.array(*[F.lit(x) for x in k])
    other = F.transform(F.coalesce(F.split("other_names", ";"), F.array().cast("array<string>")), lambda n: F.struct(F.btrim(n).alias("value"), F.when(n.rlike("^ *[A-Z]{2,8} *$"), kinds("acronym")).otherwise(kinds("alias")).alias("types")))
    place = F.array(F.struct(F.struct(F.lit("CH").alias("country_code"), F.col("town").alias("name"), "lat", F.col("lon").alias("lng")).alias("geonames_details")))
    docs = _page(r, "ror", id=F.col("reg_id").cast("string"), status=F.when(F.col("reg_id") % 7 == 0, "withdrawn").when(F.col("reg_id") % 7 == 1, None).otherwise("active"), names=F.concat(F.array(F.struct(F.col("legal_name").alias("value"), kinds("ror_display", "label").alias("types"))), other), locations=place)
    return c.ror_names(docs).where("name is not null").select("ror", "name", "kind", "country", "city", "lat", "lon").distinct()


def landed_dfg(s: SparkSession, d: str) -> DataFrame:
    pair = lambda n, v: F.concat(F.lit(f'<div><span class="name">{n}</span><span class="value">'), v, F.lit("</span></div>"))
    html = F.concat(F.lit('<h1 class="facelift">Order &amp; '), "k", F.lit("</h1>"), pair("Term", F.concat(F.lit("from "), F.year("day").cast("string"), F.when(F.col("n") % 2 == 0, F.concat(F.lit(" to "), (F.year("day") + 3).cast("string"))).otherwise(""))), pair("DFG Programme", F.lit("Grants")), pair("Applicant Institution", F.col("org")))
    return _grants(c.dfg(_orders(s, d).select(F.col("k").alias("key"), html.alias("html"))))


def landed_gates(s: SparkSession, d: str) -> DataFrame:
    text = lambda v: F.lit(v).cast("string")
    columns = {"GRANT ID": F.col("k"), "GRANTEE": F.col("org"), "PURPOSE": F.concat(F.lit("Order "), "k"), "DIVISION": text("Health"), "DATE COMMITTED": F.date_format("day", "yyyy-MM"), "DURATION (MONTHS)": F.when(F.col("n") % 2 == 0, "18").otherwise("x"), "AMOUNT COMMITTED": F.concat(F.lit("$"), F.format_number("usd", 2)), "GRANTEE WEBSITE": text(None), "GRANTEE CITY": text("Bern"), "GRANTEE STATE": text(None), "GRANTEE COUNTRY": text("Burkina Faso"), "REGION SERVED": text(None), "TOPIC": text("Malaria")}
    return _grants(c.gates(_orders(s, d).select(*[v.alias(k) for k, v in columns.items()])))


def landed_sloan(s: SparkSession, d: str) -> DataFrame:
    card = F.concat(F.lit('<ul><li><header><div class="grantee">'), "org", F.lit('</div><div class="amount">$'), F.format_number("usd", 2), F.lit('</div><div class="city">Boston, MA</div><div class="year">'), F.year("day").cast("string"), F.lit('</div><div class="brief-description">Order '), "k", F.lit('</div></header><a href="/grant-detail/g-'), "k", F.lit('">x</a></li></ul>'))
    return _grants(c.sloan(_orders(s, d).select(card.alias("html"))))


def landed_czi(s: SparkSession, d: str) -> DataFrame:
    """Both nestings of the list, by the order's number."""
    fields = F.struct(F.concat(F.lit("Order "), "k").alias("Grant Purpose"), F.format_number("usd", 2).alias("Amount"), F.col("org").alias("Account Name"), F.year("day").cast("string").alias("Commitment Year"), F.lit("Science").alias("Initiative"))
    one = F.to_json(F.array(F.struct(F.col("k").alias("id"), fields.alias("fields"))))
    return _grants(c.czi(_orders(s, d).select(F.when(F.col("n") % 2 == 0, F.concat(F.lit("["), one, F.lit("]"))).otherwise(one).alias("grants"))))


def landed_openalex(s: SparkSession, d: str) -> DataFrame:
    """Works with their authors' and institutions' edges counted."""
    o = _orders(s, d)
    author = F.struct(F.struct(F.concat(F.lit("https://openalex.org/A"), "k").alias("id"), F.lit("Ann Bee").alias("display_name")).alias("author"), F.array(F.struct(F.col("org").alias("display_name"), F.concat(F.lit("https://ror.org/"), F.lpad("k", 9, "0")).alias("ror"))).alias("institutions"))
    topic = F.struct(F.lit("https://openalex.org/T1").alias("id"), F.lit("t").alias("display_name"), F.lit(0.5).alias("score"))
    work = F.struct(F.concat(F.lit("https://openalex.org/W"), "k").alias("id"), F.concat(F.lit("Order "), "k").alias("title"), F.year("day").alias("publication_year"), F.col("n").alias("cited_by_count"), topic.alias("primary_topic"), F.array(author).alias("authorships"))
    t = c.openalex(_page(o, "openalex", results=F.array(work)), AS_OF)
    n = {k: t[k].agg(F.lit(k).alias("table_name"), F.count("*").alias("rows")) for k in ("work", "person", "organization", "person_org", "field", "work_field", "corpus")}
    out = None
    for x in n.values():
        out = x if out is None else out.unionByName(x)
    return out


def _wellcome(s: SparkSession, d: str) -> dict[str, DataFrame]:
    return c.graph_tables(c.wellcome(table(s, d, "sample_rows").distinct()), AS_OF)


def wellcome_grants(s: SparkSession, d: str) -> DataFrame:
    """Money and keys of the delivered award rows."""
    return _wellcome(s, d)["grant"].select("atlas_id", "source_id", "amount_original", "currency", "amount_usd")


def wellcome_links(s: SparkSession, d: str) -> DataFrame:
    """Rows of each table that the delivered award rows give, and what lacks its source or day."""
    out = None
    for k, x in _wellcome(s, d).items():
        a = x.agg(F.lit(k).alias("table_name"), F.coalesce(F.sum((F.col("source").isNull() | F.col("source_url").isNull() | F.col("as_of").isNull()).cast("long")), F.lit(0)).alias("without_provenance"))
        out = a if out is None else out.unionByName(a)
    return out


_ALL = (landed_nsf, landed_nsf_people, landed_nih, landed_ukri, landed_cordis, landed_erc, landed_orgs, landed_register, landed_dfg, landed_gates, landed_sloan, landed_czi, landed_openalex, wellcome_grants, wellcome_links)
QUERIES = {f.__name__: f for f in _ALL}

_O = "(SELECT o_orderkey::VARCHAR AS k, o_orderkey AS n, o_orderdate::DATE AS day, round(o_totalprice, 2) AS usd, 'Org ' || o_custkey AS org FROM orders)"
_DAY = "strftime(day, '%Y-%m-%d')"


def _sql(source: str, key: str = "k", title: str = "'Order ' || k", amount: str = "usd", currency: str = "USD", rate: float = 1.0, start: str = _DAY, end: str = "NULL::VARCHAR", status: str = "'unknown'", program: str = "NULL::VARCHAR", url: str = "''", more: str = "", where: str = "true") -> str:
    return f"""SELECT 'grant:' || substr(sha1('grant|{source}|' || lower({key})), 1, 16) AS atlas_id, {title} AS title, a AS amount_original, CASE WHEN a IS NOT NULL THEN '{currency}' END AS currency, round(a * {rate}, 2) AS amount_usd, {start} AS start_date, {end} AS end_date, {status} AS status, {program} AS program, {key} AS source_id, {url} AS source_url{more}
      FROM (SELECT *, ({amount})::DOUBLE AS a FROM {_O}) WHERE {where}"""


_THIRD = "CASE WHEN n % 3 > 0 THEN usd ELSE {} END"
_BY_END = "CASE WHEN {0} >= '1998-01-01' THEN 'active' ELSE 'completed' END"
_NEXT = "strftime(day + 365, '%Y-%m-%d')"
_SPAN = "strftime(date_trunc('month', day) + INTERVAL 18 MONTH, '%Y-%m-%d')"
_KEY = "coalesce(nullif(trim(\"Identifier\"), ''), nullif(trim(\"Internal ID\"), ''))"
_SQL = {
    "landed_nsf": _sql("nsf", amount=_THIRD.format("1000.5"), end=_NEXT, status=_BY_END.format(_NEXT), url="'https://www.nsf.gov/awardsearch/showAward?AWD_ID=' || k"),
    "landed_nsf_people": "SELECT 'nsf' AS feed, unnest(['pi', 'co-pi']) AS role, count(*) AS edges FROM orders UNION ALL SELECT 'nsf_bulk', 'pi', count(*) FROM orders",
    "landed_nih": _sql("nih", key="'5R01CA' || k", amount=_THIRD.format("NULL"), url="'https://reporter.nih.gov/project-details/5R01CA' || k"),
    "landed_ukri": _sql("ukri", amount="usd + 1.5", currency="GBP", rate=1.27, url="'https://gtr.ukri.org/projects?ref=EP/' || k", more=", 1::BIGINT AS people, 1::BIGINT AS orgs"),
    "landed_cordis": _sql("cordis", amount=_THIRD.format("7"), currency="EUR", rate=1.08, status="CASE WHEN n % 2 = 0 THEN 'active' ELSE 'completed' END", program="CASE WHEN n % 5 = 0 THEN 'erc-STG' ELSE 'RIA' END", url="'https://cordis.europa.eu/project/id/' || k"),
    "landed_erc": _sql("erc", amount=_THIRD.format("7"), currency="EUR", rate=1.08, status="CASE WHEN n % 2 = 0 THEN 'active' ELSE 'completed' END", program="'erc-STG'", url="'https://cordis.europa.eu/project/id/' || k", where="n % 5 = 0"),
    "landed_orgs": """SELECT 'cordis' AS source, 'org:' || substr(sha1('organization|cordis|org ' || k), 1, 16) AS atlas_id, 'Org ' || k AS name, ['GR', 'GB', 'FR'][n % 3 + 1] AS country_code, NULL::VARCHAR AS city, ['education', 'facility', 'company', 'government', 'other'][n % 5 + 1] AS org_type, CASE WHEN n % 3 = 0 THEN 1.5::DOUBLE END AS lat, CASE WHEN n % 3 = 0 THEN 2.5::DOUBLE END AS lon FROM (SELECT o_orderkey::VARCHAR AS k, o_orderkey AS n FROM orders)
      UNION ALL SELECT 'gates', 'org:' || substr(sha1('organization|gates|org ' || k), 1, 16), 'Org ' || k, ['BF', 'US', NULL][n % 3 + 1], NULL, 'nonprofit', NULL, NULL FROM (SELECT o_orderkey::VARCHAR AS k, o_orderkey AS n FROM orders)""",
    "landed_register": """SELECT DISTINCT reg_id::VARCHAR AS ror, name, kind, 'CH' AS country, town AS city, lat, lon FROM (SELECT reg_id, legal_name AS name, 'display' AS kind, town, lat, lon FROM registry_org UNION ALL
      SELECT reg_id, trim(n), CASE WHEN regexp_matches(trim(n), '^[A-Z]{2,8}$') THEN 'acronym' ELSE 'alias' END, town, lat, lon FROM (SELECT *, unnest(string_split(other_names, ';')) AS n FROM registry_org)) WHERE reg_id % 7 > 0 AND name IS NOT NULL""",
    "landed_dfg": _sql("dfg", title="'Order & ' || k", amount="NULL", currency="", start="year(day) || '-01-01'", end="CASE WHEN n % 2 = 0 THEN (year(day) + 3) || '-12-31' END", status="CASE WHEN n % 2 = 0 THEN 'completed' ELSE 'active' END", program="'Grants'", url="'https://gepris.dfg.de/gepris/projekt/' || k"),
    "landed_gates": _sql("gates", start="strftime(day, '%Y-%m-01')", end=f"CASE WHEN n % 2 = 0 THEN {_SPAN} END", status=f"CASE WHEN n % 2 = 1 THEN 'unknown' ELSE {_BY_END.format(_SPAN)} END", program="'Health / Malaria'", url="'https://www.gatesfoundation.org/about/committed-grants?q=' || k"),
    "landed_sloan": _sql("sloan", key="'g-' || k", start="year(day) || '-01-01'", url="'https://sloan.org/grant-detail/g-' || k"),
    "landed_czi": _sql("czi", start="year(day) || '-01-01'", url="'https://chanzuckerberg.com/grants-ventures/grants/'"),
    "landed_openalex": "SELECT unnest(['work', 'person', 'organization', 'person_org', 'work_field', 'corpus']) AS table_name, count(*) AS rows FROM orders UNION ALL SELECT 'field', 1",
    "wellcome_grants": f"""SELECT DISTINCT 'grant:' || substr(sha1('grant|wellcome|' || lower(k)), 1, 16) AS atlas_id, k AS source_id, a AS amount_original, CASE WHEN a IS NOT NULL THEN cur END AS currency, round(a * CASE cur WHEN 'GBP' THEN 1.27 WHEN 'USD' THEN 1.0 END, 2) AS amount_usd
      FROM (SELECT {_KEY} AS k, upper(trim("Currency")) AS cur, CASE WHEN upper(trim("Currency")) IN ('GBP', 'USD') AND "Amount Awarded" > 0 THEN "Amount Awarded" END AS a FROM sample_rows) WHERE k IS NOT NULL""",
    "wellcome_links": "SELECT unnest(['grant', 'funder', 'organization', 'person', 'field', 'funder_grant', 'grant_org', 'grant_person', 'person_org']) AS table_name, 0::BIGINT AS without_provenance",
}
ORACLES = {k: with_views(v) for k, v in _SQL.items()}
