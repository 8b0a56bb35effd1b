"""Keys, names, amounts and dates; consolidation; data-quality checks. On the delivered graph tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundloom.functions import contacts, dates, keys, text
from fundloom.operators import consolidate
from fundloom.plans.graph import Graph, with_views
from fundloom.sources.tables import table

ENTITY_TABLES = {"grant": "grant_record", "organization": "organization", "person": "person", "work": "work_record", "field": "field"}
EDGE_TABLES = ("funder_grant", "grant_org", "grant_work")
_ROR = r"^https://ror\.example/0[a-z0-9]{6}[0-9]{2}$"
_ORCID = r"^\d{4}-\d{4}-\d{4}-\d{3}[\dX]$"


def surrogate_keys(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "organization", "atlas_id", "source", "name").distinct().withColumn("key", keys.surrogate_key("organization", F.col("source"), F.col("name")))


def enforce_schema_grant(s: SparkSession, d: str) -> DataFrame:
    return keys.enforce_schema(table(s, d, "grant_record"), "grant").select("atlas_id", "amount_usd", "currency", "as_of").distinct()


def partition_years(s: SparkSession, d: str) -> DataFrame:
    y = keys.partition_year(F.col("start_date"), F.col("end_date"), F.col("as_of"))
    return table(s, d, "grant_record").groupBy("source", y.alias("year")).agg(F.count("*").alias("rows"))


def _names(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "organization", "name").distinct().withColumn("norm", text.normalize_name(F.col("name")))


def normalize_names(s: SparkSession, d: str) -> DataFrame:
    return _names(s, d)


def expand_abbrev(s: SparkSession, d: str) -> DataFrame:
    return _names(s, d).select("norm", text.expand_abbreviations(F.col("norm")).alias("expanded")).distinct()


def name_tokens(s: SparkSession, d: str) -> DataFrame:
    return _names(s, d).select("norm", F.array_join(text.name_tokens(F.col("norm")), " ").alias("tokens")).distinct()


def countries(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "organization", "country_code").groupBy(text.canon_country(F.col("country_code")).alias("country")).agg(F.count("*").alias("rows"))




def award_keys(s: SparkSession, d: str) -> DataFrame:
    n = F.regexp_extract("source_id", r"(\d+)$", 1).cast("int")
    g = table(s, d, "grant_record", "source_id").distinct().withColumn("n", n).withColumn("d", F.lpad(F.col("n").cast("string"), 6, "0"))
    pick = lambda a, b, c, e: F.when(F.col("n") % 4 == 0, a).when(F.col("n") % 4 == 1, b).when(F.col("n") % 4 == 2, c).otherwise(e)
    award = pick(F.concat(F.lit("5R01CA"), "d", F.lit("-0"), (F.col("n") % 9).cast("string")), F.concat(F.lit("DEB-"), "d"), F.concat(F.lit("EP/"), "d", F.lit("/1")), F.concat(F.lit(" "), "source_id", F.lit(" ")))
    src = pick(F.lit("nih"), F.lit("nsf"), F.lit("ukri"), F.lit("other"))
    return g.select("source_id", src.alias("src"), F.array_join(text.award_keys(src, award), " ").alias("keys"))


def person_name_parts(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "person", "full_name", "first_name", "last_name").distinct()
    x = text.name_parts(F.col("full_name"), F.col("first_name"), F.col("last_name"))
    return p.select("full_name", x["surname"].alias("surname"), F.array_join(x["given"], " ").alias("given"), x["initial"].alias("initial")).distinct()


def money_parse(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders", "o_orderkey", "o_totalprice")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    whole, part = F.floor(cents / 100).cast("string"), F.lpad((cents % 100).cast("string"), 2, "0")
    shown = F.when(F.col("o_orderkey") % 3 == 0, F.concat(whole, F.lit(","), part)).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("$"), F.format_number(F.floor(cents / 100), 0), F.lit("."), part)).otherwise("0")
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, dates.decimal_comma(shown)).otherwise(dates.decimal_point(shown)).alias("amount"))


def date_parse(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders", "o_orderkey", "o_orderdate")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    span = dates.month_span(iso, F.lit("18"))
    return o.select("o_orderkey", dates.us_date(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("us"), dates.millis_date(F.unix_millis(F.col("o_orderdate").cast("timestamp"))).alias("millis"), span["start"].alias("span_start"), span["end"].alias("span_end"), dates.term(F.concat(F.lit("from "), F.year("o_orderdate").cast("string"), F.lit(" to 2002")))["end"].alias("term_end"), dates.status_by_end(iso, "1998-01-01").alias("status"))


def month_plan(s: SparkSession, d: str) -> DataFrame:
    """The months that the bulk feed asks for, newest first, from the first order to the last."""
    span = table(s, d, "orders", "o_orderdate").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return span.select(F.posexplode(dates.month_windows(F.col("a"), F.col("b"))).alias("nth", "w")).select("nth", "w.start", "w.end")


def json_props(s: SparkSession, d: str) -> DataFrame:
    k = F.from_json("props", "k bigint")["k"]
    return table(s, d, "events").groupBy("event_type").agg(F.sum(k).alias("k_sum"), F.count_distinct(k).alias("k_values"))


def html_text(s: SparkSession, d: str) -> DataFrame:
    page = F.concat(F.lit("<li><header><h3>"), "title", F.lit("</h3> &amp; <b>"), "atlas_id", F.lit("</b></header></li>"))
    return table(s, d, "grant_record", "atlas_id", "title").distinct().select("atlas_id", text.html_text(page).alias("text")).distinct()


def email_guard(s: SparkSession, d: str) -> DataFrame:
    found = F.coalesce(F.col("text").rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), F.lit(False))
    return table(s, d, "documents", "source", "text").groupBy("source").agg(F.sum(found.cast("long")).alias("with_email"), F.count("*").alias("documents"))


def tokens_by_lang(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents", "lang", "text").groupBy("lang").agg(F.sum(F.size(text.tokenize(F.col("text")))).cast("long").alias("tokens"))


def emails(s: SparkSession, d: str) -> DataFrame:
    """Addresses in the documents, and those that may be a person's, per source."""
    x = table(s, d, "documents", "source", "text").select("source", F.explode(contacts.addresses(F.col("text"))).alias("email"))
    return x.groupBy("source").agg(F.count("*").alias("addresses"), F.sum(contacts.acceptable(F.col("email")).cast("long")).alias("acceptable"), F.count_distinct(F.lower("email")).alias("different"))


def contact_choice(s: SparkSession, d: str) -> DataFrame:
    """Each user's contact, of hits that the event stream makes up: the type of event says which source, the value the mailbox."""
    kinds = {"view": "orcid", "click": "europepmc", "purchase": "crossref", "error": "labpage", "signup": "rumour"}
    source = F.element_at(F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]), F.col("event_type"))
    box = F.concat(F.element_at(F.array(*[F.lit(x) for x in ("info", "No-Reply", "ann", "bob")]), (F.col("event_id") % 4 + 1).cast("int")), (F.col("event_id") % 9).cast("string"), F.when(F.col("event_id") % 5 == 0, "@Example.com").otherwise("@uni.example."))
    hits = table(s, d, "events", "event_id", "user_id", "event_type").select(F.col("user_id").alias("person"), F.when(F.col("user_id") % 2 == 0, "biomed-bio").otherwise("math").alias("field_slug"), box.alias("email"), source.alias("source"))
    return contacts.best_contact(hits)


def titled_text(s: SparkSession, d: str) -> DataFrame:
    """Grants' texts as they are ranked, and their abstracts cut to what a sample shows."""
    g = table(s, d, "grant_record", "atlas_id", "title", "abstract").distinct()
    return g.select("atlas_id", text.title_and_abstract(F.col("title"), F.col("abstract")).alias("text"), text.shortened(F.col("abstract"), 200).alias("abstract")).distinct()


def inverted_abstracts(s: SparkSession, d: str) -> DataFrame:
    """Texts put back together from lists of positions by word; words that are JSON's own characters are left out."""
    w = table(s, d, "documents", "doc_id", "text").select("doc_id", F.posexplode(text.tokenize(F.col("text"))).alias("i", "w"))
    listed = w.groupBy("doc_id", "w").agg(F.sort_array(F.collect_list("i")).alias("at")).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "at"))).alias("m"))
    return listed.select("doc_id", text.inverted_abstract(F.to_json("m")).alias("text"))


def dedup_entities(s: SparkSession, d: str) -> DataFrame:
    return consolidate.dedup_entities(table(s, d, "organization"))


def dedup_edges(s: SparkSession, d: str) -> DataFrame:
    return consolidate.dedup_edges(table(s, d, "grant_org")).select("src_id", "dst_id", "role", "source", "source_id", "as_of")


def first_wins(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events", "event_id", "user_id", "event_type", "value")
    return consolidate.first_wins(e, "user_id", F.col("event_id"))


def _ror(c: str) -> F.Column:
    k = F.regexp_extract(F.lower(F.btrim(c)), r"(?:^|/)(0[0-9a-z]{6}[0-9]{2})/?$", 1)
    return F.when(k != "", k)


def canonical_orgs(s: SparkSession, d: str) -> DataFrame:
    return consolidate.canonical_orgs(table(s, d, "organization", "atlas_id", "ror_id", "source"), _ror("ror_id"))


def edge_remap(s: SparkSession, d: str) -> DataFrame:
    return consolidate.remap_edges(table(s, d, "grant_org"), canonical_orgs(s, d)).select("src_id", "dst_id", "role", "source", "as_of")


def manifest_summary(s: SparkSession, d: str) -> DataFrame:
    out = None
    for t in (*ENTITY_TABLES.values(), *EDGE_TABLES):
        x = table(s, d, t, "source", "as_of").agg(F.lit(t).alias("table_name"), F.count("*").alias("rows"), F.count_distinct("source").alias("sources"), F.max("as_of").alias("last_as_of"))
        out = x if out is None else out.unionByName(x)
    return out


def _graph_ends(s: SparkSession, d: str) -> list[tuple[str, str, DataFrame, DataFrame]]:
    """Edges and targets that only the query graph has: ``(edge, side, edge's keys, target)``."""
    g = Graph(s, d)
    return [
        ("funder_grant", "src_id", g.funder_grant, g.funder), ("grant_person", "src_id", g.grant_person, g.grant), ("grant_person", "dst_id", g.grant_person, g.person), ("person_org", "src_id", g.person_org, g.person),
        ("person_org", "dst_id", g.person_org, g.organization), ("work_field", "src_id", g.work_field, g.work), ("work_field", "dst_id", g.work_field, g.field),
    ]


def pk_unique(s: SparkSession, d: str) -> DataFrame:
    """Keys that occur more than once, per entity; funders are those of the query graph."""
    tables = {t: table(s, d, t, "atlas_id") for t in ENTITY_TABLES.values()} | {"funder": Graph(s, d).funder.select("atlas_id")}
    out = [x.groupBy("atlas_id").agg(F.count("*").alias("c")).agg(F.lit(t).alias("table_name"), F.coalesce(F.sum((F.col("c") > 1).cast("long")), F.lit(0)).alias("violations")) for t, x in tables.items()]
    return reduce(DataFrame.unionByName, out)


def orphans(s: SparkSession, d: str) -> DataFrame:
    """Edges without an endpoint, as a count per edge table and side; a key that many edges name is one row."""
    ends = (("funder_grant", "dst_id", "grant_record"), ("grant_org", "src_id", "grant_record"), ("grant_org", "dst_id", "organization"), ("grant_work", "src_id", "grant_record"), ("grant_work", "dst_id", "work_record"))
    every = [(e, side, table(s, d, e, side), table(s, d, t, "atlas_id")) for e, side, t in ends] + _graph_ends(s, d)
    out = []
    for edge, side, e, target in every:
        keyed = e.where(F.col(side).isNotNull()).groupBy(F.col(side).alias("atlas_id")).agg(F.count("*").alias("c"))
        out.append(keyed.join(target.select("atlas_id").distinct(), "atlas_id", "left_anti").agg(F.lit(edge).alias("edge"), F.lit(side).alias("side"), F.coalesce(F.sum("c"), F.lit(0)).alias("violations")))
    return reduce(DataFrame.unionByName, out)


def provenance(s: SparkSession, d: str) -> DataFrame:
    out = None
    for t in (*ENTITY_TABLES.values(), *EDGE_TABLES):
        x = consolidate.provenance_gaps(table(s, d, t), t)
        out = x if out is None else out.unionByName(x)
    return out


def _count(name: str, cond: F.Column) -> F.Column:
    return F.sum(F.coalesce(cond, F.lit(False)).cast("long")).alias(name)


def money_checks(s: SparkSession, d: str) -> DataFrame:
    usd, cur, fx = F.col("amount_usd"), F.col("currency"), F.col("fx_rate_to_usd")
    return table(s, d, "grant_record").agg(
        _count("not_positive", usd <= 0), _count("amount_without_currency", F.col("amount_original").isNotNull() & cur.isNull()), _count("currency_without_amount", F.col("amount_original").isNull() & cur.isNotNull()), _count("usd_rate_not_one", (cur == "USD") & (F.abs(fx - 1) > 1e-9)),
        _count("no_rate", usd.isNotNull() & fx.isNull()), _count("wrong_product", F.abs(usd - F.col("amount_original") * fx) > 1.0), _count("no_rate_date", usd.isNotNull() & F.col("fx_as_of").isNull()),
    )


def ror_orcid_format(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "organization", "ror_id").agg(F.lit("ror").alias("id"), F.count("ror_id").alias("given"), _count("malformed", ~F.col("ror_id").rlike(_ROR)))
    p = table(s, d, "person", "orcid").agg(F.lit("orcid").alias("id"), F.count("orcid").alias("given"), _count("malformed", ~F.col("orcid").rlike(_ORCID)))
    return o.unionByName(p)


def shared_ror(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "organization", "ror_id", "atlas_id").select(_ror("ror_id").alias("ror"), "atlas_id").where("ror is not null").groupBy("ror").agg(F.count_distinct("atlas_id").alias("keys")).where("keys > 1")


def unfunded_grants(s: SparkSession, d: str) -> DataFrame:
    funded = table(s, d, "funder_grant", "dst_id", "role").where("role = 'awarder'").select(F.lower(F.btrim("dst_id")).alias("atlas_id")).distinct()
    return table(s, d, "grant_record", "atlas_id").distinct().join(funded, "atlas_id", "left_anti")


def coverage_soft(s: SparkSession, d: str) -> DataFrame:
    share = lambda c: F.round(F.avg(c.cast("double")), 6)
    o = table(s, d, "organization").groupBy("source").agg(share(F.col("ror_id").isNotNull()).alias("ror_share"))
    g = table(s, d, "grant_record").groupBy("source").agg(F.count("*").alias("grants"), F.round(F.sum("amount_usd"), 2).alias("usd"))
    p = table(s, d, "person").groupBy("source").agg(share(F.col("orcid").isNotNull()).alias("orcid_share"))
    return g.join(o, "source", "left").join(p, "source", "left")


_ALL = (surrogate_keys, enforce_schema_grant, partition_years, normalize_names, expand_abbrev, name_tokens, countries, award_keys, person_name_parts, money_parse, date_parse, month_plan, json_props, html_text, email_guard, emails, contact_choice, titled_text, inverted_abstracts, tokens_by_lang, dedup_entities, dedup_edges, first_wins,
        canonical_orgs, edge_remap, manifest_summary, pk_unique, orphans, provenance, money_checks, ror_orcid_format, shared_ror, unfunded_grants, coverage_soft)
QUERIES = {f.__name__: f for f in _ALL}

_TITLE_LIST = ", ".join(f"'{w}'" for w in text.TITLES)


def norm_sql(name: str) -> str:
    return f"trim(regexp_replace(regexp_replace(replace(lower(strip_accents(coalesce({name}, ''))), '&', ' and '), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"


def tokens_sql(norm: str) -> str:
    stop = ", ".join(f"'{w}'" for w in text.STOPWORDS)
    return f"list_sort(list_distinct(list_filter(string_split({norm}, ' '), lambda w: len(w) > 1 AND w NOT IN ({stop}))))"


def _name_parts() -> str:
    """The struct of ``text.name_parts`` in SQL, of full_name, first_name and last_name."""
    norm = lambda c: f"trim(regexp_replace(regexp_replace(lower(strip_accents({c})), '[^a-z0-9, ]+', ' ', 'g'), ' +', ' ', 'g'))"
    words = lambda e: f"list_filter(string_split_regex(replace({e}, ',', ' '), ' +'), lambda w: w <> '' AND w NOT IN ({_TITLE_LIST}))"
    whole = f"regexp_replace({norm('full_name')}, ', *(phd|md|jr|sr|ii|iii|iv)\\b', '', 'g')"
    parts = f"string_split({whole}, ',')"
    side = lambda i: words(f"coalesce({parts}[{i}], '')")
    last, first = words(norm("last_name")), words(norm("first_name"))
    make = lambda sur, given: f"struct_pack(surname := {sur}, given := {given}, initial := substr(coalesce(({given})[1], ''), 1, 1))"
    return f"""CASE WHEN len({last}) > 0 THEN {make(f"array_to_string({last}, ' ')", f"coalesce({first}, []::VARCHAR[])")} WHEN len({parts}) > 2 THEN NULL
      WHEN len({parts}) = 2 AND len({side(1)}) > 0 THEN {make(f"array_to_string({side(1)}, ' ')", side(2))} WHEN len({words(whole)}) > 0 THEN {make(f"({words(whole)})[-1]", f"({words(whole)})[:-2]")} END"""


NAME_PARTS = _name_parts()
_NORM = "trim(regexp_replace(regexp_replace(replace(lower(strip_accents(coalesce(name, ''))), '&', ' and '), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"
_NSQL = f"SELECT DISTINCT name, {_NORM} AS norm FROM organization"
_MAP = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in text.ABBREVIATIONS.items()) + "}"
_STOP = ", ".join(f"'{w}'" for w in text.STOPWORDS)
_RORX = "nullif(regexp_extract(lower(trim(ror_id)), '(?:^|/)(0[0-9a-z]{6}[0-9]{2})/?$', 1), '')"
_CANON = f"SELECT DISTINCT o.atlas_id, coalesce(m.canonical_id, o.atlas_id) AS canonical_id, m.sources FROM organization o LEFT JOIN (SELECT k.atlas_id, min(struct_pack(i := c.canonical_id, s := c.sources)).i AS canonical_id, min(struct_pack(i := c.canonical_id, s := c.sources)).s AS sources FROM (SELECT DISTINCT atlas_id, {_RORX} AS ror FROM organization) k JOIN (SELECT {_RORX} AS ror, min(atlas_id) AS canonical_id, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM organization WHERE {_RORX} IS NOT NULL GROUP BY 1) c ON k.ror = c.ror GROUP BY 1) m ON o.atlas_id = m.atlas_id"
_TABLES = (*ENTITY_TABLES.values(), *EDGE_TABLES)
_PLACES = ", ".join(f"'{x}'" for x in contacts.PLACEHOLDERS)
_NOBODY = "|".join(n.replace("-", "-?").replace(".", "\\.") for n in contacts.NOBODY)


def _newest_sql(t: str, key: str, cols: list[str]) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in cols)
    return f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY as_of::timestamptz DESC, {order}) AS rn FROM {t}) WHERE rn = 1"


ORACLES = {
    "surrogate_keys": "SELECT DISTINCT atlas_id, source, name, 'org:' || substr(sha1('organization|' || lower(trim(source)) || CASE WHEN trim(coalesce(name, '')) = '' THEN '' ELSE '|' || lower(trim(name)) END), 1, 16) AS key FROM organization",
    "enforce_schema_grant": "SELECT DISTINCT atlas_id, amount_usd, currency, as_of FROM grant_record",
    "partition_years": "SELECT source, substr(coalesce(CASE WHEN regexp_matches(start_date, '^[0-9]{4}') THEN start_date END, CASE WHEN regexp_matches(end_date, '^[0-9]{4}') THEN end_date END, as_of, '0000'), 1, 4) AS year, count(*) AS rows FROM grant_record GROUP BY ALL",
    "normalize_names": _NSQL,
    "expand_abbrev": f"SELECT DISTINCT norm, CASE WHEN norm LIKE '% %' THEN array_to_string(list_transform(string_split(norm, ' '), lambda w: coalesce({_MAP}[w], w)), ' ') ELSE norm END AS expanded FROM ({_NSQL})",
    "name_tokens": f"SELECT DISTINCT norm, array_to_string(list_sort(list_distinct(list_filter(string_split(norm, ' '), lambda w: len(w) > 1 AND w NOT IN ({_STOP})))), ' ') AS tokens FROM ({_NSQL})",
    "countries": "SELECT CASE upper(trim(country_code)) WHEN 'EL' THEN 'GR' WHEN 'UK' THEN 'GB' ELSE nullif(upper(trim(country_code)), '') END AS country, count(*) AS rows FROM organization GROUP BY 1",
    "person_name_parts": f"SELECT DISTINCT full_name, n.surname AS surname, array_to_string(n.given, ' ') AS given, n.initial AS initial FROM (SELECT full_name, {NAME_PARTS} AS n FROM person)",
    "award_keys": r"""SELECT source_id, src, CASE src WHEN 'nih' THEN '5R01CA' || d || '0' || (n % 9) || ' NIH:CA' || d || ' NIH:R01CA' || d WHEN 'nsf' THEN d || ' DEB' || d || ' NSF:' || d WHEN 'ukri' THEN 'EP' || d || '1 UKRI:EP' || d || '1' ELSE regexp_replace(upper(source_id), '[^A-Z0-9]', '', 'g') END AS keys
      FROM (SELECT DISTINCT source_id, n, lpad(n::VARCHAR, 6, '0') AS d, ['nih', 'nsf', 'ukri', 'other'][n % 4 + 1] AS src FROM (SELECT source_id, regexp_extract(source_id, '(\d+)$', 1)::INT AS n FROM grant_record))""",
    "money_parse": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN round(o_totalprice, 2) END AS amount FROM orders",
    "date_parse": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS us, strftime(o_orderdate, '%Y-%m-%d') AS millis, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS span_start, strftime(date_trunc('month', o_orderdate) + INTERVAL 18 MONTH, '%Y-%m-%d') AS span_end, '2002-12-31' AS term_end, CASE WHEN o_orderdate >= '1998-01-01' THEN 'active' ELSE 'completed' END AS status FROM orders",
    "month_plan": "SELECT (row_number() OVER (ORDER BY m DESC) - 1)::INT AS nth, strftime(m, '%Y-%m-%d') AS start, strftime(last_day(m), '%Y-%m-%d') AS end FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)",
    "json_props": "SELECT event_type, sum((props::JSON ->> 'k')::BIGINT)::BIGINT AS k_sum, count(DISTINCT props::JSON ->> 'k') AS k_values FROM events GROUP BY 1",
    "html_text": r"SELECT DISTINCT atlas_id, trim(regexp_replace(title, '\s+', ' ', 'g')) || ' & ' || atlas_id AS text FROM grant_record",
    "email_guard": r"SELECT source, count(*) FILTER (WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) AS with_email, count(*) AS documents FROM documents GROUP BY 1",
    "tokens_by_lang": r"SELECT lang, sum(len(regexp_extract_all(lower(coalesce(text, '')), '[a-z][a-z0-9\-]+')))::BIGINT AS tokens FROM documents GROUP BY 1",
    "dedup_entities": _newest_sql("organization", "atlas_id", ["name", "ror_id", "country_code", "city", "region", "org_type", "homepage", "lat", "lon", "source", "source_id", "source_url", "as_of"]),
    "dedup_edges": f"SELECT src_id, dst_id, role, source, source_id, as_of FROM ({_newest_sql('grant_org', 'src_id, dst_id, role, source', ['source_id', 'source_url', 'as_of'])})",
    "first_wins": "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 1",
    "canonical_orgs": _CANON,
    "edge_remap": f"SELECT src_id, dst_id, role, source, as_of FROM ({_newest_sql(f'(SELECT e.* REPLACE (coalesce(c.canonical_id, e.dst_id) AS dst_id) FROM grant_org e LEFT JOIN ({_CANON}) c ON e.dst_id = c.atlas_id)', 'src_id, dst_id, role, source', ['source_id', 'source_url', 'as_of'])})",
    "manifest_summary": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows, count(DISTINCT source) AS sources, max(as_of) AS last_as_of FROM {t}" for t in _TABLES),
    "pk_unique": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS violations FROM (SELECT atlas_id FROM {t} GROUP BY 1 HAVING count(*) > 1)" for t in ENTITY_TABLES.values()) + " UNION ALL SELECT 'funder', count(*) FROM (SELECT s_suppkey FROM supplier GROUP BY 1 HAVING count(*) > 1)",
    "orphans": with_views(" UNION ALL ".join(f"SELECT '{e}' AS edge, '{c}' AS side, count(*) AS violations FROM {v} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT atlas_id FROM {t})" for e, c, v, t in (
        ("funder_grant", "dst_id", "funder_grant", "grant_record"), ("grant_org", "src_id", "grant_org", "grant_record"), ("grant_org", "dst_id", "grant_org", "organization"), ("grant_work", "src_id", "grant_work", "grant_record"), ("grant_work", "dst_id", "grant_work", "work_record"),
        ("funder_grant", "src_id", "fg", "funder"), ("grant_person", "src_id", "grant_person", "grants"), ("grant_person", "dst_id", "grant_person", "persons"), ("person_org", "src_id", "person_org", "persons"), ("person_org", "dst_id", "person_org", "org"), ("work_field", "src_id", "work_field", "work"), ("work_field", "dst_id", "work_field", "fields"),
    ))),
    "emails": rf"SELECT source, count(*) AS addresses, count(*) FILTER (WHERE split_part(e, '@', 2) NOT IN ({_PLACES}) AND NOT regexp_matches(split_part(e, '@', 1), '{_NOBODY}') AND NOT regexp_matches(e, '\\.(gif|jpg|png|svg|webp)$')) AS acceptable, count(DISTINCT lower(email)) AS different FROM (SELECT *, regexp_replace(lower(trim(email)), '\\.+$', '') AS e FROM (SELECT source, unnest(regexp_extract_all(text, '{text.EMAIL}')) AS email FROM documents)) GROUP BY 1",
    "contact_choice": rf"""WITH h AS (SELECT user_id AS person, CASE event_type WHEN 'view' THEN 'orcid' WHEN 'click' THEN 'europepmc' WHEN 'purchase' THEN 'crossref' WHEN 'error' THEN 'labpage' END AS source, user_id % 2 = 0 AS life, ['info', 'no-reply', 'ann', 'bob'][event_id % 4 + 1] || (event_id % 9) || CASE WHEN event_id % 5 = 0 THEN '@example.com' ELSE '@uni.example' END AS email FROM events)
      SELECT person, first(email ORDER BY r, email) AS email, first(source ORDER BY r, email) AS source FROM (SELECT *, list_position(CASE WHEN life THEN ['europepmc', 'orcid', 'crossref', 'labpage'] ELSE ['orcid', 'europepmc', 'crossref', 'labpage'] END, source) AS r FROM h WHERE source IS NOT NULL AND email NOT LIKE '%example.com' AND (email LIKE 'ann%' OR email LIKE 'bob%')) GROUP BY 1""",
    "titled_text": "SELECT DISTINCT atlas_id, nullif(trim(coalesce(title, '') || '. ' || coalesce(abstract, '')), '.') AS text, substr(abstract, 1, 200) AS abstract FROM grant_record",
    "inverted_abstracts": r"SELECT doc_id, array_to_string(t, ' ') AS text FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z][a-z0-9\-]+') AS t FROM documents WHERE text IS NOT NULL) WHERE len(t) > 0",
    "provenance": " UNION ALL ".join(f"SELECT '{t}' AS table_name, " + ", ".join(f"count(*) FILTER (WHERE coalesce({c}, '') = '') AS {c}" for c in keys.PROVENANCE) + f" FROM {t}" for t in _TABLES),
    "money_checks": "SELECT count(*) FILTER (WHERE amount_usd <= 0) AS not_positive, count(*) FILTER (WHERE amount_original IS NOT NULL AND currency IS NULL) AS amount_without_currency, count(*) FILTER (WHERE amount_original IS NULL AND currency IS NOT NULL) AS currency_without_amount, count(*) FILTER (WHERE currency = 'USD' AND abs(fx_rate_to_usd - 1) > 1e-9) AS usd_rate_not_one, count(*) FILTER (WHERE amount_usd IS NOT NULL AND fx_rate_to_usd IS NULL) AS no_rate, count(*) FILTER (WHERE abs(amount_usd - amount_original * fx_rate_to_usd) > 1.0) AS wrong_product, count(*) FILTER (WHERE amount_usd IS NOT NULL AND fx_as_of IS NULL) AS no_rate_date FROM grant_record",
    "ror_orcid_format": rf"SELECT 'ror' AS id, count(ror_id) AS given, count(*) FILTER (WHERE NOT regexp_matches(ror_id, '{_ROR}')) AS malformed FROM organization UNION ALL SELECT 'orcid', count(orcid), count(*) FILTER (WHERE NOT regexp_matches(orcid, '{_ORCID}')) FROM person",
    "shared_ror": f"SELECT {_RORX} AS ror, count(DISTINCT atlas_id) AS keys FROM organization WHERE {_RORX} IS NOT NULL GROUP BY 1 HAVING keys > 1",
    "unfunded_grants": "SELECT DISTINCT atlas_id FROM grant_record WHERE atlas_id NOT IN (SELECT lower(trim(dst_id)) FROM funder_grant WHERE role = 'awarder' AND dst_id IS NOT NULL)",
    "coverage_soft": "SELECT * FROM (SELECT source, count(*) AS grants, round(sum(amount_usd), 2) AS usd FROM grant_record GROUP BY 1) LEFT JOIN (SELECT source, round(avg((ror_id IS NOT NULL)::INT), 6) AS ror_share FROM organization GROUP BY 1) USING (source) LEFT JOIN (SELECT source, round(avg((orcid IS NOT NULL)::INT), 6) AS orcid_share FROM person GROUP BY 1) USING (source)",
}
