"""Queries of the subpackage by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fundloom.llm import encoding, entities, leakage, matching, near_duplicates, survivors, toxicity
from fundloom.sources.tables import table


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of grants that say nearly the same."""
    return near_duplicates.near_duplicate_pairs(table(spark, root, "grant_record", "atlas_id", "title", "abstract"))


def p2_groups(spark: SparkSession, root: str) -> DataFrame:
    """Each grant with its class of near-duplicates and its number of links."""
    return near_duplicates.near_duplicate_groups(table(spark, root, "grant_record", "atlas_id", "title", "abstract"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """Records that spell one institution, person or recipient in different ways."""
    return entities.variants(table(spark, root, "organization"), table(spark, root, "person"), table(spark, root, "sample_rows"))


def p5_scores(spark: SparkSession, root: str) -> DataFrame:
    """Direct links between spellings, scored by rarity and evidence."""
    return entities.variant_scores(table(spark, root, "organization"), table(spark, root, "person"))


def p6_matches(spark: SparkSession, root: str) -> DataFrame:
    """Register entries of institutions and people with a confidence."""
    return matching.matches(*(table(spark, root, t) for t in ("organization", "person", "registry_org", "registry_person")))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    """Register entries of institutions and people."""
    return p6_matches(spark, root).select("kind", "atlas_id", "reg_id")


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    """Where the surviving name and homepage of each shared ROR id come from."""
    return survivors.survivors(table(spark, root, "organization")).select("ror_id", "name_from", "homepage_from")


def p7_records(spark: SparkSession, root: str) -> DataFrame:
    """The whole surviving record of each shared ROR id."""
    s = survivors.survivors(table(spark, root, "organization"))
    return s.select("ror_id", "name", "homepage", "address.city", "address.region", "address.country_code", "address_from", "geo.lat", "geo.lon", "geo_from", "keys")


def p8_ids(spark: SparkSession, root: str) -> DataFrame:
    """Token ids of every document."""
    return encoding.token_ids(table(spark, root, "documents", "doc_id", "text"))


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents that hold passages of evaluation items."""
    return leakage.leaks(table(spark, root, "documents", "doc_id", "text"), table(spark, root, "eval_item", "item_id", "text"))


def p9_cleaned(spark: SparkSession, root: str) -> DataFrame:
    """Documents with a leak, without the leaked words."""
    return leakage.cleaned(table(spark, root, "documents", "doc_id", "text"), table(spark, root, "eval_item", "item_id", "text"))


def p10_scores(spark: SparkSession, root: str) -> DataFrame:
    """A score for each document."""
    return toxicity.scores(table(spark, root, "documents", "doc_id", "source", "text"), table(spark, root, "doc_label"))


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents with abusive, hateful or sexual content."""
    return p10_scores(spark, root).where("flagged").select("doc_id")


def p10_rates(spark: SparkSession, root: str) -> DataFrame:
    """Rates per source."""
    return toxicity.rates(p10_scores(spark, root))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p2_found, p2_groups, p5_found, p5_scores, p6_found, p6_matches, p7_found, p7_records, p8_ids, p9_found, p9_cleaned, p10_found, p10_scores, p10_rates)}


_SAYS = lambda c: f"(regexp_matches({c}, '[\\p{{L}}\\p{{N}}]') AND lower(trim({c})) NOT IN (" + ", ".join(f"'{w}'" for w in survivors.STAND_INS) + "))"
# Every address of a group with every pair of coordinates that doesn't contradict it.
_RECORDS = rf"""WITH o AS (SELECT regexp_extract(lower(trim(ror_id)), '(?:^|/)(0[0-9a-z]{{6}}[0-9]{{2}})/?$', 1) AS r, atlas_id, epoch_us(as_of::timestamptz) AS us,
    CASE WHEN {_SAYS("name")} THEN name END AS name, CASE WHEN homepage LIKE '%.%' THEN homepage END AS homepage, CASE WHEN {_SAYS("city")} THEN trim(city) END AS city, CASE WHEN {_SAYS("region")} THEN trim(region) END AS region,
    CASE WHEN {_SAYS("country_code")} THEN upper(trim(country_code)) END AS country_code, lat, lon FROM organization WHERE atlas_id IS NOT NULL),
  t AS (SELECT *, coalesce(greatest(0, us // 86400000000) + 2, 1) AS trust FROM o WHERE r <> ''),
  k AS (SELECT r, count(DISTINCT atlas_id) AS keys, arg_max(name, (us, atlas_id)) FILTER (WHERE name IS NOT NULL) AS name, arg_max(homepage, (us, atlas_id)) FILTER (WHERE homepage IS NOT NULL) AS homepage FROM t GROUP BY 1 HAVING keys >= 2),
  a AS (SELECT r, atlas_id AS a, us, trust, city, region, country_code FROM t WHERE city IS NOT NULL OR country_code IS NOT NULL),
  g AS (SELECT r, atlas_id AS g, us AS gus, trust AS gtrust, city AS gcity, country_code AS gcountry, lat, lon FROM t WHERE lat IS NOT NULL AND lon IS NOT NULL),
  c AS (SELECT k.r, a, us, trust, city, region, country_code, g, gus, gtrust, lat, lon FROM k LEFT JOIN a ON a.r = k.r LEFT JOIN g ON g.r = k.r AND coalesce(lower(gcity) = lower(city), true) AND coalesce(gcountry = country_code, true)),
  b AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY coalesce(trust, 0) + coalesce(gtrust, 0) DESC, us DESC NULLS LAST, (region IS NOT NULL) DESC, a DESC NULLS LAST, city DESC NULLS LAST, region DESC NULLS LAST, country_code DESC NULLS LAST, gus DESC NULLS LAST, g DESC NULLS LAST, lat DESC, lon DESC) AS rn FROM c)
  SELECT k.r AS ror_id, name, homepage, city, region, country_code, coalesce(a, '') AS address_from, lat, lon, coalesce(g, '') AS geo_from, keys FROM k JOIN b ON b.r = k.r WHERE rn = 1"""
_PAIRS = r"""w AS (SELECT DISTINCT atlas_id, regexp_extract_all(lower(coalesce(title, '') || ' ' || abstract), '[\p{L}\p{N}]+') AS w
        FROM grant_record WHERE atlas_id IS NOT NULL AND len(regexp_extract_all(lower(abstract), '[\p{L}\p{N}]+')) >= 20),
      v AS (SELECT *, row_number() OVER () AS v FROM (SELECT DISTINCT atlas_id, list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS s FROM w)),
      s AS (SELECT v, unnest(s) AS t FROM v), c AS (SELECT a.v AS x, b.v AS y, count(*) AS c FROM s a JOIN s b ON a.t = b.t GROUP BY 1, 2),
      l AS (SELECT a.v AS v, a.atlas_id AS x, b.atlas_id AS y FROM c JOIN v a ON a.v = c.x JOIN v b ON b.v = c.y WHERE c >= 0.5 * (len(a.s) + len(b.s) - c))"""
ORACLES = {
    # A key with several texts counts the partners of the one that has most.
    "p2_groups": f"""WITH RECURSIVE {_PAIRS}, u AS (SELECT DISTINCT x, y FROM l), up AS (SELECT x AS atlas_id, y AS z FROM u UNION SELECT up.atlas_id, u.y FROM up JOIN u ON u.x = up.z)
      SELECT atlas_id, class_id, links FROM (SELECT atlas_id, min(z) AS class_id FROM up GROUP BY 1) JOIN (SELECT x AS atlas_id, max(n) - 1 AS links FROM (SELECT v, x, count(*) AS n FROM l GROUP BY 1, 2) GROUP BY 1) USING (atlas_id)""",
    "p7_records": _RECORDS,
    "p2_found": r"""WITH w AS (SELECT DISTINCT atlas_id, regexp_extract_all(lower(coalesce(title, '') || ' ' || abstract), '[\p{L}\p{N}]+') AS w
        FROM grant_record WHERE len(regexp_extract_all(lower(abstract), '[\p{L}\p{N}]+')) >= 20),
      s AS (SELECT DISTINCT atlas_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS t FROM w),
      n AS (SELECT atlas_id, count(*) AS n FROM s GROUP BY 1),
      c AS (SELECT a.atlas_id AS x, b.atlas_id AS y, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.atlas_id < b.atlas_id GROUP BY 1, 2)
      SELECT x AS grant_a, y AS grant_b FROM c JOIN n a ON a.atlas_id = x JOIN n b ON b.atlas_id = y WHERE c >= 0.5 * (a.n + b.n - c)""",
    "p7_found": r"""WITH o AS (SELECT regexp_extract(lower(trim(ror_id)), '(?:^|/)(0[0-9a-z]{6}[0-9]{2})/?$', 1) AS r, * FROM organization)
      SELECT r AS ror_id,
        coalesce(arg_max(atlas_id, (as_of::timestamptz, atlas_id)) FILTER (WHERE regexp_matches(name, '[a-zA-Z]') AND lower(trim(name)) NOT IN ('n/a', 'unknown', '(not stated)', 'tbd', 'none')), '') AS name_from,
        coalesce(arg_max(atlas_id, (as_of::timestamptz, atlas_id)) FILTER (WHERE homepage LIKE '%.%'), '') AS homepage_from
      FROM o WHERE r <> '' GROUP BY 1 HAVING count(DISTINCT atlas_id) >= 2""",
    "p9_cleaned": r"""WITH d AS (SELECT doc_id, text, regexp_extract_all(text, '(?s)[^\p{L}\p{N}]*[\p{L}\p{N}]+') AS p, regexp_extract_all(lower(replace(text, 'İ', 'i')), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
      i AS (SELECT item_id, regexp_extract_all(lower(replace(text, 'İ', 'i')), '[\p{L}\p{N}]+') AS w FROM eval_item),
      g AS (SELECT DISTINCT least(12, len(w)) AS n, array_to_string(w[k : k + least(12, len(w)) - 1], ' ') AS g FROM (SELECT w, unnest(range(1, len(w) - least(12, len(w)) + 2)) AS k FROM i WHERE len(w) > 0)),
      s AS (SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
      gone AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM s JOIN g USING (n, g)) GROUP BY 1)
      SELECT d.doc_id, len(p) AS words, len(gone) AS leaked_words, coalesce(array_to_string(list_filter(p, lambda x, j: NOT list_contains(gone, j)), ''), '') || substr(text, length(array_to_string(p, '')) + 1) AS kept_text FROM d JOIN gone USING (doc_id)""",
    "p9_found": r"""WITH d AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), ' ') || ' ' AS t FROM documents WHERE text IS NOT NULL),
      i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_item),
      g AS (SELECT DISTINCT item_id, ' ' || array_to_string(w[k : k + least(12, len(w)) - 1], ' ') || ' ' AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - least(12, len(w)) + 2)) AS k FROM i WHERE len(w) > 0))
      SELECT DISTINCT doc_id, item_id FROM g JOIN d ON contains(t, g)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
