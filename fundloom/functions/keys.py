"""Surrogate keys, schemas and partition years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Key prefix by entity, and the column order of the published tables.
PREFIX = {"funder": "fund", "grant": "grant", "organization": "org", "person": "person", "work": "work", "field": "field"}
PROVENANCE = ("source", "source_id", "source_url", "as_of")
ENTITIES = {
    "funder": "atlas_id name short_name country_code funder_type ror_id crossref_funder_id homepage",
    "grant": "atlas_id title abstract amount_original currency amount_usd fx_rate_to_usd fx_as_of start_date end_date status program",
    "organization": "atlas_id name ror_id country_code city region org_type homepage lat lon",
    "person": "atlas_id full_name first_name last_name orcid openalex_author_id",
    "work": "atlas_id title doi openalex_id publication_year publication_date type cited_by_count is_oa",
    "field": "atlas_id name openalex_id level parent_atlas_id",
}
EDGES = {"funder_grant": "role", "grant_org": "role", "grant_person": "role", "grant_work": "role", "person_org": "role", "work_field": "score"}
_TYPES = {"amount_original": "double", "amount_usd": "double", "fx_rate_to_usd": "double", "lat": "double", "lon": "double", "publication_year": "bigint", "cited_by_count": "bigint", "is_oa": "boolean", "score": "double"}


def columns(name: str) -> list[str]:
    """Columns of a published table in order. Unknown tables raise KeyError."""
    return [*(ENTITIES[name].split() if name in ENTITIES else ["src_id", "dst_id", EDGES[name]]), *PROVENANCE]


def schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(c, T._parse_datatype_string(_TYPES.get(c, "string"))) for c in columns(name)])


def enforce_schema(df: DataFrame, name: str) -> DataFrame:
    """``df`` with exactly the columns of ``name``, in order and type; a missing one is null, an unknown one raises
    ValueError. Money of zero isn't money: the row fails when it is read."""
    unknown = set(df.columns) - set(columns(name))
    if unknown:
        raise ValueError(f"unknown columns for {name}: {sorted(unknown)}")
    out = df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(_TYPES.get(c, "string")).alias(c) for c in columns(name)])
    if name == "grant":
        out = out.withColumn("amount_usd", F.when(F.col("amount_usd") == 0, F.raise_error(F.lit("amount_usd must be null or not zero"))).otherwise(F.col("amount_usd")))
    return out


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")


def surrogate_key(entity: str, *parts: Column) -> Column:
    """``prefix:`` and 16 hex digits of the SHA-1 of the entity and its non-blank parts, trimmed and lower-cased.

    No part at all gives null (a key can't be made).
    """
    clean = [F.nullif(F.lower(strip(p.cast("string"))), F.lit("")) for p in parts]
    some = F.coalesce(*clean)
    return F.when(some.isNotNull(), F.concat(F.lit(PREFIX.get(entity, entity[:4]) + ":"), F.substring(F.sha1(F.concat_ws("|", F.lit(entity), *clean)), 1, 16)))


def partition_year(*candidates: Column) -> Column:
    """The first candidate that begins with four digits, as a year; ``0000`` if none does."""
    y = [F.when(c.cast("string").rlike("^[0-9]{4}"), F.substring(c.cast("string"), 1, 4)) for c in candidates]
    return F.coalesce(*y, F.lit("0000"))
