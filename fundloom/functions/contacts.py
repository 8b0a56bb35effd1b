"""Rules for public e-mail addresses in texts: what is one, whose it is, and which of several to prefer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundloom.functions.text import EMAIL, last_segment, plausible_email

# Parts of mailboxes that belong to nobody, domains that are placeholders, and endings of files.
NOBODY = ("no-reply", "noreply", "do-not-reply", "donotreply", "webmaster", "postmaster", "info", "admin", "support", "help", "contact", "sales", "press", "media", "privacy", "abuse", "example.com", "example.org", "example.net")
PLACEHOLDERS = ("domain.com", "email.com", "example.com", "example.org", "sentry-next.wixpress.com", "sentry.io", "wixpress.com")
FILES = (".gif", ".jpg", ".png", ".svg", ".webp")
# The order in which sources are trusted, in general and in the life sciences.
ORDER, LIFE_ORDER = ("orcid", "europepmc", "crossref", "labpage"), ("europepmc", "orcid", "crossref", "labpage")
LIFE = ("biomed-bio", "chemistry")


def _tidy(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.btrim(c)), r"\.+$", "")


def addresses(c: Column) -> Column:
    """All e-mail addresses in a text, in order; empty for null."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(EMAIL), F.lit(0))


def electronic_address(c: Column) -> Column:
    """The address after "Electronic address:", as medical abstracts give that of the corresponding author; null for none."""
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), rf"[Ee]lectronic address:\s*({EMAIL})", 1), F.lit(""))


def acceptable(c: Column) -> Column:
    """Whether an address may be a person's: no shared or automatic mailbox, no placeholder, no file name."""
    e = _tidy(c)
    local, domain = F.substring_index(e, "@", 1), F.regexp_extract(e, "@(.*)$", 1)
    shared = local.rlike("|".join(n.replace("-", "-?").replace(".", r"\.") for n in NOBODY))
    ends = F.lit(False)
    for x in FILES:
        ends = ends | e.endswith(x)
    return F.coalesce(e.contains("@") & ~domain.isin(*PLACEHOLDERS) & ~shared & ~ends, F.lit(False))


def name_words(c: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[\s,.]+"), lambda w: F.length(w) > 1)


def same_author(orcid: Column, name: Column, other_orcid: Column, other_name: Column) -> Column:
    """Whether an author of a record is the person: two ORCIDs decide, else a shared word of the names."""
    mine, theirs = last_segment(orcid), last_segment(other_orcid)
    return F.when(mine.isNotNull() & theirs.isNotNull(), mine == theirs).otherwise(F.arrays_overlap(name_words(name), name_words(other_name)))


def violations(email: Column, source: Column, url: Column, as_of: Column) -> Column:
    """What is wrong with an address: syntax, and each part of its provenance that is missing; empty for no address."""
    e = F.nullif(F.btrim(email), F.lit(""))
    found = F.array(
        F.when(~plausible_email(e), "syntax"), F.when(~F.coalesce(source.isin(*ORDER), F.lit(False)), "source"), F.when(F.coalesce(F.btrim(url), F.lit("")) == "", "url"), F.when(F.coalesce(F.btrim(as_of), F.lit("")) == "", "as_of"),
    )
    return F.when(e.isNull(), F.array().cast("array<string>")).otherwise(F.filter(found, lambda x: x.isNotNull()))


def best_contact(hits: DataFrame) -> DataFrame:
    """``(person, email, source)``: of each person's ``hits`` (person, field_slug, email, source) the acceptable one of the
    most trusted source, the life sciences having an order of their own; ties by address. Unknown sources are left out."""
    place = lambda order: F.array_position(F.array(*[F.lit(x) for x in order]), F.col("source"))
    rank = F.when(F.col("field_slug").isin(*LIFE), place(LIFE_ORDER)).otherwise(place(ORDER))
    good = hits.withColumn("rank", rank).where(acceptable(F.col("email")) & (F.col("rank") > 0))
    return good.groupBy("person").agg(F.min(F.struct("rank", _tidy(F.col("email")).alias("email"), "source")).alias("m")).select("person", "m.email", "m.source")
