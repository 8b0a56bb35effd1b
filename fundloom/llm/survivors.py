"""One surviving record per group of duplicates, chosen bundle by bundle.

A bundle is a set of fields that only make sense together (name; homepage; city with region and country; latitude with
longitude) and is taken from one row as a whole. A functional dependency binds two of them: a place fixes its
coordinates, so coordinates must come from a row whose address doesn't contradict the chosen one. Among the choices that
obey this, the one of greatest trust wins; it is found by branch and bound:

1. Root: name and homepage depend on nothing, so their best bundle closes the bound at once.
2. Branches: one per distinct place of a group. A branch's bound is the trust of its address plus the greatest trust that
   any coordinates of the group have.
3. Incumbent: the branch of the greatest bound is worked out in full.
4. Branches whose bound lies below the incumbent are cut; coordinates are looked up for those that are left only.

Trust of a bundle is the number of days since 1970 of its row's as_of, so that the trust of several adds up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundloom.functions.instants import micros

#: What sources write where they have nothing to say.
STAND_INS = ("", "-", "--", ".", "?", "n/a", "na", "n.a.", "none", "null", "nil", "nan", "unknown", "not stated", "(not stated)", "not available", "not provided", "not specified", "not known", "unspecified", "(unknown)", "(none)", "tbd", "tba", "tbc", "to be determined", "to be announced", "to be confirmed", "pending", "x", "xx", "xxx", "other", "various", "test")


def says(c: Column) -> Column:
    """Whether a text says something: not null, blank or a stand-in."""
    t = F.lower(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", ""))
    return F.coalesce(~t.isin(*STAND_INS) & t.rlike(r"[\p{L}\p{N}]"), F.lit(False))


def ror_key(c: Column) -> Column:
    """The nine characters of a ROR id in any notation, in lower case; null for junk."""
    k = F.regexp_extract(F.lower(c), r"^[\s ]*(?:(?:https?://)?(?:www\.)?(?:ror\.[a-z.]+/|ror:))?\s*(0[0-9a-z]{6}[0-9]{2})[\s /]*$", 1)
    return F.when(k != "", k)


def host(c: Column) -> Column:
    """Host that a homepage names, in lower case and without www; null for none."""
    h = F.regexp_extract(F.lower(c), r"^[\s ]*(?:[a-z][a-z0-9+.-]*://)?(?:[^/@\s]*@)?(?:www\.)?((?:[\p{L}\p{N}](?:[\p{L}\p{N}-]*[\p{L}\p{N}])?\.)+[\p{L}][\p{L}\p{N}-]+)\.?(?::\d+)?(?:[/?#].*)?[\s ]*$", 1)
    return F.when(h != "", h)


DAY = 86_400_000_000
#: Stands for "any city" or "any country" in lookups of coordinates.
ANY = "\x00"


def bundles(orgs: DataFrame) -> DataFrame:
    """Rows as bundles: ``(ror_id, atlas_id, us, trust, name, homepage, address, geo, city_key, country_key)``.

    A bundle that says nothing is null; a key is empty where nothing is said. ``trust`` is 1 where as_of can't be read,
    else 2 plus the days since 1970 (2 at least).
    """
    city, country = F.when(says(F.col("city")), F.btrim("city")), F.when(says(F.col("country_code")), F.upper(F.btrim("country_code")))
    address = F.when(city.isNotNull() | country.isNotNull(), F.struct(city.alias("city"), F.when(says(F.col("region")), F.btrim("region")).alias("region"), country.alias("country_code")))
    geo = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.struct("lat", "lon"))
    us = micros(F.col("as_of"))
    return orgs.where("atlas_id is not null").select(
        ror_key(F.col("ror_id")).alias("ror_id"), "atlas_id", F.coalesce(us, F.lit(-(2**62))).alias("us"), F.coalesce(F.greatest(F.lit(0), F.floor(us / DAY)) + 2, F.lit(1)).alias("trust"),
        F.when(says(F.col("name")), F.col("name")).alias("name"), F.when(host(F.col("homepage")).isNotNull(), F.col("homepage")).alias("homepage"), address.alias("address"), geo.alias("geo"),
        F.coalesce(F.lower(city), F.lit("")).alias("city_key"), F.coalesce(country, F.lit("")).alias("country_key"),
    ).where("ror_id is not null")


def _coordinates(b: DataFrame) -> DataFrame:
    """``(ror_id, c, k, geo)``: the best coordinates of each place, and of each city and country whatever the other is."""
    place = b.where("geo is not null").groupBy("ror_id", "city_key", "country_key").agg(F.max(F.struct("us", "trust", "atlas_id", F.col("geo").alias("v"))).alias("geo"))
    keys = [F.struct(c.alias("c"), k.alias("k")) for c in (F.col("city_key"), F.lit(ANY)) for k in (F.col("country_key"), F.lit(ANY))]
    return place.select("ror_id", F.explode(F.array(*keys)).alias("x"), "geo").groupBy("ror_id", "x.c", "x.k").agg(F.max("geo").alias("geo"))


def _evaluated(branches: DataFrame, coordinates: DataFrame) -> DataFrame:
    """``branches`` with ``geo``, the best coordinates that don't contradict their place, and ``value``, the trust of both."""
    c, k = F.col("city_key"), F.col("country_key")
    cities = F.when(c == "", F.array(F.lit(ANY))).otherwise(F.array(c, F.lit("")))
    countries = F.when(k == "", F.array(F.lit(ANY))).otherwise(F.array(k, F.lit("")))
    asked = branches.select("ror_id", "city_key", "country_key", F.explode(cities).alias("c"), countries.alias("ks")).withColumn("k", F.explode("ks"))
    got = asked.join(coordinates, ["ror_id", "c", "k"]).groupBy("ror_id", "city_key", "country_key").agg(F.max("geo").alias("geo"))
    return branches.join(got, ["ror_id", "city_key", "country_key"], "left").withColumn("value", F.col("bound_address") + F.coalesce("geo.trust", F.lit(0)))


def survivors(orgs: DataFrame) -> DataFrame:
    """``(ror_id, name, name_from, homepage, homepage_from, address, address_from, geo, geo_from, keys, branches, cut)``:
    one record for each ROR id that at least two keys carry.

    ``branches`` are the places a group had to choose from, ``cut`` those never worked out. Everything is grouped maxima,
    combined map-side, so a group that holds a third of all rows is never gathered. Rows of the same instant: for an
    address the one with a region, then the greater atlas_id counts. Sources that are absent give the empty string as
    key. A group without any address is one branch without a place. Repeated rows change nothing; empty input gives no
    rows; further columns are ignored.
    """
    b = bundles(orgs)
    latest = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct("us", "atlas_id", F.col(c).alias("v")))).alias(c)
    address = F.when(F.col("address").isNotNull(), F.struct("us", F.when(F.col("address.region").isNotNull(), 1).otherwise(0).alias("full"), "atlas_id", F.col("address").alias("v"), "trust"))
    place = b.groupBy("ror_id", "city_key", "country_key").agg(
        latest("name"), latest("homepage"), F.min("atlas_id").alias("least"), F.max("atlas_id").alias("most"), F.max(address).alias("address"), F.max(F.when(F.col("geo").isNotNull(), F.col("trust"))).alias("top_geo"),
    )
    root = place.groupBy("ror_id").agg(F.max("name").alias("name"), F.max("homepage").alias("homepage"), F.min("least").alias("least"), F.max("most").alias("most"), F.max("top_geo").alias("top_geo"), F.max(F.col("address").isNotNull()).alias("placed")).where("least < most")
    worth = F.coalesce("address.trust", F.lit(0))
    branches = place.drop("top_geo", "name", "homepage").join(root.select("ror_id", "top_geo", "placed"), "ror_id").where("address is not null or not placed")
    branches = branches.select("ror_id", "city_key", "country_key", "address", worth.alias("bound_address"), (worth + F.coalesce("top_geo", F.lit(0))).alias("bound"))
    coordinates = _coordinates(b)
    first = branches.groupBy("ror_id").agg(F.max_by(F.struct("city_key", "country_key", "address", "bound_address", "bound"), F.struct("bound", "address")).alias("x"), F.count("*").alias("branches")).select("ror_id", "branches", "x.*")
    incumbent = _evaluated(first, coordinates).select("ror_id", "branches", F.col("value").alias("incumbent"))
    alive = branches.join(incumbent, "ror_id").where("bound >= incumbent")
    best = F.max(F.struct("value", F.struct("address.us", "address.full", "address.atlas_id").alias("t"), "address", "geo", "branches")).alias("c")
    chosen = _evaluated(alive, coordinates).groupBy("ror_id").agg(best, F.count("*").alias("worked")).select("ror_id", "c.address", "c.geo", "c.branches", (F.col("c.branches") - F.col("worked")).alias("cut"))
    keys = b.groupBy("ror_id").agg(F.count_distinct("atlas_id").alias("keys"))
    key = lambda c: F.coalesce(F.col(f"{c}.atlas_id"), F.lit("")).alias(f"{c}_from")
    out = root.select("ror_id", "name", "homepage").join(chosen, "ror_id").join(keys, "ror_id")
    return out.select("ror_id", *[x for c in ("name", "homepage", "address", "geo") for x in (F.col(f"{c}.v").alias(c), key(c))], "keys", "branches", "cut")
