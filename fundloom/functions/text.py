"""Names, award numbers and markup as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundloom.functions.keys import strip

# Words that don't tell institutions apart.
STOPWORDS = "the of and for de di der des du la le el y e den das und fur von van ltd limited inc incorporated llc plc gmbh ag sa spa srl bv nv co corp corporation company group".split()
# Academic abbreviations and what they stand for.
ABBREVIATIONS = {
    "agri": "agricultural", "agric": "agricultural", "assn": "association", "cntr": "center", "coll": "college", "ctr": "center", "ctrs": "centers", "dept": "department", "div": "division", "eng": "engineering",
    "engr": "engineering", "fdn": "foundation", "found": "foundation", "hlth": "health", "hosp": "hospital", "inst": "institute", "insts": "institutes", "int": "international", "intl": "international", "lab": "laboratory",
    "labs": "laboratories", "mech": "mechanical", "med": "medical", "mgmt": "management", "nat": "national", "natl": "national", "polytech": "polytechnic", "res": "research", "sci": "science", "scis": "sciences",
    "soc": "society", "tech": "technology", "technol": "technology", "univ": "university",
}
UMBRELLA = ("system", "consortium", "network")


def _latin() -> tuple[str, str]:
    """Every accented letter up to U+024F and U+1E00-1EFF whose decomposition begins with a plain letter."""
    pairs = [(chr(i), d[0]) for i in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)] if len(d := unicodedata.normalize("NFKD", chr(i))) > 1 and d[0].isascii() and d[0].isalpha() and all(unicodedata.combining(x) for x in d[1:])]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_FROM, _TO = _latin()


def strip_accents(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, _FROM, _TO), r"\p{M}+", "")


def normalize_name(c: Column) -> Column:
    """Lower case without accents, ``&`` as and, anything but letters, digits and blanks as a blank; null gives ''."""
    s = F.replace(F.lower(strip_accents(F.coalesce(c, F.lit("")))), F.lit("&"), F.lit(" and "))
    return F.btrim(F.regexp_replace(F.regexp_replace(s, "[^a-z0-9 ]+", " "), " +", " "))


def expand_abbreviations(norm: Column) -> Column:
    """Abbreviations spelt out, word by word, in names of two words or more."""
    m = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    words = F.split(norm, " ")
    return F.when(F.size(words) >= 2, F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(m, w), w)), " ")).otherwise(norm)


def name_tokens(norm: Column) -> Column:
    """Distinct words of two letters or more that tell, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.split(norm, " "), lambda w: (F.length(w) > 1) & ~w.isin(STOPWORDS))))


def canon_country(c: Column) -> Column:
    k = F.upper(strip(c))
    return F.nullif(F.when(k == "EL", "GR").when(k == "UK", "GB").otherwise(k), F.lit(""))


def compact(c: Column) -> Column:
    return F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9]", "")


def longest_digits(c: Column) -> Column:
    """The longest run of three digits or more, the first of several; null for none."""
    runs = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\d{3,}"), F.lit(0))
    return F.aggregate(runs, F.lit(None).cast("string"), lambda best, r: F.when(best.isNull() | (F.length(r) > F.length(best)), r).otherwise(best))


# The parts of an award number of the National Institutes of Health, as its grants guide names them: application type,
# activity code, institute code, serial number, year of support, amendment or supplement.
_TYPE, _ACTIVITY, _INSTITUTE, _SERIAL, _YEAR, _AMENDED = "[0-9]?", "([A-Z]{1,3}[0-9]{2})", "([A-Z]{2})", "([0-9]{4,7})", r"(?:[-\s]?[0-9]{1,2})?", "(?:[A-Z][0-9]+)?"
_GAP = r"\s*"
_NIH_WHOLE = f"^{_TYPE}{_ACTIVITY}{_GAP}{_INSTITUTE}{_GAP}{_SERIAL}{_YEAR}{_AMENDED}$"
_NIH_CORE = f"^{_INSTITUTE}{_GAP}{_SERIAL}$"


def nih_keys(c: Column) -> Column:
    """Institute with serial number, with and without activity code, where the award number has that form."""
    s = F.upper(strip(F.coalesce(c, F.lit(""))))
    act, ic, serial = (F.regexp_extract(s, _NIH_WHOLE, i) for i in (1, 2, 3))
    bare = F.concat(F.regexp_extract(s, _NIH_CORE, 1), F.regexp_extract(s, _NIH_CORE, 2))
    return F.when(serial != "", F.array(F.concat(ic, serial), F.concat(act, ic, serial))).when(bare != "", F.array(bare)).otherwise(F.array().cast("array<string>"))


def award_keys(source: Column, award: Column) -> Column:
    """All keys by which an award number can meet a grant's number, sorted; empty for a blank number."""
    a, src = strip(F.coalesce(award, F.lit(""))), F.lower(F.coalesce(source, F.lit("")))
    key, digits = compact(a), longest_digits(a)
    plain = F.when(key != "", F.array(key)).otherwise(F.array().cast("array<string>"))
    more = (
        F.when(src == "nih", F.transform(nih_keys(a), lambda k: F.concat(F.lit("NIH:"), k)))
        .when(src.isin("nsf", "cordis", "ec") & digits.isNotNull(), F.array(F.concat(F.upper(src), F.lit(":"), digits), digits))
        .when(src == "ukri", F.array(F.concat(F.lit("UKRI:"), key)))
        .otherwise(F.array().cast("array<string>"))
    )
    return F.when(a == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(F.concat(plain, more))))


def last_segment(c: Column) -> Column:
    """What follows the last slash of an id written as a URL."""
    return F.nullif(F.element_at(F.split(F.regexp_replace(strip(c), "/+$", ""), "/"), -1), F.lit(""))


def html_text(c: Column) -> Column:
    """Markup without tags, common entities decoded, blanks collapsed."""
    s = F.regexp_replace(c, "<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&rsquo;", "’"), ("&ndash;", "–"), ("&mdash;", "—"), ("&amp;", "&")):
        s = F.replace(s, F.lit(entity), F.lit(char))
    return F.btrim(F.regexp_replace(s, r"[\s ]+", " "))


def inverted_abstract(c: Column) -> Column:
    """Text from JSON ``{word: [positions]}``; null for null, empty or unreadable input."""
    m = F.from_json(c, "map<string, array<int>>")
    at = F.flatten(F.transform(F.map_entries(m), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.nullif(F.array_join(F.transform(F.array_sort(at), lambda x: x["w"]), " "), F.lit(""))


def title_and_abstract(title: Column, abstract: Column) -> Column:
    """The text that is ranked: title, a full stop, abstract; null where both are."""
    return F.nullif(F.btrim(F.concat(F.coalesce(title, F.lit("")), F.lit(". "), F.coalesce(abstract, F.lit("")))), F.lit("."))


def shortened(c: Column, most: int = 600) -> Column:
    return F.substring(c, 1, most)


def tokenize(c: Column) -> Column:
    """Words for ranking: a letter, then letters, digits or hyphens, in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[a-z][a-z0-9\-]+"), F.lit(0))


# Fixed value: what an address looks like, local part and domain.
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"


def plausible_email(c: Column) -> Column:
    return F.coalesce(c.rlike(f"^{EMAIL}$"), F.lit(False))


# Titles and degrees that aren't part of a name.
TITLES = "dr prof professor mr mrs ms sir dame jr sr phd md ii iii iv".split()


def name_parts(full: Column, first: Column, last: Column) -> Column:
    """``struct(surname, given array, initial)`` of a person's name, null where it can't be told.

    Given and family name columns come first; then "Last, First"; then the last word is the surname. Titles and degrees
    drop out. More than one comma, or a name without a word, is refused.
    """
    norm = lambda c: F.btrim(F.regexp_replace(F.regexp_replace(F.lower(strip_accents(c)), r"[^a-z0-9, ]+", " "), " +", " "))
    words = lambda c: F.filter(F.split(F.regexp_replace(c, ",", " "), " +"), lambda w: (w != "") & ~w.isin(TITLES))
    f, l, t = words(norm(first)), words(norm(last)), F.regexp_replace(norm(full), r", *(phd|md|jr|sr|ii|iii|iv)\b", "")
    parts = F.split(t, ",")
    sized = lambda a: F.coalesce(F.size(a), F.lit(0))
    side = lambda i: words(F.coalesce(F.get(parts, F.lit(i)), F.lit("")))
    whole = words(t)
    build = lambda sur, given: F.struct(sur.alias("surname"), given.alias("given"), F.substring(F.coalesce(F.get(given, F.lit(0)), F.lit("")), 1, 1).alias("initial"))
    return (
        F.when(sized(l) > 0, build(F.array_join(l, " "), F.coalesce(f, F.array().cast("array<string>"))))
        .when(sized(parts) > 2, F.lit(None))
        .when((sized(parts) == 2) & (sized(side(0)) > 0), build(F.array_join(side(0), " "), side(1)))
        .when(sized(whole) > 0, build(F.element_at(whole, -1), F.slice(whole, F.lit(1), F.greatest(F.lit(0), F.size(whole) - 1))))
    )
