"""Canonical rewritings of typed names of institutions and people."""

from __future__ import annotations

import re
import unicodedata

# What words of institution names are rewritten to; an empty list drops the word.
ORG_WORDS = {
    "ag": [], "an": [], "and": [], "at": [], "biosci": ["biosci"], "bioscience": ["biosci"], "biosciences": ["biosci"], "bv": [],
    "center": ["centre"], "centre": ["centre"], "centro": ["centre"], "chu": ["univ", "hosp"], "company": [], "corp": [], "corporation": [],
    "ctr": ["centre"], "da": [], "de": [], "der": [], "des": [], "di": [], "do": [], "du": [], "e": [], "el": [], "et": [], "eu": [], "fdn": ["fdn"],
    "fondation": ["fdn"], "fondazione": ["fdn"], "for": [], "forschung": ["research"], "forschungszentrum": ["research", "centre"],
    "foundation": ["fdn"], "fundacion": ["fdn"], "fur": [], "gmbh": [], "hopital": ["hosp"], "hosp": ["hosp"], "hospital": ["hosp"],
    "hospitals": ["hosp"], "in": [], "inc": [], "incorporated": [], "inst": ["inst"], "institut": ["inst"], "institute": ["inst"],
    "instituto": ["inst"], "investigacion": ["research"], "istituto": ["inst"], "klinikum": ["hosp"], "la": [], "lab": ["lab"], "labor": ["lab"],
    "laboratoire": ["lab"], "laboratories": ["lab"], "laboratorio": ["lab"], "laboratory": ["lab"], "labs": ["lab"], "le": [], "les": [],
    "limited": [], "llc": [], "ltd": [], "nacional": ["natl"], "national": ["natl"], "nationale": ["natl"], "nationales": ["natl"], "natl": ["natl"],
    "nazionale": ["natl"], "nhs": [], "of": [], "ospedale": ["hosp"], "para": [], "plc": [], "pour": [], "recherche": ["research"],
    "recherches": ["research"], "regents": [], "res": ["research"], "research": ["research"], "ricerca": ["research"], "sa": [], "sci": ["sci"],
    "science": ["sci"], "sciences": ["sci"], "srl": [], "stiftung": ["fdn"], "technical": ["tech"], "technique": ["tech"], "technische": ["tech"],
    "technol": ["tech"], "technological": ["tech"], "technologie": ["tech"], "technology": ["tech"], "tecnica": ["tech"], "tecnologia": ["tech"],
    "the": [], "trust": [], "tu": ["univ", "tech"], "u": ["univ"], "uk": [], "und": [], "uni": ["univ"], "uniklinik": ["univ", "hosp"],
    "uniklinikum": ["univ", "hosp"], "univ": ["univ"], "universidad": ["univ"], "universidade": ["univ"], "universita": ["univ"],
    "universitaet": ["univ"], "universitaetsklinikum": ["univ", "hosp"], "universitaire": ["univ"], "universitaria": ["univ"],
    "universitario": ["univ"], "universitat": ["univ"], "universitatsklinikum": ["univ", "hosp"], "universite": ["univ"], "universiteit": ["univ"],
    "university": ["univ"], "us": [], "usa": [], "y": [], "zentrum": ["centre"],
}
# First words of a unit inside an institution, as in "Department of X, University of Y".
UNITS = ("laboratory", "lab", "college", "department", "dept", "faculty", "school", "office", "division", "section", "unit", "chair", "graduate")
# Titles and degrees beside people's names.
TITLES = frozenset("dr prof professor mr mrs ms miss sir dame phd md msc mphil dphil bsc ma ba jr sr ii iii esq frs".split())
# Nicknames by given name.
SHORT_NAMES = {
    "alexander": ["alex", "sasha", "sandy", "xander", "al", "alec"], "alexandra": ["sandra", "lexi"], "andrew": ["andy", "drew"], "anthony": ["tony"],
    "antonio": ["toni", "tono"], "barbara": ["barb", "barbie"], "benjamin": ["ben", "benny"], "bjorn": ["bj"], "catherine": ["cathy", "kitty"],
    "charles": ["charlie", "chuck", "chas"], "charlotte": ["lotte", "charlie", "lottie"], "christopher": ["chris", "kit"],
    "christina": ["tina", "chris"], "daniel": ["dan", "danny"], "david": ["dave", "davey"], "deborah": ["deb", "debbie"], "dmitri": ["dima", "mitya"],
    "dorothy": ["dot", "dottie", "dolly", "dora"], "edward": ["ed", "eddie", "ned", "ted"], "eleanor": ["ellie", "nell", "nora"],
    "elizabeth": ["liz", "beth", "betty", "lizzie", "eliza", "betsy", "libby", "lisa"], "emeka": ["chukwuemeka"], "francis": ["frank", "fran"],
    "francisco": ["paco", "pancho"], "frederick": ["fred", "freddie", "fritz", "rick"], "friedrich": ["fritz"], "gabriel": ["gabe"],
    "giovanni": ["gianni", "nino", "vanni"], "giuseppe": ["beppe", "pino"], "gregory": ["greg"], "hannelore": ["hanna", "hanne", "lore", "hanni"],
    "heinrich": ["heinz"], "helen": ["nell", "nellie"], "henry": ["harry", "hank", "hal"], "ignacio": ["nacho"], "ingrid": ["inga", "inge"],
    "isabel": ["isa", "bella"], "jacob": ["jake"], "james": ["jim", "jimmy", "jamie"], "jennifer": ["jen", "jenny"], "joanna": ["jo"],
    "johann": ["hans"], "john": ["jack", "johnny", "jon"], "jonathan": ["jon"], "joseph": ["joe", "joey"], "josephine": ["josie", "jo", "fifi"],
    "jose": ["pepe"], "joshua": ["josh"], "katherine": ["kate", "kathy", "katie", "kat", "kit", "kay"], "kenneth": ["ken", "kenny"],
    "lawrence": ["larry"], "leonard": ["leo", "len", "lenny"], "ludwig": ["lutz"],
    "margaret": ["peggy", "maggie", "meg", "marge", "greta", "rita", "daisy"], "maria": ["mia"], "martha": ["patty"], "matthew": ["matt"],
    "maximilian": ["max"], "mehmet": ["memo"], "michael": ["mike", "mick", "mickey", "misha"], "mikhail": ["misha"],
    "nathaniel": ["nathan", "nate", "nat"], "nicholas": ["nick", "nicky"], "nikolai": ["kolya"], "olivia": ["liv", "livvy", "ollie"],
    "pamela": ["pam"], "patricia": ["pat", "patty", "tricia"], "patrick": ["pat", "paddy"], "penelope": ["penny", "pen", "nell"], "peter": ["pete"],
    "philip": ["phil"], "priya": ["pri"], "rebecca": ["becky", "becca"], "richard": ["rick", "dick", "rich", "richie"],
    "robert": ["bob", "rob", "bobby", "robbie", "bert"], "roberto": ["beto"], "ronald": ["ron", "ronnie"], "samantha": ["sam", "sammy"],
    "samuel": ["sam", "sammy"], "sebastian": ["seb", "bastian"], "stephen": ["steve"], "susan": ["sue", "susie", "suzy"],
    "theodore": ["ted", "theo", "teddy"], "thomas": ["tom", "tommy"], "timothy": ["tim"], "tomas": ["tom", "tomasito"], "ursula": ["uschi", "ulla"],
    "valentina": ["val"], "victor": ["vic"], "victoria": ["vicky", "tori", "vic", "vicki"], "vladimir": ["vova", "volodya"],
    "walter": ["walt", "wally"], "wilhelm": ["willi"], "william": ["bill", "will", "billy", "willy", "liam"], "xenia": ["xen"],
    "yevgenia": ["zhenya"], "yevgeny": ["zhenya"], "zachary": ["zach", "zack", "zac"],
}
NICKNAMES: dict[str, list[str]] = {}
for _full, _short in SHORT_NAMES.items():
    for _w in _short:
        NICKNAMES.setdefault(_w, []).append(_full)
GIVEN = frozenset(SHORT_NAMES)
# ISO 3166 alpha-2 codes and the ways a country is written, without blanks and accents.
COUNTRY_NAMES = {
    "AR": ["arg", "argentina"], "AT": ["aut", "austria", "osterreich"], "AU": ["aus", "australia"], "BE": ["bel", "belgium", "belgie", "belgique"],
    "BR": ["bra", "brazil", "brasil"], "CA": ["can", "canada"], "CH": ["che", "switzerland", "schweiz", "suisse", "svizzera"], "CL": ["chl", "chile"],
    "CN": ["chn", "china"], "CO": ["col", "colombia"], "CZ": ["cze", "czechia"], "DE": ["deu", "germany", "deutschland"],
    "DK": ["dnk", "denmark", "danmark"], "EG": ["egy", "egypt"], "ES": ["esp", "spain", "espana"], "FI": ["fin", "finland", "suomi"],
    "FR": ["fra", "france"], "GB": ["gbr", "uk", "greatbritain", "unitedkingdom", "england", "scotland", "wales"], "GH": ["gha", "ghana"],
    "GR": ["grc", "el", "greece"], "HU": ["hun", "hungary"], "IE": ["irl", "ireland"], "IL": ["isr", "israel"], "IN": ["ind", "india", "bharat"],
    "IT": ["ita", "italy", "italia"], "JP": ["jpn", "japan", "nippon"], "KE": ["ken", "kenya"], "KR": ["kor", "southkorea"], "MX": ["mex", "mexico"],
    "NG": ["nga", "nigeria"], "NL": ["nld", "netherlands", "thenetherlands", "holland", "nederland"], "NO": ["nor", "norway", "norge"],
    "NZ": ["nzl", "newzealand"], "PL": ["pol", "poland", "polska"], "PT": ["prt", "portugal"], "RO": ["rou", "romania"],
    "SE": ["swe", "sweden", "sverige"], "SG": ["sgp", "singapore"], "TR": ["tur", "turkey", "turkiye"], "UG": ["uga", "uganda"],
    "US": ["usa", "unitedstates", "unitedstatesofamerica", "america"], "ZA": ["zaf", "southafrica"],
}
COUNTRIES = {w: code for code, words in COUNTRY_NAMES.items() for w in [code.lower(), *words]}
STAND_IN = frozenset(("", "not stated", "n a", "na", "none", "null", "nil", "nan", "unknown", "tbd", "tba", "tbc", "not available", "not known", "not specified", "not provided", "unspecified", "to be determined", "pending", "other", "various", "test", "x", "xx", "xxx"))


def plain(text: str | None) -> str:
    """Repairs UTF-8 read as Latin-1, strips accents, keeps case."""
    if not text:
        return ""
    if "Ã" in text or "Â" in text:
        try:
            text = text.encode("cp1252").decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            pass
    text = text.replace("ß", "ss").replace("ø", "o").replace("Ø", "O").replace("ł", "l").replace("Ł", "L").replace("’", "'")
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def tokens(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text)


def country(text: str | None) -> str | None:
    """ISO alpha-2 code of a country in any of the known notations, the upper-cased letters where it is unknown."""
    k = "".join(tokens(plain(text).lower()))
    return COUNTRIES.get(k, k.upper() or None) if k and k not in STAND_IN else None


def place(text: str | None) -> str | None:
    k = " ".join(tokens(plain(text).lower()))
    return None if k in STAND_IN else k


def deletions(word: str) -> set[str]:
    """The word with any one character left out, and itself: two words one edit or swap apart share one of these."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


_NEAR: dict[str, set[str]] = {}
for _w in ORG_WORDS:
    if len(_w) >= 6:
        for _d in deletions(_w):
            _NEAR.setdefault(_d, set()).add(_w)


def edits(a: str, b: str, most: int = 2) -> int:
    """Edits (insert, delete, replace, swap of neighbours) between two words, ``most + 1`` if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    prev2: list[int] = []
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, prev2[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
        prev2, prev = prev, row
    return min(prev[-1], most + 1)


def _org_word(w: str) -> list[str]:
    if w in ORG_WORDS:
        return ORG_WORDS[w]
    if len(w) >= 6:
        near = {v for d in deletions(w) for v in _NEAR.get(d, ()) if edits(w, v, 1) == 1}
        codes = {tuple(ORG_WORDS[v]) for v in near}
        if len(codes) == 1:
            return list(codes.pop())
    return [w]


#: Codes that say what kind of institution it is, not which one.
GENERIC = frozenset("univ hosp tech inst research centre natl lab fdn biosci sci".split())


def org_forms(name: str | None, city: str | None = None) -> tuple[list[str], list[str]] | None:
    """Canonical rewritings of an institution's name and its acronyms; None where the name says nothing.

    The first rewriting is the fullest: unit inside the institution and acronym removed, words reduced to codes,
    legal forms and small words dropped, rest in alphabetical order. A further one leaves out the city. Acronyms are
    those written beside the name, the name itself if it is one, and those that the rule makes of its words
    (their initials and two more letters of one of them).
    """
    text = re.sub(r"\s+", " ", plain(name)).strip()
    if " ".join(tokens(text.lower())) in STAND_IN or not re.search(r"[^\W\d_]", text):
        return None
    acronyms: list[str] = []
    m = re.search(r"\(([^()]*)\)\s*$", text)
    if m:
        inner, rest = m[1].strip(), text[: m.start()].strip()
        initials = {w[0] for w in tokens(rest.lower())}
        if re.fullmatch(r"[A-Z]{2,8}", inner) and (rest.upper() != rest or (len(inner) <= 7 and inner[0].lower() in initials and inner[1].lower() in initials)):
            acronyms.append(inner.lower())
            text = rest
    parts = [p.strip() for p in text.split(",")]
    while len(parts) > 1 and tokens(parts[0].lower())[:1] and tokens(parts[0].lower())[0] in UNITS and re.search(r"(?i)\bof\b|\bfor\b|\bschool\b", parts[0]):
        parts = parts[1:]
    text = " ".join(parts)
    words = [w for w in tokens(re.sub(r"(?i)bio-sci", "biosci", re.sub(r"\b([A-Za-z])\.", r"\1 ", text)).lower())]
    if len(words) == 1 and re.fullmatch(r"[A-Z]{3,8}", text):
        return [], [words[0], *acronyms]
    coded = [c for w in words for c in _org_word(w)]
    if not coded:
        coded = words
    full = sorted(set(coded))
    forms = [" ".join(full)]
    where = [w for w in tokens(plain(city).lower())] if city else []
    less = [w for w in full if w not in where]
    if len(less) < len(full) and any(w not in GENERIC for w in less):
        forms.append(" ".join(less))
    said = [w for w in words if ORG_WORDS.get(w, [w]) or len(words) == 1]
    # Codes of several words ("universitatsklinikum") are spelt out; order is that of the official names.
    spelt = [c for w in said for c in _org_word(w)]
    for stem in {w for w in spelt if w not in GENERIC and len(w) > 3}:
        kind = [w for w in spelt if w != stem]
        kind = ["univ", *[w for w in kind if w != "univ"]] if "univ" in kind else [w for w in ("natl", "lab", "research", "centre", "fdn") if w in kind] or kind
        if kind[:1] != ["natl"] and "inst" in kind:
            kind = ["inst", *[w for w in kind if w != "inst"]]
        if "ltd" in words or "limited" in words:
            kind = [*kind, "ltd"]
        order = [*kind, stem] if kind == ["univ"] else [stem, *kind]
        acronyms.append("".join(w[0] for w in order) + stem[1:3])
    return forms, list(dict.fromkeys(acronyms))


def person_forms(full: str | None, first: str | None = None, last: str | None = None) -> list[tuple[str, str | None, str, str | None]]:
    """Readings of a person's name: (surname, given name or None, given initial, middle initial); empty for none.

    Nicknames are rewritten to the given name, to each where several are possible. A name whose order isn't told by a comma, capitals, initials or the other
    columns gives two readings, unless one word is a known given name and the other isn't.
    """
    text = re.sub(r"\s+", " ", plain(full)).strip()
    first, last = plain(first).strip(), plain(last).strip()
    parts = [p for p in (re.sub(r"[.]", " ", p).strip() for p in text.split(",")) if p and not all(t in TITLES for t in tokens(p.lower().replace(" ", "")))]
    split = [[t for t in re.findall(r"[^\W\d_]+(?:['-][^\W\d_]+)*", p) if t.lower() not in TITLES] for p in parts]
    split = [p for p in split if p]
    if not split:
        return []
    readings: list[tuple[list[str], list[str]]] = []
    if len(split) > 1:
        readings.append((split[0], split[1]))
    else:
        t = split[0]
        if len(t) == 1:
            return [(t[0].lower(), None, "", None)]
        shout = text.upper() == text
        if not shout and len(t[-1]) <= 3 and t[-1].isupper() and len(t) == 2 and len(t[0]) > 1:
            readings.append((t[:-1], list(t[-1])))
        elif not shout and t[0].isupper() and len(t[0]) > 2 and not t[1].isupper():
            readings.append((t[:1], t[1:]))
        elif len(t[0]) == 1:
            readings.append((t[-1:], t[:-1]))
        elif len(t[-1]) == 1:
            readings.append((t[:1], t[1:]))
        else:
            a, b = (t[-1:], t[:-1]), (t[:1], t[1:])
            known = lambda w: w.lower() in GIVEN or w.lower() in NICKNAMES
            if len(t) > 2 and len(t[1]) == 1:
                readings = [a]
            elif last and edits(last.lower(), t[0].lower(), 2) < edits(last.lower(), t[-1].lower(), 2):
                readings = [b]
            elif last or (first and edits(_given(first.lower()), _given(t[0].lower()), 1) <= 1):
                readings = [a]
            elif first and edits(_given(first.lower()), _given(t[-1].lower()), 1) <= 1:
                readings = [b]
            elif known(t[0]) and not known(t[-1]):
                readings = [a]
            elif known(t[-1]) and not known(t[0]):
                readings = [b]
            else:
                readings = [a, b]
    out = []
    for sur, giv in readings:
        surname = "".join(tokens((last if last else " ".join(sur)).lower()))
        given = giv[0].lower()
        mid = giv[1][0].lower() if len(giv) > 1 else None
        name = _given(given) if len(given) > 1 else None
        if first and len(first.rstrip(".")) > 1 and (name is None or name[0] != first[0].lower() or edits(name, _given(first.lower()), 1) <= 1):
            if given[0] == first[0].lower() or name is not None and _given(first.lower()) in (name, *NICKNAMES.get(given, ())):
                name = _given(first.lower().split()[0])
        # A nickname of several names gives a reading for each, unless the other columns settled which.
        for one in NICKNAMES.get(given, [name]) if name and name == _given(given) else [name]:
            out.append((surname, one, one[0] if one else given[0], mid))
    return list(dict.fromkeys(out))


def _given(w: str) -> str:
    w = re.sub(r"[^\w-].*", "", w)
    return NICKNAMES[w][0] if w in NICKNAMES else w
