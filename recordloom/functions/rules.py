"""Abbreviations and legal forms by country. The tables decide results and stand as they are.

A country's table adds to, and overrides, the generic one; a country without tables has the generic ones.
"""

from __future__ import annotations

LEGAL_FORMS = {
    "generic": {
        "private limited": "private limited", "pvt limited": "private limited", "pvt ltd": "private limited", "p ltd": "private limited",
        "limited": "limited", "ltd": "limited", "incorporated": "incorporated", "inc": "incorporated", "corporation": "corporation",
        "corp": "corporation", "company": "company", "co": "company", "llc": "llc", "l l c": "llc", "llp": "llp", "l l p": "llp",
        "lp": "lp", "l p": "lp", "pc": "pc", "p c": "pc", "pllc": "pllc",
    },
    "US": {
        "professional corporation": "pc", "professional limited liability company": "pllc", "doing business as": "", "d b a": "", "dba": "",
        "trading as": "", "t a": "", "f k a": "", "a k a": "",
    },
    "India": {"praaivet limited": "private limited", "praaivet limitedd": "private limited", "pra li": "private limited", "elaelapii": "llp", "pvt": "private"},
    "France": {
        "societe a responsabilite limitee": "sarl", "sarl": "sarl", "s a r l": "sarl", "societe par actions simplifiee": "sas", "sas": "sas",
        "s a s": "sas", "sasu": "sasu", "s a s u": "sasu", "societe anonyme": "sa", "sa": "sa", "s a": "sa", "eurl": "eurl", "e u r l": "eurl",
        "sci": "sci", "s c i": "sci", "snc": "snc", "s n c": "snc", "ei": "ei", "eirl": "eirl", "etablissements": "ets", "ets": "ets",
        "cie": "cie", "association": "association", "assoc": "association", "groupe": "groupe", "holding": "holding",
        "participations": "participations", "fils": "fils", "developpement": "developpement",
    },
}

NAME_ABBREVIATIONS = {
    "pvt": "private", "ltd": "limited", "corp": "corporation", "inc": "incorporated", "co": "company", "intl": "international",
    "natl": "national", "assn": "association", "dept": "department", "mfg": "manufacturing", "svcs": "services", "svc": "service",
    "grp": "group", "hldgs": "holdings", "mgmt": "management",
}

ADDRESS_ABBREVIATIONS = {
    "generic": {},
    "US": {
        "st": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "dr": "drive", "ct": "court", "ln": "lane", "rd": "road",
        "pl": "place", "cir": "circle", "pkwy": "parkway", "hwy": "highway", "trl": "trail", "ter": "terrace", "cv": "cove", "sq": "square",
        "aly": "alley", "apt": "apartment", "ste": "suite", "fl": "floor", "bldg": "building", "n": "north", "s": "south", "e": "east",
        "w": "west", "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest",
    },
    "India": {"rd": "road", "st": "street", "nr": "near", "opp": "opposite", "hno": "", "dist": "district", "ngr": "nagar", "sec": "sector"},
    "France": {
        "r": "rue", "av": "avenue", "bd": "boulevard", "pl": "place", "ch": "chemin", "imp": "impasse", "all": "allee", "rte": "route",
        "fbg": "faubourg", "qu": "quai", "q": "quai", "crs": "cours", "espl": "esplanade", "allees": "allee",
    },
}

STRIP_PREFIXES = ("the", "shri", "sri", "smt", "dr", "mr", "mrs", "ms")

NON_HOUSE_MARKERS = {
    "generic": ("sector", "block", "phase", "ward", "stage", "lane", "cross", "main", "zone", "pocket", "part", "wing", "tower", "floor", "fl", "apt", "apartment", "suite", "ste", "unit", "flat"),
    "India": ("sector", "block", "phase", "ward", "stage", "lane", "cross", "main", "zone", "pocket", "part", "wing", "tower", "floor", "fl"),
}
FALLBACK_NON_HOUSE = ("sector", "block", "phase", "ward", "stage", "lane", "apt", "apartment", "suite", "ste", "unit")
NULL_LIKE = ("", "null", "n/a", "na", "none")

#: Letters to letters in phonetic skeletons, applied in this order.
PHONETIC = (("chh", "c"), ("sh", "s"), ("v", "w"), ("ph", "f"), ("ck", "k"), ("ee", "i"), ("oo", "u"), ("th", "t"), ("aa", "a"), ("gh", "g"), ("bh", "b"), ("dh", "d"), ("kh", "k"), ("ch", "c"))

SCRIPTS = (("Devanagari", "\\u0900-\\u097F"), ("Bengali", "\\u0980-\\u09FF"), ("Gurmukhi", "\\u0A00-\\u0A7F"), ("Gujarati", "\\u0A80-\\u0AFF"), ("Odia", "\\u0B00-\\u0B7F"), ("Tamil", "\\u0B80-\\u0BFF"), ("Telugu", "\\u0C00-\\u0C7F"), ("Kannada", "\\u0C80-\\u0CFF"), ("Malayalam", "\\u0D00-\\u0D7F"))
LATIN = "\\u0000-\\u024F\\u1E00-\\u1EFF"


def merged(tables: dict[str, dict[str, str]], country: str) -> dict[str, str]:
    return tables["generic"] | tables.get(country, {})


def non_house_markers(country: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(NON_HOUSE_MARKERS["generic"] + NON_HOUSE_MARKERS.get(country, ())))


#: Countries with tables of their own.
COUNTRIES = ("US", "India", "France")
