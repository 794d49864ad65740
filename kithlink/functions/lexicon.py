"""Word lists of the normaliser."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

# Results depend on these lists word for word. The tables map a canonical form to its variants.

#: Values that stand for a missing text, trimmed and lower-cased.
MISSING = ("", "nan", "none", "null", "na", "n/a", "n.a", "n.a.", "-", "--", "?", "unknown", "not available", "not applicable", "nil")

#: Legal forms; they leave a name only from its end.
LEGAL = {
    "inc": ("inc", "incorporated", "incorp"),
    "corp": ("corp", "corporation", "corpn"),
    "co": ("co", "company", "cos", "cie", "compagnie"),
    "ltd": ("ltd", "limited", "ltda"),
    "llc": ("llc", "lc"),
    "llp": ("llp",),
    "lp": ("lp",),
    "plc": ("plc",),
    "pllc": ("pllc",),
    "pc": ("pc",),
    "pvt": ("pvt", "private", "pte", "prvt", "p"),
    "opc": ("opc",),
    "gmbh": ("gmbh",),
    "ag": ("ag",),
    "kg": ("kg",),
    "bv": ("bv",),
    "nv": ("nv",),
    "srl": ("srl",),
    "spa": ("spa",),
    "sarl": ("sarl",),
    "sas": ("sas",),
    "sasu": ("sasu",),
    "sa": ("sa",),
    "eurl": ("eurl",),
    "snc": ("snc",),
    "sci": ("sci",),
    "selarl": ("selarl",),
    "scp": ("scp",),
    "pty": ("pty",),
}

#: Business words.
BUSINESS = {
    "international": ("intl", "internatl"),
    "manufacturing": ("mfg",),
    "manufacturers": ("mfrs",),
    "manufacturer": ("mfr",),
    "services": ("svc", "svcs", "srvcs", "servs"),
    "associates": ("assoc", "assocs"),
    "brothers": ("bros",),
    "national": ("natl",),
    "management": ("mgmt", "mgt"),
    "department": ("dept",),
    "university": ("univ",),
    "hospital": ("hosp",),
    "center": ("ctr", "centre", "cntr"),
    "group": ("grp",),
    "systems": ("sys",),
    "technologies": ("tech", "techs", "technology"),
    "solutions": ("soln", "solns"),
    "enterprises": ("ent", "ents", "entp"),
    "industries": ("ind", "inds"),
    "engineering": ("engg", "engr"),
    "pharmaceuticals": ("pharma", "pharmaceutical"),
    "laboratories": ("labs", "lab", "laboratory"),
    "marketing": ("mktg",),
    "distributors": ("distr", "distrib"),
    "construction": ("constr", "const"),
    "medical": ("med",),
    "jewellers": ("jewelers", "jeweler", "jeweller"),
    "sri": ("shree", "shri", "sree", "shre"),
    "restaurant": ("restaurants", "rest"),
    "holdings": ("hldgs", "hldg"),
    "investments": ("invts", "inv"),
    "financial": ("fin", "finl"),
    "agency": ("agcy",),
    "insurance": ("ins",),
    "trading": ("trdg", "trd"),
    "builders": ("bldrs",),
}

NAME_STOP = ("the", "and", "of", "et", "de", "la", "le", "les", "du", "des", "d", "l", "a", "an", "und", "for", "at", "in", "on", "by")
NAME_LEADING = ("ms", "messrs", "mr", "mrs", "the")

#: Address words.
STREET = {
    "st": ("street", "str", "saint"),
    "ste": ("suite", "sainte"),
    "rd": ("road", "marg"),
    "ave": ("avenue", "av", "aven"),
    "blvd": ("boulevard", "bd", "bld", "boul", "bvd"),
    "dr": ("drive",),
    "ln": ("lane",),
    "ct": ("court", "crt"),
    "pl": ("place",),
    "plz": ("plaza",),
    "sq": ("square",),
    "hwy": ("highway", "hiway"),
    "pkwy": ("parkway",),
    "cir": ("circle",),
    "fl": ("floor", "flr"),
    "bldg": ("building", "bldng"),
    "apt": ("apartment", "appt"),
    "nr": ("near",),
    "opp": ("opposite", "opst"),
    "bhd": ("behind",),
    "bsd": ("beside", "besides"),
    "adj": ("adjacent",),
    "n": ("north",),
    "s": ("south",),
    "e": ("east",),
    "w": ("west",),
    "ne": ("northeast",),
    "nw": ("northwest",),
    "se": ("southeast",),
    "sw": ("southwest",),
    "sec": ("sector",),
    "ph": ("phase",),
    "dist": ("district", "distt"),
    "bazar": ("bazaar",),
    "chowk": ("chauk",),
    "nagar": ("ngr",),
    "colony": ("col",),
    "ch": ("chemin",),
    "all": ("allee",),
    "imp": ("impasse",),
    "rte": ("route",),
    "fbg": ("faubourg",),
    "mt": ("mount",),
    "ft": ("fort",),
    "ctr": ("center", "centre", "cntr"),
    "gali": ("galli",),
    "taluk": ("taluka", "tq"),
    "no": ("number", "num", "nos", "hno"),
    "rue": ("r",),
}

ADDRESS_DROP = ("cedex",)
ADDRESS_STOP = (
    "no", "plot", "shop", "house", "h", "flat", "door", "unit", "ste", "apt", "fl", "bldg", "the", "of", "and", "et", "de", "la", "le",
    "les", "du", "des", "d", "l", "at", "in", "on", "nr", "opp", "bhd", "bsd", "adj", "next", "to", "facing",
)
LANDMARKS = ("nr", "opp", "bhd", "bsd", "adj", "facing")
COMPOUNDS = ("nagar",)

#: Characters that are replaced before decomposition.
SPECIAL = {
    "ß": "ss", "æ": "ae", "Æ": "ae", "œ": "oe", "Œ": "oe", "ø": "o", "Ø": "o", "đ": "d", "Đ": "d", "ł": "l", "Ł": "l", "ı": "i", "þ": "th",
    "’": "'", "‘": "'", "`": "'", "´": "'", "ʼ": "'", "–": "-", "—": "-", "‐": "-", "‑": "-", "＆": "&",
}

#: Sound rules, applied in this order.
SOUNDS = (("ph", "f"), ("ck", "k"), ("q", "k"), ("x", "ks"), ("z", "s"), ("v", "w"), ("c", "k"), ("ee", "i"), ("oo", "u"))

#: Phrases between a name and another name of the same business, as a regular expression.
DOING_BUSINESS_AS = (
    r"d ?/ ?b ?/ ?a|d b a|dba|doing business as|trading as|t ?/ ?a|a ?/ ?k ?/ ?a|aka|f ?/ ?k ?/ ?a|fka|formerly known as|formerly"
)

# End of the fixed values.


def variants(table: dict[str, tuple[str, ...]]) -> dict[str, str]:
    """Variant to canonical form."""
    return {word: canonical for canonical, words in table.items() for word in words}


def legal_forms() -> tuple[str, ...]:
    return tuple(LEGAL)


def name_variants() -> dict[str, str]:
    return variants(BUSINESS) | variants(LEGAL)


def folded(text: str) -> str:
    """Compatibility decomposition without combining marks, in lower case."""
    text = unicodedata.normalize("NFKD", "".join(SPECIAL.get(c, c) for c in text))
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


@lru_cache(1)
def fold_table() -> tuple[str, str, dict[str, str]]:
    """Built from ``folded`` for the basic plane but Hangul: characters with one-character foldings (or none, at the end), these, and the Latin ones with longer foldings."""
    single, gone, longer = {}, [], {}
    for i in range(0x80, 0x10000):
        c = chr(i)
        if 0xD800 <= i < 0xE000 or 0xAC00 <= i < 0xD7B0:
            continue
        to = folded(c)
        if to == c:
            continue
        if not to:
            gone.append(c)
        elif len(to) == 1:
            single[c] = to
        elif i < 0x250 or 0x1E00 <= i < 0x1F00 or 0xFB00 <= i < 0xFB07:
            longer[c] = to
    single |= {"`": "'"}
    return "".join(single) + "".join(gone), "".join(single.values()), longer
