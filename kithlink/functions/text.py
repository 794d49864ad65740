"""Text normalisation as Column functions: nothing here leaves the JVM but ``fold_exact``.

Character classes are spelled out (``\\p{L}``, ``\\p{N}``), because Java's ``\\w`` is ASCII only.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import lexicon

LETTER = r"[\p{L}\p{Nl}\p{No}]"  # a word character that is neither a decimal digit nor an underscore
WORD = r"\p{L}\p{N}_"
START, END = rf"(?<![{WORD}])", rf"(?![{WORD}])"
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"


def strip(text: Column) -> Column:
    """Without blanks of any kind at both ends."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def _map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def _mapped(table: Column, token: Column) -> Column:
    return F.coalesce(F.try_element_at(table, token), token)


def is_missing(text: Column) -> Column:
    """Whether the text is null or a placeholder."""
    return F.coalesce(F.lower(strip(text)).isin(*lexicon.MISSING), F.lit(True))


def fold(text: Column) -> Column:
    """Lower case without accents and compatibility forms; a missing text becomes empty. Covers the basic plane but Hangul syllables and non-Latin ligatures; see ``fold_exact``."""
    source, target, longer = lexicon.fold_table()
    out = text
    for c, to in longer.items():
        out = F.replace(out, F.lit(c), F.lit(to))
    return F.when(is_missing(text), "").otherwise(F.lower(F.translate(out, source, target)))


@F.pandas_udf(StringType())
def _fold_exact(text: pd.Series) -> pd.Series:
    return text.map(lambda x: "" if x is None else lexicon.folded(x))


def fold_exact(text: Column) -> Column:
    """``fold`` for every script, in Arrow batches."""
    return F.when(is_missing(text), "").otherwise(_fold_exact(text))


def merge_initials(text: Column) -> Column:
    """Joins runs of single letters in a text of tokens with one blank between them."""
    return F.regexp_replace(text, r"(?<=(?:^| )\p{L}) (?=\p{L}(?: |$))", "")


def _elision(text: Column) -> Column:
    return F.regexp_replace(text, rf"{START}(l|d|qu)'", "$1 ")


def token_text(folded: Column) -> Column:
    """The tokens of a folded text, with one blank between them."""
    out = F.replace(F.replace(_elision(folded), F.lit("'"), F.lit("")), F.lit("&"), F.lit(" and "))
    out = F.regexp_replace(out, r"[^\p{L}\p{N}]+", " ")
    out = F.regexp_replace(out, rf"(?<={LETTER})(?=\p{{Nd}})|(?<=\p{{Nd}})(?={LETTER})", " ")
    return merge_initials(F.trim(out))


def words(text: Column) -> Column:
    """Parts between single blanks, without empty ones."""
    return F.filter(F.split(text, " "), lambda t: t != "")


def tokenize(folded: Column) -> Column:
    return words(token_text(folded))


def stem(token: Column) -> Column:
    """Light plural folding."""
    long = F.length(token) > 4
    return (
        F.when(long & token.endswith("ies"), F.concat(token.substr(F.lit(1), F.length(token) - 3), F.lit("y")))
        .when(long & token.endswith("s") & ~token.endswith("ss") & ~token.endswith("us") & ~token.endswith("is"), token.substr(F.lit(1), F.length(token) - 1))
        .otherwise(token)
    )


def skeleton(token: Column) -> Column:
    """Sound key: the first character, then consonants without repeats; digits stay as they are."""
    out = token
    for a, b in lexicon.SOUNDS:
        out = F.replace(out, F.lit(a), F.lit(b))
    rest = F.regexp_replace(out.substr(F.lit(2), F.length(out)), "[aeiouyhw]", "")
    return F.when(token.rlike(r"^\p{Nd}*$"), token).otherwise(F.regexp_replace(F.concat(out.substr(1, 1), rest), r"(.)\1+", "$1"))


def canonical_name(tokens: Column) -> Column:
    table = _map(lexicon.name_variants())
    return F.transform(tokens, lambda t: _mapped(table, t))


def _alternatives(parts) -> str:
    return "|".join(sorted(parts))


def core_and_legal(tokens: Column) -> Column:
    """(core, legal) of canonical tokens: leading honorifics and the trailing run of legal forms and stop words go, stop words go, the rest is stemmed."""
    legal = lexicon.legal_forms()
    text = F.regexp_replace(F.array_join(tokens, " "), rf"^(?:(?:{_alternatives(lexicon.NAME_LEADING)})(?: |$))+", "")
    kept = F.regexp_replace(text, rf"(?:(?:^| )(?:{_alternatives({*legal, *lexicon.NAME_STOP})}))+$", "")
    peeled = words(text.substr(F.length(kept) + 1, F.length(text)))
    stems = lambda array: F.transform(F.filter(array, lambda t: ~t.isin(*lexicon.NAME_STOP)), stem)
    core, whole = stems(words(kept)), stems(tokens)
    return F.struct(
        F.when(F.size(core) > 0, core).when(F.size(whole) > 0, whole).otherwise(tokens).alias("core"),
        F.filter(peeled, lambda t: t.isin(*legal)).alias("legal"))


def name_parts(folded: Column) -> Column:
    """The parts of a name: what stands around phrases like "doing business as", then the parentheses of two tokens or more."""
    text = F.replace(F.replace(_elision(folded), F.lit("'"), F.lit("")), F.lit("&"), F.lit(" and "))
    inner = F.filter(F.regexp_extract_all(text, F.lit(r"\(([^()]*)\)"), F.lit(1)), lambda p: F.size(tokenize(p)) >= 2)
    main = F.aggregate(inner, text, lambda acc, p: F.replace(acc, F.concat(F.lit("("), p, F.lit(")")), F.lit(" ")))
    main = F.regexp_replace(main, rf"[^{WORD}/]+", " ")
    around = F.filter(F.split(main, rf"{START}(?:{lexicon.DOING_BUSINESS_AS}){END}"), lambda p: F.trim(p) != "")
    return F.concat(around, inner)


def normalize_name(folded: Column) -> Column:
    """A struct of the views of a folded name."""
    tokens = F.filter(F.transform(name_parts(folded), lambda p: canonical_name(tokenize(p))), lambda ts: F.size(ts) > 0)
    parts = F.transform(tokens, lambda ts: F.struct(ts.alias("clean"), core_and_legal(ts).alias("cl")))

    def views(p: Column) -> Column:
        cores = F.transform(p, lambda x: x["cl"]["core"])
        core = F.flatten(cores)
        initials = F.transform(core, lambda t: F.when(t.rlike(r"^\p{L}"), t.substr(1, 1)).otherwise(""))
        return F.struct(
            F.array_join(F.flatten(F.transform(p, lambda x: x["clean"])), " ").alias("name_clean"),
            F.array_join(core, " ").alias("name_core"),
            core.alias("name_tokens"),
            F.transform(core, skeleton).alias("name_skel"),
            F.array_join(core, "").alias("name_nospace"),
            F.when(F.size(core) >= 2, F.array_join(initials, "")).otherwise("").alias("name_acronym"),
            F.array_join(F.array_sort(F.array_distinct(F.flatten(F.transform(p, lambda x: x["cl"]["legal"])))), " ").alias("name_legal"),
            F.when(F.size(p) > 1, F.transform(cores, lambda c: F.array_join(c, " "))).otherwise(F.array().cast("array<string>")).alias("name_alts"),
            (F.size(p) == 0).alias("name_missing"))

    # bound to one variable, so that the parts are computed once
    return F.transform(F.array(parts), views)[0]


def canonical_address(tokens: Column) -> Column:
    table = _map(lexicon.variants(lexicon.STREET))
    known = F.filter(F.transform(tokens, lambda t: _mapped(table, t)), lambda t: ~t.isin(*lexicon.ADDRESS_DROP))

    def split(token: Column) -> Column:
        out = F.array(token)
        for suffix in lexicon.COMPOUNDS:
            n = len(suffix)
            out = F.when(token.endswith(suffix) & (F.length(token) > n + 2), F.array(token.substr(F.lit(1), F.length(token) - n), F.lit(suffix))).otherwise(out)
        return out

    return F.flatten(F.transform(known, split))


def _digits(token: Column) -> Column:
    return token.rlike(r"^\p{Nd}+$")


def normalize_address(folded: Column) -> Column:
    """A struct of the views of a folded address."""
    text = F.regexp_replace(folded, rf"(?<!\p{{Nd}})(\p{{Nd}}{{3}})[\s\p{{Z}}-]+(\p{{Nd}}{{3}})[^{WORD}]*$", "$1$2")
    text = F.regexp_replace(text, rf"{START}(\p{{Nd}}+)(?:st|nd|rd|th|er|ere|eme|ieme|e){END}", "$1")
    pieces = F.filter(F.split(text, r"[,;|\n]+"), lambda c: strip(c) != "")
    components = F.transform(pieces, lambda c: canonical_address(tokenize(c)))

    def views(parts: Column) -> Column:
        tokens = F.flatten(parts)
        numbers = F.filter(tokens, _digits)
        postal = F.array_sort(F.array_distinct(F.filter(numbers, lambda t: F.length(t).between(5, 6))))
        core = F.filter(tokens, lambda t: ~t.isin(*lexicon.ADDRESS_STOP))
        named = F.filter(F.transform(parts, lambda p: F.filter(p, lambda t: ~_digits(t) & ~t.isin(*lexicon.ADDRESS_STOP))), lambda p: F.size(p) > 0)
        last = F.flatten(F.slice(named, F.greatest(F.size(named) - 1, F.lit(1)), F.lit(2)))
        return F.struct(
            F.array_join(tokens, " ").alias("addr_clean"),
            F.array_join(core, " ").alias("addr_core"),
            core.alias("addr_tokens"),
            numbers.alias("addr_numbers"),
            postal.alias("addr_postal"),
            F.coalesce(F.get(F.filter(numbers, lambda t: ~F.length(t).between(5, 6)), F.lit(0)), F.lit("")).alias("addr_house"),
            F.array_sort(F.array_distinct(last)).alias("addr_tail"),
            F.exists(tokens, lambda t: t.isin(*lexicon.LANDMARKS)).alias("addr_landmark"),
            (F.size(tokens) == 0).alias("addr_missing"))

    return F.transform(F.array(components), views)[0]


def normalize_country(folded: Column) -> Column:
    return merge_initials(F.trim(F.regexp_replace(folded, r"[^\p{L}\p{N}]+", " ")))


def id_list(text: Column) -> Column:
    """The ids of a comma-separated list."""
    return F.filter(F.transform(F.split(text, ","), strip), lambda x: x != "")


def country_label(text: Column) -> Column:
    return F.when(is_missing(text), "<missing>").otherwise(text)


def cardinality_bucket(n: Column) -> Column:
    return F.when(n >= 3, "3+").otherwise(n.cast("string"))


def char_grams(text: Column, low: int = 3, high: int = 4) -> Column:
    """Character n-grams of each word with a blank on both sides; a short word gives one gram of its whole length."""

    def of_word(w: Column) -> Column:
        padded = F.concat(F.lit(" "), w, F.lit(" "))
        size = F.length(padded)

        def of_length(n: int) -> Column:
            grams = F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: padded.substr(i, F.lit(n)))
            return grams if n == low else F.when(size >= n, grams).otherwise(F.array().cast("array<string>"))

        return F.concat(*[of_length(n) for n in range(low, high + 1)])

    return F.flatten(F.transform(words(text), of_word))
