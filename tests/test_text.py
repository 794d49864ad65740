"""Normalisation: worked cases, and the Column functions against plain Python."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from kithlink.functions import lexicon, text
from kithlink.operators.normalize import normalize_records

SCHEMA = "entity_id string, business_name string, business_address string, country string"


def views(spark, name=None, address=None, country=None):
    return normalize_records(spark.createDataFrame([("S1-1", name, address, country)], SCHEMA)).first().asDict()


@pytest.mark.parametrize("name, core, legal", [
    ("Société l'Église SARL", "societe eglise", "sarl"),
    ("Acme Incorporated", "acme", "inc"),
    ("Rao Pharma (P) Ltd", "rao pharmaceutical", "ltd pvt"),
    ("M/s Sharma Traders", "sharma trader", ""),
    ("Messrs. Sharma & Sons", "sharma sons", ""),
    ("The Company Ltd", "co ltd", "co ltd"),
    ("L.L.C. Holdings", "llc holding", ""),
    ("NA Traders", "na trader", ""),
    ("Joe's Groß Café", "joes gross cafe", ""),
])
def test_names(spark, name, core, legal):
    found = views(spark, name)
    assert (found["name_core"], found["name_legal"]) == (core, legal)


@pytest.mark.parametrize("value", [None, "", " ", "NA", "n/a", " Unknown ", "--", "nil"])
def test_missing(spark, value):
    found = views(spark, value, value, value)
    assert found["name_missing"] and found["addr_missing"] and found["name_tokens"] == [] and found["country_norm"] == ""


def test_alternates_and_acronym(spark):
    found = views(spark, "Blue Sky LLC d/b/a Sky Cafe")
    assert found["name_alts"] == ["blue sky", "sky cafe"] and found["name_acronym"] == "bssc"
    assert views(spark, "Foo (Bar Baz)")["name_alts"] == ["foo", "bar baz"]
    assert views(spark, "Foo (Bar)")["name_alts"] == []
    assert views(spark, "International Business Machines")["name_acronym"] == "ibm"


def test_addresses(spark):
    found = views(spark, "x", "4th Floor, M.G. Road, Shivajinagar, Bangalore 560 034")
    assert found["addr_postal"] == ["560034"] and found["addr_house"] == "4" and "shivaji" in found["addr_tokens"]
    assert found["addr_tail"] == ["bangalore", "nagar", "shivaji"]
    found = views(spark, "x", "12 Rue de la Paix, 75008 Paris CEDEX")
    assert found["addr_postal"] == ["75008"] and "cedex" not in found["addr_tokens"] and found["addr_house"] == "12"
    assert views(spark, "x", "Nr. City Mall, Opp. Bank")["addr_landmark"] is True


@pytest.mark.parametrize("token, want", [
    ("agarwal", "agrl"), ("aggarwal", "agrl"), ("agrawal", "agrl"), ("lakshmi", "lksm"), ("laxmi", "lksm"), ("shree", "sr"), ("sri", "sr"), ("123", "123"), ("", ""),
])
def test_skeleton(spark, token, want):
    assert spark.range(1).select(text.skeleton(F.lit(token))).first()[0] == want


def test_fold_against_python(spark):
    samples = ["Łódź ŒUVRE ﬁn", "Ǆ ½ ①", "Ａｂｃ＆", "naïve ÿ", "İstanbul ı", "`x´", "Привет Ёж", "ﬀ Ⅷ"]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in samples], "s string").select(text.fold_exact(F.col("s"))).collect()]
    assert got == [lexicon.folded(s) for s in samples]
    latin = ["Łódź ŒUVRE", "naïve ÿ ß æ", "Ñandú Ăâ Ệ", "Привет Ёж"]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in latin], "s string").select(text.fold(F.col("s"))).collect()]
    assert got == [lexicon.folded(s) for s in latin]


def brute_grams(s, low=3, high=4):
    out = []
    for w in s.split():
        padded = f" {w} "
        for n in range(low, high + 1):
            grams = [padded[i : i + n] for i in range(len(padded) - n + 1)] or ([padded] if n == low else [])
            out += grams
    return sorted(out)


def test_char_grams(spark):
    samples = ["a", "ab abc", "hello world", "", "x yz"]
    rows = spark.createDataFrame([(s,) for s in samples], "s string").select("s", text.char_grams(F.col("s")).alias("g")).collect()
    for r in rows:
        assert sorted(r["g"]) == brute_grams(r["s"])


def test_merge_initials_and_tokens(spark):
    one = lambda s: spark.range(1).select(text.tokenize(F.lit(s))).first()[0]
    assert one("m g road") == ["mg", "road"] and one("l l c") == ["llc"] and one("a&b") == ["a", "and", "b"]
    assert one("221b baker") == ["221", "b", "baker"] and one("qu'il d'or") == ["qu", "il", "d", "or"]


def test_combining_marks_of_class_zero_stay():
    mark = next(chr(i) for i in range(0x300, 0x3000) if unicodedata.category(chr(i)).startswith("M") and not unicodedata.combining(chr(i)))
    assert mark in lexicon.folded("a" + mark)


def test_lexicon_is_consistent():
    assert re.compile(lexicon.DOING_BUSINESS_AS) and set(lexicon.legal_forms()) <= set(lexicon.name_variants().values())
