"""URL filter: pattern rules indexed by their rarest literal token.

Every rule is a regular expression over host, path and query, joined, together with the complete tokens (runs of
letters and digits) that any matching URL must hold. Each rule stands in the index under the one of its tokens that
the fewest URLs hold; a rule without a token stands under the empty token, which every URL has. A URL's tokens fetch
its candidate rules from the index, and only those rules' expressions run.

The index is one row of arrays, of the rule list's size, not the data's, and is broadcast. A URL's tokens are looked
up in it by binary search over token hashes, in the URL's own row: nothing is copied once a token, and rows are not
shuffled. (Two tokens with one hash would fetch a candidate too many; its expression decides.) The best fitting rule
is the largest of one number a rule (rank, length, place). Only DataFrame functions are used.

Of the URL's parts the host is lower-cased; the method's own rules tell no cases apart. A null URL and one without
``://`` have empty host and path, and get the method's default. Repeated rows are judged each for itself, very long
URLs in a time that grows with their different tokens; an empty table gives an empty result; columns other than page_id and
url are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class UrlRule:
    """``regex`` is searched in host, path and query, joined; ``tokens`` are lower-case and complete in every match. Of fitting rules the highest ``rank`` wins, then the longest ``name``."""

    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    rank: int = 0
    shown: bool = False


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_])", r"\\\1", text)


def prefix_rule(verdict: str, host: str, path: str) -> UrlRule:
    """The rule for a host with all its subdomains and the paths that start with ``path``."""
    whole = re.findall(r"[a-z0-9]+", host) + re.findall(r"(?<![a-z0-9])[a-z0-9]+(?=[^a-z0-9])", path.lower())
    return UrlRule(host + path, verdict, rf"\A(?:[^/?]*\.)?{_quoted(host)}{_quoted(path)}", tuple(dict.fromkeys(whole)), 1, True)


#: The rules that the query is given.
GIVEN_RULES = (
    prefix_rule("allow", "org", "/"),
    prefix_rule("block", "example.org", "/es/"),
    prefix_rule("block", "example.org", "/en/1"),
    prefix_rule("allow", "com", "/fr/"),
    prefix_rule("block", "com", "/de/"),
)

#: Words that mark a host's label, or a part of it between hyphens, as unwanted.
UNWANTED = (
    "adserver", "ads", "adult", "bets", "betting", "bitcoin", "blackjack", "camgirls", "casino", "crack", "dating", "doubleclick", "escort", "fetish",
    "gambling", "hentai", "hookup", "jackpot", "keygen", "lottery", "malware", "nude", "payday", "phishing", "pharmacy", "pills", "pirate", "poker",
    "popunder", "porn", "replica", "roulette", "serials", "sex", "slots", "spam", "spyware", "sweepstakes", "torrent", "viagra", "warez", "webcam", "xxx",
)
#: Directories of a path that hold no prose.
PLUMBING = (
    "add-to-cart", "admin", "adclick", "autodiscover", "basket", "cart", "cgi-bin", "checkout", "feed", "forgot-password", "gambling", "login", "logout",
    "oauth", "phpmyadmin", "porn", "print", "register", "rss", "search", "signin", "signup", "tag", "trackback", "unsubscribe", "wishlist", "wp-admin",
    "wp-content", "wp-includes", "wp-json", "xxx",
)
#: Endings of files that hold no text.
FILES = (
    "7z", "apk", "avi", "bin", "bmp", "bz2", "css", "dll", "dmg", "doc", "exe", "flv", "gif", "gz", "ico", "iso", "jar", "jpeg", "jpg", "js", "m4a", "mkv",
    "mov", "mp3", "mp4", "mpeg", "msi", "ogg", "pkg", "png", "ppt", "rar", "svg", "swf", "tar", "tgz", "tif", "torrent", "ttf", "wav", "webm", "webp",
    "wmv", "woff", "xls", "zip",
)
#: Last labels of hosts.
TOPS = ("adult", "bet", "casino", "dating", "download", "loan", "onion", "poker", "porn", "sex", "sexy", "webcam", "xxx")
#: Parameters of a query that make another address of the same text, or none.
PARAMETERS = (
    "action", "addtocart", "affid", "clickid", "fbclid", "gclid", "jsessionid", "msclkid", "phpsessid", "redirect", "replytocom", "returnurl", "sessionid",
    "share", "sid",
)

#: A rule's expression for a word, by kind; hosts end at the first slash or question mark, paths at the question mark.
SHAPES = {
    "host": (UNWANTED, r"\A(?:[^/?]*[.-])?{}(?:[.-][^/?]*)?(?:[/?]|\z)"),
    "top": (TOPS, r"\A[^/?]*\.{}(?:[/?]|\z)"),
    "path": (PLUMBING, r"\A[^/?]*/(?:[^?]*/)?{}(?:[/?]|\z)"),
    "file": (FILES, r"\A[^/?]*/[^?]*\.{}(?:\?|\z)"),
    "query": (PARAMETERS, r"\?(?:.*[&;])?{}="),
}


def pattern_rules() -> tuple[UrlRule, ...]:
    """The method's own rules, for URLs that no given rule fits: one for each word of each kind."""
    out = []
    for kind, (words, shape) in SHAPES.items():
        for w in words:
            out.append(UrlRule(f"{kind}:{w}", "block", "(?is)" + shape.replace("{}", _quoted(w)), tuple(dict.fromkeys(re.findall("[a-z0-9]+", w)))))
    return tuple(out)


PATTERN_RULES = pattern_rules()

MAX_RULES = 1 << 20


def parts_of(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query of a URL that isn't null."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"\A(?s:.*?)://", "")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, r"\A[^?#]*(\?[^#]*)", 1)


def _places(keys: Column, found: Column, size: int) -> Column:
    """By binary search, the place of ``found`` among the sorted ``keys``, an array of ``size``; of the last smaller one (-1: none) if it isn't there."""
    jumps = F.lit([1 << i for i in range(max(size, 1).bit_length() - 1, -1, -1)])
    return F.aggregate(jumps, F.lit(-1), lambda at, jump: F.when((at + jump < size) & (F.get(keys, at + jump) <= found), at + jump).otherwise(at))


def filter_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = GIVEN_RULES + PATTERN_RULES, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of each row of ``pages`` (page_id, url)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the broadcast index holds {MAX_RULES} at most")
    spark = pages.sparkSession
    urls = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("_url"))
    host, path, query = parts_of(F.col("_url"))
    urls = urls.select("page_id", host.alias("host"), path.alias("path"), query.alias("_query")).withColumn("_all", F.concat("host", "path", "_query"))
    tokens = F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.lower("_all"), "[^a-z0-9]+")))
    urls = urls.withColumn("_tokens", F.transform(tokens, lambda t: F.xxhash64(t)))

    # the hash of every token, and how many URLs hold it: a count a token of the rules, however many URLs there are
    named = spark.createDataFrame([(t,) for t in sorted({"", *(t for r in rules for t in r.tokens)})], "token string").withColumn("hash", F.xxhash64("token"))
    seen = urls.select(F.explode("_tokens").alias("hash")).join(F.broadcast(named.select("hash").distinct()), "hash").groupBy("hash").count()
    counted = {r["token"]: (r["hash"], r["count"] or 0) for r in named.join(seen, "hash", "left").collect()}
    under: dict[int, list[int]] = {}
    for i, r in enumerate(rules):
        rarest = min(r.tokens, key=lambda t: (counted[t][1], t), default="")
        under.setdefault(counted[rarest][0], []).append(i)
    keys = sorted(under)
    codes = [(r.rank << 40) + (len(r.name) << 20) + i for i, r in enumerate(rules)]
    index = spark.createDataFrame(
        [(keys, [under[k] for k in keys], [r.regex for r in rules], codes, [r.name if r.shown else None for r in rules], [r.verdict for r in rules])],
        "_keys array<long>, _under array<array<int>>, _regex array<string>, _codes array<long>, _names array<string>, _verdicts array<string>")

    def candidates(token: Column) -> Column:
        at = _places(F.col("_keys"), token, len(keys))
        return F.when((at >= 0) & (F.get("_keys", at) == token), F.get("_under", at)).otherwise(F.array().cast("array<int>"))

    held = urls.join(F.broadcast(index)).withColumn("_rules", F.flatten(F.transform("_tokens", candidates)))  # the index is one row
    fitting = F.filter("_rules", lambda i: F.rlike(F.col("_all"), F.get("_regex", i)))
    best = held.withColumn("_best", F.array_max(F.transform(fitting, lambda i: F.get("_codes", i)))).withColumn("_rule", F.col("_best").bitwiseAND(F.lit((1 << 20) - 1)).cast("int"))
    return best.select(
        "page_id", "host", "path", F.get("_names", F.col("_rule")).alias("rule"), F.coalesce(F.get("_verdicts", F.col("_rule")), F.lit(default)).alias("verdict"))
