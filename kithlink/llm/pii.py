"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs, schemes (``://``), digits, identifier cues and the openings
of keys. At an anchor a local parser expands to the span's boundaries and validates it. Each parser reads a stretch of
text once, from where its kind's last span ended, or a bounded stretch after its anchor, so the work is linear in the
text, however long. Base kinds: email, ip, card and phone, each equal to the leftmost non-overlapping matches of its
pattern, failing ones dropped. The method adds ``login`` (user and password in a URL), ``iban``, ``ssn`` and
``account`` (after their cues), and ``secret``: what a cue such as token or password is set to, if it is long and mixed
enough to be no word, and keys that their opening tells.

A null text counts as empty; positions are code points; rows are judged each for itself, whatever their ids, repeated
ones alike; an empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

#: Kinds in the order in which spans of one start are listed; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "login", "iban", "ssn", "account", "secret")
BASE = 4

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOGIN = re.compile(r"[A-Za-z0-9._~%-]{1,64}:[^\s/@:]{1,128}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+")
IBAN = re.compile(r"[\s:#.]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
SSN = re.compile(r"[\s:#.]{0,4}((?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9-])")
ACCOUNT = re.compile(r"(?:[\s:#.]|no\b|number\b){0,6}([0-9]{6,17})(?![0-9.-])", re.I)

#: What a secret's cue is set to.
SETTING = re.compile(r"[\"']?[ \t]{0,3}(?::=|=>|=|:)[ \t]{0,3}[\"']?([A-Za-z0-9_./+=~-]{8,512})|[ \t]{1,3}([A-Za-z0-9_./+=~-]{20,512})")
#: Keys by their openings.
KEYS = {
    "AKIA": re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"),
    "ASIA": re.compile(r"ASIA[0-9A-Z]{16}(?![0-9A-Za-z])"),
    "AIza": re.compile(r"AIza[0-9A-Za-z_-]{35}"),
    "gh": re.compile(r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    "github_pat_": re.compile(r"github_pat_[A-Za-z0-9_]{22,255}"),
    "glpat-": re.compile(r"glpat-[A-Za-z0-9_-]{20,64}"),
    "xox": re.compile(r"xox[abeoprs]-[A-Za-z0-9-]{10,255}"),
    "_live_": re.compile(r"_live_[A-Za-z0-9]{16,255}"),
    "eyJ": re.compile(r"eyJ[A-Za-z0-9_-]{8,2048}\.[A-Za-z0-9_-]{8,4096}\.[A-Za-z0-9_-]{8,2048}"),
    "-----BEGIN ": re.compile(r"-----BEGIN (?:[A-Z]+ ){0,2}PRIVATE KEY-----[A-Za-z0-9+/=\s]{0,16384}(?:-----END (?:[A-Z]+ ){0,2}PRIVATE KEY-----)?"),
}
#: Bits a character that a secret's mixture has at least.
MIXED = 2.5

CUES = {
    "iban": "iban", "ssn": "ssn", "account": "account", "acct": "account", "token": "secret", "secret": "secret", "password": "secret", "passwd": "secret",
    "passphrase": "secret", "pwd": "secret", "api_key": "secret", "apikey": "secret", "api-key": "secret", "access_key": "secret", "accesskey": "secret",
    "private_key": "secret", "credential": "secret", "credentials": "secret", "bearer": "secret",
}


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for anchor, kind in [("@", "@"), ("+", "+"), ("://", "://"), *((d, "0") for d in "0123456789")]:
        found.add_word(anchor, (kind, len(anchor)))
    for cue, kind in CUES.items():
        for shape in (cue, cue.upper(), cue.title()):
            found.add_word(shape, (kind, len(shape)))
    for opening in KEYS:
        found.add_word(opening, (opening, len(opening)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _mixed(value: str) -> bool:
    """Whether a value has letters and digits enough to be no word, name or number."""
    if not any(c.isdigit() for c in value) or not any(c.isalpha() for c in value):
        return False
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= MIXED


def find_spans(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of each span, sorted."""
    spans = []
    after_email = after_dotted = after_grouped = after_phone = 0
    for last, (kind, size) in automaton.iter(text):
        at = last - size + 1
        if kind == "0":
            if at >= after_dotted:
                found = DOTTED.match(text, at)
                after_dotted = found.end()
                if found.group().count(".") >= 3:
                    parts, start = found.group().split("."), at
                    for i in range(0, len(parts) - 3, 4):
                        four = parts[i : i + 4]
                        end = start + sum(map(len, four)) + 3
                        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                            spans.append((start, 1, end))
                        start = end + 1
            if at >= after_grouped:
                found = GROUPED.match(text, at)
                if found:
                    after_grouped = found.end()
                    if found.end() - at >= 14:
                        digits = found.group().replace(" ", "").replace("-", "")
                        if 14 <= len(digits) <= 19 and luhn(digits):
                            spans.append((at, 2, found.end()))
        elif kind == "@":
            start = at
            while start > after_email and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (found := DOMAIN.match(text, at + 1)):
                after_email = found.end()
                spans.append((start, 0, after_email))
        elif kind == "+":
            if at >= after_phone and (found := PHONE.match(text, at)):
                after_phone = found.end()
                if 10 <= sum(c.isdigit() for c in found.group()) <= 15:
                    spans.append((at, 3, after_phone))
        elif kind == "://":
            if at and text[at - 1].isalnum() and (found := LOGIN.match(text, last + 1)):
                spans.append((found.start(), 4, found.end()))
        elif kind in KEYS:
            if (kind == "_live_" or at == 0 or not text[at - 1].isalnum()) and (found := KEYS[kind].match(text, at)):
                spans.append((found.start(), 8, found.end()))
        elif kind == "secret":
            if found := SETTING.match(text, last + 1):
                which = 1 if found.group(1) else 2
                if _mixed(found.group(which)):
                    spans.append((found.start(which), 8, found.end(which)))
        elif at == 0 or not text[at - 1].isalnum():
            pattern, number = {"iban": (IBAN, 5), "ssn": (SSN, 6), "account": (ACCOUNT, 7)}[kind]
            found = pattern.match(text, last + 1)
            if found and (kind != "iban" or _mod97(found.group(1).replace(" ", ""))):
                spans.append((found.start(1), number, found.end(1)))
    return sorted(set(spans))


def _scan(batches):
    automaton = _automaton()
    for batch in batches:
        spans: list[list[dict]] = []
        for _, texts in text_slices(batch):
            spans += [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in find_spans(t, automaton)] if t else [] for t in texts]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and spans, an array of (kind, start, end) by start, then kind, of each row."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def redact(text: str | None, automaton: ahocorasick.Automaton | None = None) -> str | None:
    """``text`` with every span replaced by its kind in brackets; where spans overlap, the one that starts first counts."""
    if not text:
        return text
    out, at = [], 0
    for start, kind, end in find_spans(text, automaton or _automaton()):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
            at = end
    return "".join(out) + text[at:]


def digest(found: DataFrame) -> DataFrame:
    """Counts and joined spans of ``personal_data``'s rows; ``n_secret`` and ``n_spans``, the number of all spans, come last."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:BASE]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:BASE]],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        count("secret").alias("n_secret"), F.size("spans").cast("long").alias("n_spans"))


def digest_of(spans: list[tuple[int, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans if k < BASE).encode()).hexdigest()
