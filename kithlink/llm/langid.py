"""Language identification of words, spans and documents.

A word's script, by code point ranges, narrows the languages to those that were learned with that script. A
word's score in a language is the sum of its letter trigrams' log-likelihoods. Over a document's words the
Viterbi path with a fixed penalty for each change of language labels spans; the document's language is the one
with the most letters in its spans, and its score their share. All documents of a batch step through the
Viterbi recursion together.

Learned from at most ``PER_LANGUAGE`` documents a language, the first by a hash of their ids, among those whose
remainder is not 1 and whose lang is set; what is gathered is a count per language and hashed trigram, whose
number is fixed. Null texts and texts without a letter are ``und`` with score 0. Ties go to the language that
comes first by name. Without any labelled document everything is ``und``. Each row is judged for itself, repeated
ones alike, over its whole text; an empty table gives an empty result. ``drop_unknown`` carries all columns of its
input along, whatever their names and types. The model has a column a language, so labels other than language codes
(more than ``MOST_LANGUAGES`` different ones) are an error.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_by_text, first_by_hash, held_out, quoted, text_slices

PER_LANGUAGE = 1500
BUCKETS = 1 << 18
#: What a change of language costs, in nats.
SWITCH = 12.0
#: Words whose scores are held at a time.
WORDS = 1_500_000
#: The most languages that are learned; the model that is broadcast has BUCKETS rows of so many columns at most.
MOST_LANGUAGES = 256
#: A language has a script if it makes this share of its letters.
SCRIPT_SHARE = 0.01

#: First code points of the script ranges, and the scripts' names.
SCRIPT_STARTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"),
    (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
    (0x1380, "Other"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Other"), (0x3400, "Han"), (0xA000, "Other"),
    (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"),
    (0xFE00, "Other"), (0xFF21, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "Other"), (0x20000, "Han"), (0x323B0, "Other"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_STARTS))


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, and its script's number."""
    letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    starts = [s for s, _ in SCRIPT_STARTS]
    numbers = np.array([SCRIPTS.index(n) for _, n in SCRIPT_STARTS], np.uint8)
    return letters, numbers[np.searchsorted(starts, np.arange(0x110000), side="right") - 1]


def _lowered(text: str) -> str:
    """Lower case with the same positions."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


@dataclass
class Words:
    """The words (runs of letters) of some texts: each one's document, start and end, and its letters' trigram buckets."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bucket: np.ndarray
    first: np.ndarray
    script: np.ndarray


def words_of(texts: list[str | None]) -> Words:
    letters, scripts = _tables()
    low = [_lowered(t) if t else "" for t in texts]
    begins = np.cumsum([0] + [len(t) + 1 for t in low])
    code = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters[code]
    kept = np.where(is_letter, code, 0)
    at = np.flatnonzero(is_letter)
    h = kept[at - 1] * np.uint32(0x9E3779B1) + kept[at] * np.uint32(0x85EBCA77) + kept[at + 1] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x27D4EB2F)
    bucket = (h >> np.uint32(14)).astype(np.int32)
    first = np.flatnonzero(~is_letter[at - 1])
    start = at[first] - 1
    end = at[np.append(first[1:], len(at)) - 1] if len(at) else start
    doc = np.searchsorted(begins, start, side="right") - 1
    return Words(doc, start - begins[doc], end - begins[doc], bucket, first, scripts[code[at[first]]] if len(at) else np.zeros(0, np.uint8))


@dataclass
class Model:
    languages: tuple[str, ...]
    row: np.ndarray  # by bucket, the row of its scores; 0: not seen
    scores: np.ndarray
    allowed: np.ndarray  # by script and language


def _counts(batches):
    """lang, bucket and count; scripts' letters count under -1 - script."""
    for batch in batches:
        langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
        for start, texts in text_slices(batch):
            words = words_of(texts)
            names = sorted(set(langs[start : start + len(texts)]))
            own = np.array([names.index(x) for x in langs[start : start + len(texts)]])
            size = np.diff(np.append(words.first, len(words.bucket)))
            lang = own[words.doc]
            keys, n = np.unique(np.repeat(lang, size) * (BUCKETS + 256) + 256 + words.bucket, return_counts=True)
            more, m = np.unique(lang * (BUCKETS + 256) + words.script, return_counts=True)
            keys, n = np.concatenate((keys, more)), np.concatenate((n, m))
            which, rest = keys // (BUCKETS + 256), keys % (BUCKETS + 256)
            bucket = np.where(rest < 256, -1 - rest, rest - 256)
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in which], pa.string()), pa.array(bucket, pa.int64()), pa.array(n, pa.int64())], names=["lang", "bucket", "n"])


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """The model of the documents that may be learned from."""
    known = docs.select("doc_id", "lang").where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    if known.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"lang has more than {MOST_LANGUAGES} values; these are no language codes")
    chosen = first_by_hash(known, "lang", per_language).distinct()
    # at most per_language rows a language
    sample = docs.where(~held_out(F.col("doc_id"))).select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    counted = sample.select("lang", "text").mapInArrow(_counts, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toPandas()
    languages = tuple(sorted(table["lang"].unique(), key=lambda s: s.encode()))
    grams = table[table["bucket"] >= 0]
    seen = np.unique(grams["bucket"].to_numpy(np.int64))
    row = np.zeros(BUCKETS, np.int32)
    row[seen] = np.arange(1, len(seen) + 1)
    counts = np.zeros((len(seen) + 1, len(languages)))
    allowed = np.zeros((len(SCRIPTS), len(languages)), bool)
    for i, name in enumerate(languages):
        own = grams[grams["lang"] == name]
        counts[row[own["bucket"].to_numpy(np.int64)], i] = own["n"].to_numpy()
        by_script = table[(table["lang"] == name) & (table["bucket"] < 0)]
        share = by_script["n"].to_numpy() / max(1, by_script["n"].sum())
        allowed[-1 - by_script["bucket"].to_numpy(np.int64)[share >= SCRIPT_SHARE], i] = True
    allowed |= ~allowed.any(axis=1, keepdims=True)  # a script that no language has leaves all of them
    smooth = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * len(seen))) if len(languages) else counts
    if len(languages):
        smooth -= smooth.max(axis=1, keepdims=True)
        smooth[0] = 0
    return Model(languages, row, np.maximum(smooth, -6).astype(np.float32), allowed)


def viterbi(scores: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each row of ``scores``; its rows are sequences of ``sizes`` rows, one after the other."""
    n, k = scores.shape
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    ranked = sizes[order]
    longest = int(ranked[0]) if len(ranked) else 0
    active = np.searchsorted(-ranked, -np.arange(longest), side="left")
    back = np.zeros((n, k), np.uint8 if k <= 256 else np.uint16)
    stay = np.arange(k, dtype=back.dtype)[None, :]
    label = np.zeros(n, back.dtype)
    value = np.zeros((len(ranked), k), np.float32)
    best = np.zeros(len(ranked), np.int64)
    for t in range(longest):
        m = active[t]
        at = starts[:m] + t
        if t:
            v = value[:m]
            top = v.argmax(axis=1)
            most = np.take_along_axis(v, top[:, None], 1) - switch
            back[at] = np.where(v >= most, stay, top[:, None].astype(back.dtype))
            value[:m] = np.maximum(v, most)
        value[:m] += scores[at]
    if longest:
        best = value.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        m = active[t]
        at = starts[:m] + t
        label[at] = best[:m]
        best[:m] = back[at, best[:m]]
    return label


def _labelled(texts: list[str | None], model: Model, switch: float):
    """For each text its language's number (-1: none) and score; then the words and their labels."""
    k = len(model.languages)
    words = words_of(texts)
    size = np.diff(np.append(words.first, len(words.bucket)))
    if not len(size) or not k:
        return np.full(len(texts), -1), np.zeros(len(texts)), words, np.zeros(len(size), np.uint8)
    scores = np.add.reduceat(model.scores[model.row[words.bucket]], words.first, axis=0)
    scores -= np.where(model.allowed[words.script], np.float32(0), np.float32(60))
    label = viterbi(scores, np.bincount(words.doc, minlength=len(texts)), switch)
    share = np.bincount(words.doc * k + label, weights=size, minlength=len(texts) * k).reshape(-1, k)
    total = share.sum(axis=1)
    pred = np.where(total > 0, share.argmax(axis=1), -1)
    return pred, np.where(total > 0, share.max(axis=1) / np.maximum(total, 1), 0.0), words, label


def _groups(batch, most: int, column: str = "text"):
    """Slices of the batch with about ``most`` code points."""
    rows, chars, begin = [], 0, 0
    for start, texts in text_slices(batch, column, rows=64):
        rows += texts
        chars += sum(len(t) for t in texts if t)
        if chars >= most:
            yield begin, rows
            begin, rows, chars = start + len(texts), [], 0
    if rows:
        yield begin, rows


def _predict(batches, model, switch, text, spans):
    model = model.value
    names = [*model.languages, "und"]
    for batch in batches:
        pred, score, found = [], [], []
        for _, texts in _groups(batch, 4 * WORDS, text):
            p, s, words, label = _labelled(texts, model, switch)
            pred += [names[i] for i in p]
            score.append(s)
            if spans:
                edge = np.flatnonzero(np.append(True, (words.doc[1:] != words.doc[:-1]) | (label[1:] != label[:-1])))[: len(label)].tolist()
                per: list[list[dict]] = [[] for _ in texts]
                for a, b in zip(edge, [*edge, len(label)][1:], strict=True):
                    per[words.doc[a]].append({"start": int(words.start[a]), "end": int(words.end[b - 1]), "lang": names[label[a]]})
                found += per
        keep = [i for i, name in enumerate(batch.schema.names) if name != text]
        columns = [batch.column(i) for i in keep]
        columns += [pa.array(pred, pa.string()), pa.array(np.concatenate(score) if score else [], pa.float64())]
        if spans:
            columns.append(pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))))
        yield pa.RecordBatch.from_arrays(columns, names=[*(batch.schema.names[i] for i in keep), "lang_pred", "score", *["spans"] * spans])


def identify(docs: DataFrame, model: Model, *, keep: tuple[str, ...] = ("doc_id",), spans: bool = False, switch: float = SWITCH) -> DataFrame:
    """The ``keep`` columns, lang_pred and score of each row of ``docs``, and its spans (start, end, lang) if asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = [f"_keep{i}" for i in range(len(keep))]
    read = docs.select(*[c.alias(o) for c, o in zip(quoted(list(keep)), own, strict=True)], F.col("text").cast("string").alias("_text"))
    kinds = [docs.schema[c].dataType.simpleString() for c in keep]
    out = ", ".join([*(f"{o} {k}" for o, k in zip(own, kinds, strict=True)), "lang_pred string, score double", *["spans array<struct<start:bigint,end:bigint,lang:string>>"] * spans])
    judged = read.mapInArrow(partial(_predict, model=shared, switch=switch, text="_text", spans=spans), out)
    return judged.select(*[F.col(o).alias(c) for o, c in zip(own, keep, strict=True)], "lang_pred", "score", *["spans"] * spans)


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row."""
    return identify(docs, learn(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def _known(batches, text, model, switch, least):
    """The rows of the batches that have a language, as they are."""
    model = model.value
    for batch in batches:
        keep = []
        for _, texts in _groups(batch, 4 * WORDS, text):
            pred, score, *_ = _labelled(texts, model, switch)
            keep.append((pred >= 0) & (score >= least))
        yield batch.filter(pa.array(np.concatenate(keep) if keep else [], pa.bool_()))


def drop_unknown(docs: DataFrame, least: float = 0.3, switch: float = SWITCH) -> DataFrame:
    """The rows of ``docs`` whose text has a language, one that holds at least the share ``least`` of its letters."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs))
    return filter_by_text(docs, partial(_known, model=shared, switch=switch, least=least))
