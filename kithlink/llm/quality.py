"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are hashed trigrams of its letters, hashed trigrams of its character classes (case, digits, each
punctuation mark) and repetition marks (a word equal to the one before it, or to one of the few before that, and
the share of different words). Terms are counted over the whole text, damped, weighted by inverse document
frequency in the labelled sample, and projected on the sample's leading singular directions. The labelled
vectors are broadcast; every document's vector is multiplied with all of them, block by block, and the labels of
the ``NEIGHBOURS`` nearest by cosine vote with a power of their similarity as weight.

The sample is bounded: at most ``PER_LABEL`` documents of either label, the first by a hash of their ids, among
those whose remainder is not 1. Labels, lang, source and ids are never inputs. Null and empty texts, and texts
without a usable vector, get the share of label 1 among the labels that may be learned from; so does everything if there are no
labels of both kinds. Documents labelled twice with different values count once for each. Texts are read whole,
however long; repeated rows score alike; an empty table gives an empty result; columns other than doc_id and text
(and doc_id and the label's of ``labels``) are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import first_by_hash, held_out, text_slices

PER_LABEL = 1200
NEIGHBOURS = 9
POWER = 12
DIMENSIONS = 64
#: Cosines that differ by less are equal.
ROUNDING = 1e-6
LETTER_TERMS = 2048
CLASS_TERMS = 1024
REPEATS = 16
TERMS = LETTER_TERMS + CLASS_TERMS + REPEATS
#: Code points in a slice, about.
SLICE = 1_000_000


def _class_table() -> np.ndarray:
    """A number for each of the first 0x3000 code points: lower, upper, other letter, digit, space, or the mark itself."""
    out = np.zeros(0x3000, np.uint32)
    for i in range(0x3000):
        c = chr(i)
        out[i] = 1 if c.islower() else 2 if c.isupper() else 3 if c.isalpha() else 4 if c.isdigit() else 5 if c.isspace() else 16 + i
    return out


_CLASSES = _class_table()


def _mixed(a: np.ndarray, b: np.ndarray, c: np.ndarray, bits: int) -> np.ndarray:
    h = a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + c * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x27D4EB2F)
    return (h >> np.uint32(32 - bits)).astype(np.int64)


def term_counts(texts: list[str | None]) -> np.ndarray:
    """Damped counts of the terms, one row a text."""
    n = len(texts)
    whole = "\n".join(t or "" for t in texts)
    code = np.frombuffer(("\n" + whole + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t or "") for t in texts])
    doc = np.repeat(np.arange(n), lengths + 1)[: len(code) - 2]  # of code[1:-1]
    inside = np.ones(len(doc), bool)
    inside[np.cumsum(lengths + 1)[:-1] - 1] = False  # what stands between two texts belongs to neither
    kind = np.where(code < 0x3000, _CLASSES[np.minimum(code, 0x2FFF)], 3)
    out = np.zeros((n, TERMS), np.float32)
    mid = kind[1:-1]
    classes = _mixed(kind[:-2], mid, kind[2:], 10)
    out[:, LETTER_TERMS : LETTER_TERMS + CLASS_TERMS] = np.bincount((doc * CLASS_TERMS + classes)[inside], minlength=n * CLASS_TERMS).reshape(n, -1)
    low = np.where(kind == 2, code | np.uint32(0x20), code)  # only tells cases together; exact lower case isn't needed
    letter = kind <= 3
    low = np.where(letter, low, 0)
    at = np.flatnonzero(letter[1:-1])
    grams = _mixed(low[:-2][at], low[1:-1][at], low[2:][at], 11)
    out[:, :LETTER_TERMS] = np.bincount(doc[at] * LETTER_TERMS + grams, minlength=n * LETTER_TERMS).reshape(n, -1)
    # words' hashes, as differences of a running sum of mixed code points and their places in the word
    space = kind == 5
    first = np.flatnonzero(~space[1:] & space[:-1]) + 1
    if len(first):
        last = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        place = np.arange(len(code)) - np.repeat(np.append(0, first), np.diff(np.concatenate(([0], first, [len(code)]))))
        mixed = (low.astype(np.uint64) + np.uint64(1)) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15))
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        run = np.concatenate(([0], np.cumsum(np.where(space, 0, mixed), dtype=np.uint64))).astype(np.uint64)
        word = run[last] - run[first]
        own = doc[first - 1]
        words = np.bincount(own, minlength=n)
        for k in (1, 2, 3):
            same = (word[k:] == word[:-k]) & (own[k:] == own[:-k])
            share = np.bincount(own[k:][same], minlength=n) / np.maximum(words, 1)
            out[:, LETTER_TERMS + CLASS_TERMS + k] = 200 * (share > 0.02) * share
            out[:, LETTER_TERMS + CLASS_TERMS + 4 + k] = 50 * (share > 0.2)
    return np.log1p(out)


@dataclass
class Model:
    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        weighted = counts * self.weights
        weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)
        found = weighted @ self.directions
        norm = np.linalg.norm(found, axis=1, keepdims=True)
        return np.where(norm > 1e-9, found / np.maximum(norm, 1e-9), 0).astype(np.float32)


def fit(counts: np.ndarray, labels: np.ndarray, prior: float, dimensions: int = DIMENSIONS) -> Model:
    """Latent directions of the sample by a randomised singular value decomposition, and the sample's vectors."""
    df = (counts > 0).sum(axis=0)
    weights = np.where(df > 0, np.log((1 + len(counts)) / (1 + df)) + 1, 0).astype(np.float32)
    weighted = counts * weights
    weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)
    k = min(dimensions, *weighted.shape)
    rough = weighted @ np.random.default_rng(7).standard_normal((weighted.shape[1], min(k + 16, *weighted.shape))).astype(np.float32)
    for _ in range(3):
        rough = np.linalg.qr(rough)[0]
        rough = weighted @ (weighted.T @ rough)
    basis = np.linalg.qr(rough)[0]
    directions = np.linalg.svd(basis.T @ weighted, full_matrices=False)[2][:k].T.astype(np.float32)
    model = Model(weights, np.ascontiguousarray(directions), np.zeros((0, k), np.float32), labels.astype(np.float32), prior)
    model.vectors = model.project(counts)
    return model


def vote(model: Model, vectors: np.ndarray, neighbours: int = NEIGHBOURS, power: float = POWER, block: int = 512) -> np.ndarray:
    """The score of each vector. Labelled vectors as near as the last of the nearest, up to rounding, all vote."""
    out = np.full(len(vectors), model.prior)
    k = min(neighbours, len(model.vectors))
    for s in range(0, len(vectors), block):
        cosine = vectors[s : s + block] @ model.vectors.T
        least = np.partition(cosine, cosine.shape[1] - k, axis=1)[:, cosine.shape[1] - k, None]
        weight = np.where(cosine >= least - ROUNDING, np.maximum(cosine, 0), 0).astype(np.float64) ** power
        total = weight.sum(axis=1)
        out[s : s + block] = np.where(total > 1e-30, (weight @ model.labels) / np.maximum(total, 1e-300), model.prior)
    return np.clip(out, 0, 1)


def _slices(batch):
    rows: list[str | None] = []
    size = 0
    for _, texts in text_slices(batch, rows=32):
        rows += texts
        size += sum(len(t) for t in texts if t)
        if size >= SLICE or len(rows) >= 512:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _features(batches):
    for batch in batches:
        labels = batch.column(batch.schema.get_field_index("label"))
        counts = [term_counts(texts) for texts in _slices(batch)]
        if counts:
            packed = [row.tobytes() for row in np.concatenate(counts).astype(np.float16)]
            yield pa.RecordBatch.from_arrays([labels, pa.array(packed, pa.binary())], names=["label", "counts"])


def learn(docs: DataFrame, labels: DataFrame, column: str = "quality", per_label: int = PER_LABEL) -> Model | float:
    """The model, or the share of label 1 (one half without labels) if only one label is there."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    prior = shares.get(1, 0) / sum(shares.values()) if shares else 0.5
    if len(shares) < 2:
        return prior
    chosen = first_by_hash(known, "label", per_label)  # 2 * per_label rows at most
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    rows = sample.dropDuplicates(["doc_id", "label"]).orderBy("doc_id", "label").select("label", "text").mapInArrow(_features, "label int, counts binary").collect()
    found = np.array([r["label"] for r in rows])
    if len(set(found.tolist())) < 2:
        return prior
    counts = np.stack([np.frombuffer(r["counts"], np.float16) for r in rows]).astype(np.float32)
    return fit(counts, found, prior)


def _score(batches, model, keep):
    model = model.value
    for batch in batches:
        scores = []
        for texts in _slices(batch):
            if isinstance(model, float):
                scores.append(np.full(len(texts), model))
            else:
                counts = term_counts(texts)
                vectors = model.project(counts)
                vectors[[not (t and t.strip()) for t in texts]] = 0
                scores.append(vote(model, vectors))
        columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=[*keep, "score"])


def score(docs: DataFrame, model: Model | float, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and the score of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(partial(_score, model=shared, keep=list(keep)), f"{schema}, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
