"""Benchmark decontamination: a BM25 index of the test items, queried with every training passage by block-max WAND.

Items are cut into parts of at most ``PART`` words, which are the index's documents. A posting's impact is its
BM25 weight over the part's own total, so a passage's score for a part is the share of the part's weight that
the passage covers, and one threshold serves all parts. Every text is read in passages of ``2 * PART`` words that
begin at each ``PART``-th word, so that any part lies whole in some passage.

WAND first adds up the query terms' upper bounds; where even their sum misses the threshold no pivot exists and
nothing is retrieved. These sums are taken for all passages of a text at once, by range of parts (a block), from
the different words of each half passage; most passages end there. The others go through the postings: block
maxima skip blocks that can't reach the threshold, and all parts above it are retrieved. Each retrieved part is verified: word five-grams of the item's question (all but its last fifth, unless
the table has its own columns question and answer) and of its answer must occur in the passage. An item counts for a document if
at least ``OVERLAP`` of its question's and of its answer's five-grams, over all its parts, were found. Where the table has no such
columns, the share is judged over question and answer together, and an item of ``2 * GRAM`` words or more also counts if one word
changed, added or left out explains all that is missing.

The index is broadcast in slices of at most ``SLICE_WORDS`` words of items, one pass over the documents a slice,
so its size is bounded however large the benchmark is. Words are lower-cased runs of letters, digits and
underscores. Null texts, and items without a word, match nothing; items shorter than five words are compared
whole. Rows are judged each for itself, whatever their ids, repeated ones alike; items without an id count like others
and are reported with a null item_id. An empty table of documents or of items gives no matches. ``drop_contaminated`` carries
all columns of the documents along, whatever their names and types.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_by_text, text_slices

PART = 64
GRAM = 5
THRESHOLD = 0.7
OVERLAP = 0.8
BLOCK = 32
#: Ranges of parts for which passages' bounds are summed up.
RANGES = 64
K1, B = 1.2, 0.75
SLICE_WORDS = 400_000

WORDS = re.compile(r"\w+")


def words(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def _grams(found: list[str], size: int = GRAM) -> set[tuple[str, ...]]:
    size = min(size, len(found))
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if size else set()


class Index:
    """The postings of some items: by term, the parts that hold it, their impacts, and the impacts' maxima by block."""

    def __init__(self, items: list[tuple[int | None, str, str]], apart: bool = True):
        """``items``: id, question and answer; ``apart``: whether these are judged each for itself."""
        self.apart = apart
        self.items: list[int | None] = []
        self.whole: list[tuple[int, int, list[str]]] = []  # item's first part, length of its question, its words
        self.parts: list[tuple[int, set, set]] = []  # item's position, question's and answer's grams
        self.total: dict[int, tuple[int, int]] = {}
        texts: list[list[str]] = []
        for item, question, answer in items:
            q, a = words(question), words(answer)
            whole = q + a
            if not whole:
                continue
            at = len(self.items)
            self.items.append(item)
            self.whole.append((len(self.parts), len(q), whole))
            sums = [0, 0]
            for s in range(0, len(whole), PART):
                part = whole[s : s + PART]
                cut = min(max(len(q) - s, 0), len(part))
                grams = _grams(part[:cut]), _grams(part[cut:])
                sums = [sums[0] + len(grams[0]), sums[1] + len(grams[1])]
                self.parts.append((at, *grams))
                texts.append(part)
            self.total[at] = (sums[0], sums[1])
        n = len(texts)
        df = Counter(t for part in texts for t in set(part))
        mean = sum(map(len, texts)) / max(n, 1)
        idf = {t: math.log(1 + (n - d + 0.5) / (d + 0.5)) for t, d in df.items()}
        postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for i, part in enumerate(texts):
            weights = {t: idf[t] * c * (K1 + 1) / (c + K1 * (1 - B + B * len(part) / mean)) for t, c in Counter(part).items()}
            whole_weight = sum(weights.values())
            for t, w in weights.items():
                postings[t].append((i, w / whole_weight))
        self.number = {t: i for i, t in enumerate(sorted(postings))}
        ordered = [postings[t] for t in sorted(postings)]
        self.docs = [np.array([i for i, _ in p], np.int64) for p in ordered]
        self.impacts = [np.array([w for _, w in p]) for p in ordered]
        self.block_max = [np.maximum.reduceat(w, np.arange(0, len(w), BLOCK)) if len(w) else w for w in self.impacts]
        self.bound = np.array([w.max() for w in self.impacts])
        ranges = min(RANGES, max(n, 1))
        self.range_bound = np.zeros((len(ordered), ranges), np.float32)
        for t, p in enumerate(ordered):
            for i, w in p:
                self.range_bound[t, i * ranges // n] = max(self.range_bound[t, i * ranges // n], w)

    def retrieve(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All parts whose score for the query reaches the threshold, by block-max WAND."""
        lists = [[self.docs[t].tolist(), self.impacts[t].tolist(), self.block_max[t].tolist(), 0, float(self.bound[t])] for t in terms]
        found = []
        while True:
            lists = [x for x in lists if x[3] < len(x[0])]
            lists.sort(key=lambda x: x[0][x[3]])
            total, pivot = 0.0, None
            for k, x in enumerate(lists):
                total += x[4]
                if total >= threshold:
                    pivot = k
                    break
            if pivot is None:
                return found
            doc = lists[pivot][0][lists[pivot][3]]
            while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][3]] == doc:
                pivot += 1
            reach, until = 0.0, None
            for x in lists[: pivot + 1]:  # the blocks in which the pivot's document would stand
                at = x[3] // BLOCK
                while (at + 1) * BLOCK <= len(x[0]) and x[0][min((at + 1) * BLOCK, len(x[0])) - 1] < doc:
                    at += 1
                if at < len(x[2]) and x[0][min((at + 1) * BLOCK, len(x[0])) - 1] >= doc:
                    reach += x[2][at]
                    last = x[0][min((at + 1) * BLOCK, len(x[0])) - 1]
                    until = last if until is None else min(until, last)
            if reach < threshold:  # no document up to the nearest block end can reach it
                ahead = (until if until is not None else doc) + 1
                if pivot + 1 < len(lists):
                    ahead = min(ahead, lists[pivot + 1][0][lists[pivot + 1][3]])
                for x in lists[: pivot + 1]:
                    while x[3] < len(x[0]) and x[0][x[3]] < ahead:
                        x[3] += 1
            elif lists[0][0][lists[0][3]] == doc:
                score = 0.0
                for x in lists[: pivot + 1]:
                    score += x[1][x[3]]
                    x[3] += 1
                if score >= threshold:
                    found.append((doc, score))
            else:
                for x in lists[:pivot]:
                    while x[3] < len(x[0]) and x[0][x[3]] < doc:
                        x[3] += 1

    def matches(self, text: str, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[tuple[int, float, float, float]]:
        """(item, best score, share of the question, share of the answer) of the items that the text holds."""
        found = words(text)
        n = len(found)
        if not n or not self.items:
            return []
        size = len(self.number)
        ids = np.fromiter(map(self.number.get, found, repeat(size)), np.int64, n)
        at = np.flatnonzero(ids < size)
        if not len(at):
            return []
        halves = -(-n // PART)
        each = np.unique(at // PART * size + ids[at])  # the different words of each half passage
        half, word = each // size, each % size
        first = np.flatnonzero(np.append(True, half[1:] != half[:-1]))
        sums = np.zeros((halves + 1, self.range_bound.shape[1]), np.float32)
        sums[half[first]] = np.add.reduceat(self.range_bound[word], first, axis=0)
        most = (sums[:-1] + sums[1:]).max(axis=1)[: max(halves - 1, 1)]
        hits: dict[int, list] = {}
        for k in np.flatnonzero(most >= threshold - 1e-4).tolist():
            s, e = k * PART, min((k + 2) * PART, n)
            terms = np.unique(ids[s:e])
            terms = terms[terms < size]
            if self.range_bound[terms].sum(axis=0).max() < threshold - 1e-4:
                continue
            retrieved = self.retrieve(terms.tolist(), threshold - 1e-9)
            if not retrieved:
                continue
            sizes = {len(g) for p, _ in retrieved for side in self.parts[p][1:] for g in side}
            passage = {z: _grams(found[s:e], z) for z in sizes}
            for p, score in retrieved:
                at, *sides = self.parts[p]
                own = hits.setdefault(at, [0.0, [set(), set()], set()])
                own[0] = max(own[0], score)
                own[2].update(found[s:e])
                for side, grams in zip(own[1], sides, strict=True):
                    side |= {(p, g) for g in grams if g in passage[len(g)]}
        out = []
        for at, (score, sides, seen) in sorted(hits.items()):
            shares = [len(s) / t if t else 1.0 for s, t in zip(sides, self.total[at], strict=True)]
            if self.apart:
                counts = min(shares) >= overlap
            else:
                counts = sum(map(len, sides)) >= overlap * sum(self.total[at]) or self.edited_once(at, sides, seen)
            if counts:
                out.append((self.items[at], min(score, 1.0), *shares))
        return out

    def edited_once(self, at: int, sides: list[set], seen: set[str]) -> bool:
        """Whether the missing five-grams all meet at one word, and of the words outside of the found ones at most one isn't in the passages."""
        first, question, whole = self.whole[at]
        if len(whole) < 2 * GRAM:
            return False
        missing, open_words = [], set(range(len(whole)))
        for p, s in enumerate(range(0, len(whole), PART), first):
            e = min(s + PART, len(whole))
            cut = min(max(question, s), e)
            for side, (a, b) in zip(sides, ((s, cut), (cut, e)), strict=True):
                size = min(GRAM, b - a)
                for i in range(a, b - size + 1) if size else ():
                    if (p, tuple(whole[i : i + size])) in side:
                        open_words.difference_update(range(i, i + size))
                    else:
                        missing.append(i)
        return max(missing) - min(missing) < GRAM and 2 * len(open_words) <= len(whole) and sum(whole[i] not in seen for i in open_words) <= 1


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item that has one text: its last fifth, at least a word, is the answer."""
    spans = [m.span() for m in WORDS.finditer(text)]
    cut = len(spans) - max(1, len(spans) // 5)
    return (text[: spans[cut - 1][1]], text[spans[cut - 1][1] :]) if cut > 0 else ("", text)


def indexes(benchmark: DataFrame, slice_words: int = SLICE_WORDS) -> Iterator[Index]:
    """Indexes of the items in the order of their ids, each of a bounded number of words (one item may exceed it)."""
    own = {"question", "answer"} <= set(benchmark.columns)
    columns = ["item_id", *(["question", "answer"] if own else ["text"])]
    rows = benchmark.select(*columns).orderBy(*columns)
    held, size = [], 0
    for row in rows.toLocalIterator():
        question, answer = (row["question"] or "", row["answer"] or "") if own else split_item(row["text"] or "")
        held.append((row["item_id"], question, answer))
        size += len(words(question)) + len(words(answer))
        if size >= slice_words:
            yield Index(held, own)
            held, size = [], 0
    if held:
        yield Index(held, own)


def _find(batches, index):
    index = index.value
    for batch in batches:
        ids = batch.column(0).to_pylist()
        out = []
        for start, texts in text_slices(batch):
            for i, text in enumerate(texts, start):
                if text:
                    out += [(ids[i], *m) for m in index.matches(text)]
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = [batch.schema.field(0).type, pa.int64(), *[pa.float64()] * 3]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "bm25", "question_overlap", "answer_overlap"])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, bm25, question_overlap and answer_overlap: a row for each document and each item that it holds."""
    spark = docs.sparkSession
    read = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id long, bm25 double, question_overlap double, answer_overlap double"
    found = None
    for index in indexes(benchmark):
        part = read.mapInArrow(partial(_find, index=spark.sparkContext.broadcast(index)), schema)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def _keep(batches, text, index):
    index = index.value
    for batch in batches:
        clean = [not (t and index.matches(t)) for _, texts in text_slices(batch, text) for t in texts]
        yield batch.filter(pa.array(clean, pa.bool_()))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item. Rows are filtered where they are; nothing is shuffled."""
    spark = docs.sparkSession
    for index in indexes(benchmark):
        docs = filter_by_text(docs, partial(_keep, index=spark.sparkContext.broadcast(index)))
    return docs
