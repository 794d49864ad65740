"""Substring dedup: runs of words that also stand in an earlier document are removed.

Two forms.

``remove_reference_spans`` has a bounded reference: one suffix automaton after the other is built of a shard and
broadcast, documents stream through it for matching statistics (the longest match that ends at each word), and
maximal spans at or above the length threshold go. An automaton takes some microseconds and about a kilobyte a word
in Python.

``remove_repeats`` has the whole corpus as its own reference. Its automata would grow with the corpus, and every
document would stream through every shard, so nothing of it could be broadcast within a bound. Here equal windows
of ``WINDOW`` words are brought together by hash instead:

0. Rows with equal texts are told by their digests: all but the one with the smallest doc_id lose all their words
   (if they have a window) and take no further part. Digests that many rows share are joined by broadcast.
1. Each window is represented by its anchor, the least hash of its five-grams; equal windows have equal anchors. A
   document's different anchors, about one for five words, are sorted by hash, and those that only one document has
   are dropped. In ordinary text few are left.
2. Documents with shared anchors hash the windows of those anchors, each different one once. Sorted by window hash
   and doc_id, all rows of a window but those of its smallest doc_id are marked: their words go.
3. The marks return to the documents, which are read from the same exchange as in the second step.

Anchors that very many documents have are known to be shared from the first ``SAMPLE_DOCS`` documents by hash, and
take no part in the first sort. Windows of such anchors are dealt in ``SPLITS`` parts each by document; the first
rows of the parts then meet in a second, small sort. What the sample says changes only where rows are compared, never
the result: every other anchor is compared in full. Both sorts stream; of a window or anchor one row is held at a time.
Words are hashed with 64 bits, windows with 96: among 10^13 windows two different ones share a hash with a probability
of about 0.001.

Null texts have no words; texts are read whole, however long. Rows without a doc_id neither lose words nor cause others
to. Rows with one doc_id are judged each for itself and never cause each other's words to go, as no doc_id among them
is smaller. Documents of fewer than ``WINDOW`` words stay whole; an empty table gives an empty result; columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, shuffle_partitions, text_slices

WINDOW = 13
GRAM = 5
#: Odd numbers that word hashes are multiplied with by their place.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
#: Stands in a place if its window begins at other words of the text too.
AGAIN = 1 << 30
#: Words that are hashed together.
SLICE_WORDS = 200_000
#: Documents that are looked through for very common anchors, and the share (and number) of them that makes an anchor common.
SAMPLE_DOCS = 4096
COMMON_SHARE = 0.0025
COMMON_LEAST = 8
#: Parts that a common anchor's windows are dealt in.
SPLITS = 32
#: Digests of more than one of so many rows are joined by broadcast; there are at most so many.
HOT_DIGESTS = 1000
#: More odd numbers, for the second hash of a window.
MORE_PLACES = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)


def split_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _stirred(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def gram_hashes(words: np.ndarray) -> np.ndarray:
    """Of each run of GRAM word hashes."""
    n = max(len(words) - GRAM + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(GRAM):
        out += words[i : i + n] * PLACES[i]
    return _stirred(out)


def anchors(grams: np.ndarray) -> np.ndarray:
    """The least of each run of WINDOW - GRAM + 1 gram hashes."""
    span, done, low = WINDOW - GRAM + 1, 1, grams
    while done * 2 <= span:
        low = np.minimum(low[:-done], low[done:])
        done *= 2
    if done < span:
        low = np.minimum(low[: len(low) - (span - done)], low[span - done :])
    return low


def window_hashes(words: np.ndarray, grams: np.ndarray, at: np.ndarray, places: np.ndarray = PLACES) -> np.ndarray:
    """Of the windows that start at ``at``."""
    out = grams[at] * places[0] + grams[at + GRAM] * places[1]
    for i in range(2 * GRAM, WINDOW):
        out += words[at + i] * places[2 + i - 2 * GRAM]
    return _stirred(out)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _slices(batch):
    """(first row, word hashes, each word's row) for some rows at a time."""
    hashes, sizes, first, held = [], [], 0, 0
    for _, texts in text_slices(batch, rows=32):
        for t in texts:
            words = split_words(t)
            hashes.append(word_hashes(words))
            sizes.append(len(words))
            held += len(words)
        if held >= SLICE_WORDS:
            yield first, np.concatenate(hashes), np.repeat(np.arange(len(sizes)), sizes)
            first, held = first + len(sizes), 0
            hashes, sizes = [], []
    if sizes:
        yield first, np.concatenate(hashes), np.repeat(np.arange(len(sizes)), sizes)


def _anchor_rows(batches, common):
    """anchor and key for each different anchor of a row. Common ones are left out; a row that has any gets its own key as an anchor, twice."""
    for batch in batches:
        keys = batch.column(batch.schema.get_field_index("key")).to_numpy()
        for first, words, row in _slices(batch):
            if len(words) < WINDOW:
                continue
            low = anchors(gram_hashes(words))
            own = row[: len(low)]
            keep = own == row[WINDOW - 1 :]
            keep[1:] &= (low[1:] != low[:-1]) | (own[1:] != own[:-1]) | ~keep[:-1]
            low, own = low[keep], own[keep]
            order = np.lexsort((low, own))
            low, own = low[order], own[order]
            new = np.append(True, (low[1:] != low[:-1]) | (own[1:] != own[:-1]))[: len(low)]
            low, key = low[new].view(np.int64), keys[first + own[new]]
            if len(common):
                known = np.isin(low, common)
                twice = np.repeat(np.unique(key[known]), 2)
                low, key = np.concatenate((low[~known], twice)), np.concatenate((key[~known], twice))
            yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(key)], names=["anchor", "key"])


def _shared(batches):
    """Rows sorted by anchor; those whose anchor the row before or after has too."""
    key, doc, before = np.zeros(0, np.int64), np.zeros(0, np.int64), False
    for batch in batches:
        key = np.concatenate((key, batch.column(0).to_numpy()))
        doc = np.concatenate((doc, batch.column(1).to_numpy()))
        if not len(key):
            continue
        same = key[1:] == key[:-1]
        back = np.concatenate(([before], same))
        keep = back[:-1] | same
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(doc[:-1][keep]), pa.array(key[:-1][keep])], names=["key", "anchor"])
        key, doc, before = key[-1:], doc[-1:], bool(back[-1])
    if before:
        yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(key)], names=["key", "anchor"])


def _window_rows(batches, common):
    """The windows of shared anchors: both hashes, the part (0 unless the anchor is common), doc_id, and the start with some bits of the text's hash above it."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    for batch in batches:
        ids, keys, salt = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("doc_id", "key", "salt"))
        shared = batch.column(batch.schema.get_field_index("anchors"))
        out: list[list[np.ndarray]] = [[] for _ in kinds]
        for start, texts in text_slices(batch):
            for i, text in enumerate(texts, start):
                words = word_hashes(split_words(text))
                if len(words) < WINDOW:
                    continue
                grams = gram_hashes(words)
                low = anchors(grams).view(np.int64)
                known = np.isin(low, common)
                at = np.flatnonzero(known | np.isin(low, shared[i].values.to_numpy()))
                if len(at):
                    different, first, count = np.unique(window_hashes(words, grams, at), return_index=True, return_counts=True)
                    at = at[first]
                    out[0].append(different.view(np.int64))
                    out[1].append((window_hashes(words, grams, at, MORE_PLACES) >> np.uint64(32)).astype(np.uint32).view(np.int32))
                    out[2].append(np.where(known[at], 1 + keys[i] % SPLITS, 0))
                    out[3].append(np.full(len(at), ids[i]))
                    out[4].append(at + np.where(count > 1, AGAIN, 0) + salt[i])
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), k) for x, k in zip(out, kinds, strict=True)], names=["window", "more", "part", "doc_id", "place"])


def _repeated(batches):
    """Rows sorted by window, part and doc_id. Those with a larger doc_id than the first of their window and part leave as marks (doc_id, place),
    the first rows of parts above 0 with their window."""
    last, least = None, None
    for batch in batches:
        key, more, part, doc, place = (batch.column(i).to_numpy() for i in range(5))
        if not len(key):
            continue
        start = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (more[1:] != more[:-1]) | (part[1:] != part[:-1])))
        first = doc[start].copy()
        if last == (key[0], more[0], part[0]):
            first[0] = least
        last, least = (key[-1], more[-1], part[-1]), first[-1]
        later = doc > np.repeat(first, np.diff(np.append(start, len(key))))
        again = later | (part > 0)
        if again.any():
            mark = pa.array(later[again])
            own = [pa.array(x[again], mask=later[again]) for x in (key, more)]
            yield pa.RecordBatch.from_arrays([*own, mark, pa.array(doc[again]), pa.array(place[again])], names=["window", "more", "mark", "doc_id", "place"])


def _kept(batches, texts_too):
    for batch in batches:
        salt = batch.column(batch.schema.get_field_index("salt")).to_numpy()
        places = batch.column(batch.schema.get_field_index("places"))
        copy = batch.column(batch.schema.get_field_index("copy"))
        total, removed, digest, kept_text = [], [], [], []
        for start, texts in text_slices(batch):
            for i, text in enumerate(texts, start):
                words = split_words(text)
                gone = 0
                if copy[i].as_py() and len(words) >= WINDOW:
                    gone, words = len(words), []
                elif places[i].is_valid and len(words) >= WINDOW:
                    at = places[i].values.to_numpy()
                    at = at[(at >> 32) == (salt[i] >> 32)] & 0xFFFFFFFF
                    again, at = at & AGAIN > 0, at & (AGAIN - 1)
                    if again.any():
                        hashed = word_hashes(words)
                        every = window_hashes(hashed, gram_hashes(hashed), np.arange(len(words) - WINDOW + 1))
                        at = np.union1d(at, np.flatnonzero(np.isin(every, every[at[again]])))
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + WINDOW, -1)
                    keep = np.cumsum(edge[:-1]) == 0
                    gone = len(words) - int(keep.sum())
                    if gone:
                        words = [words[j] for j in np.flatnonzero(keep).tolist()]
                joined = b" ".join(words)
                total.append(len(words) + gone)
                removed.append(gone)
                digest.append(hashlib.sha256(joined).hexdigest())
                if texts_too:
                    kept_text.append(joined.decode("utf-8", "surrogatepass"))
        columns = [batch.column(batch.schema.get_field_index("doc_id")), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
        yield pa.RecordBatch.from_arrays([*columns, *([pa.array(kept_text, pa.string())] if texts_too else [])], names=["doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * texts_too])


def _common_anchors(named: DataFrame, total: int) -> np.ndarray:
    """Anchors of a good share of the first documents by hash; there are some tens of thousands at most."""
    space = 1 << 20
    sample = named.where(F.pmod(F.xxhash64("doc_id"), F.lit(space)) * F.lit(total) < F.lit(SAMPLE_DOCS * space))
    rows = sample.select("key", "text").mapInArrow(partial(_anchor_rows, common=np.zeros(0, np.int64)), "anchor long, key long")
    least = max(COMMON_LEAST, int(COMMON_SHARE * min(total, SAMPLE_DOCS)))
    found = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("anchor").collect()
    return np.sort(np.array([r[0] for r in found], np.int64))


def _copies(digests: DataFrame, total: int) -> DataFrame:
    """By key, the ids of the rows whose text an earlier document has."""
    first = materialise(digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")).where("first < last"), "digests")
    hot = F.col("n") * HOT_DIGESTS >= total
    few = F.broadcast(first.where(hot).select("digest", F.col("first").alias("hot_first")))  # at most HOT_DIGESTS rows
    tagged = digests.join(few, "digest", "left")
    there = tagged.where("hot_first is not null").select("doc_id", "key", F.col("hot_first").alias("first"))
    rest = tagged.where("hot_first is null").join(first.where(~hot), "digest").select("doc_id", "key", "first")
    return there.unionByName(rest).where("doc_id > first").groupBy("key").agg(F.collect_set("doc_id").alias("copied"))


def remove_repeats(docs: DataFrame, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row, and the kept text if asked for."""
    n = shuffle_partitions(docs.sparkSession)
    text = F.col("text").cast("string")
    salt = F.shiftleft(F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)), 32)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # a row goes by the hash of its id and text
    named = read.where("doc_id is not null").withColumn("salt", salt).withColumn("key", F.xxhash64("doc_id", "salt"))
    digests = materialise(named.select("doc_id", "key", F.sha2(F.col("text").cast("binary"), 256).alias("digest")), "row-digests")
    total = digests.count()
    common = _common_anchors(named, total)

    # one exchange of the texts, read three times
    dealt = named.repartition(n, "key").join(_copies(digests, total), "key", "left").withColumn("copy", F.coalesce(F.array_contains("copied", F.col("doc_id")), F.lit(False))).drop("copied")
    single = dealt.where("not copy")

    # all three readers of the exchange take the same columns, else there would be a second one
    rows = single.select("key", "text", "salt").mapInArrow(partial(_anchor_rows, common=common), "anchor long, key long")
    shared = rows.repartition(n, "anchor").sortWithinPartitions("anchor", "key").mapInArrow(_shared, "key long, anchor long")
    wanted = shared.groupBy("key").agg(F.collect_list("anchor").alias("anchors"))
    windows = single.select("key", "doc_id", "text", "salt").join(wanted, "key").mapInArrow(
        partial(_window_rows, common=common), "window long, more int, part int, doc_id long, place long")
    met = "window long, more int, mark boolean, doc_id long, place long"
    judged = windows.repartition(n, "window", "part").sortWithinPartitions("window", "more", "part", "doc_id").mapInArrow(_repeated, met)
    marks = judged.where("mark").select("doc_id", "place")
    if len(common):
        firsts = judged.where("not mark").select("window", "more", F.lit(0).alias("part"), "doc_id", "place")
        again = firsts.repartition(n, "window").sortWithinPartitions("window", "more", "doc_id").mapInArrow(_repeated, met)
        marks = marks.unionByName(again.select("doc_id", "place"))
    key = F.xxhash64("doc_id", F.shiftleft(F.shiftright("place", 32), 32))
    places = marks.groupBy(key.alias("key")).agg(F.collect_list("place").alias("places"))

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts
    nameless = read.where("doc_id is null").select(
        "*", F.lit(0).cast("long").alias("salt"), F.lit(False).alias("copy"), F.lit(None).cast("array<long>").alias("places"))
    final = partial(_kept, texts_too=texts)
    return dealt.join(places, "key", "left").drop("key").mapInArrow(final, schema).unionByName(nameless.mapInArrow(final, schema))


class SuffixAutomaton:
    """All runs of words of some texts; no run leads from one text to the next."""

    def __init__(self, texts: Iterable[list]):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        for words in texts:
            last = 0
            for w in words:
                last = self._add(last, w)

    def _state(self, length: int, link: int, following: dict) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, w) -> int:
        """The state for p's longest run and w, out of q's longer ones."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _add(self, last: int, w) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def matching(self, words: Iterable) -> list[int]:
        """The length of the longest run that ends at each word and stands in the texts."""
        state, size, out = 0, 0, []
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if w in self.next[state]:
                state, size = self.next[state][w], size + 1
            out.append(size)
        return out


def _through(batches, automaton, least):
    """The rows with the spans found in one automaton added to ``spans``, starts and ends in turn."""
    automaton = automaton.value
    for batch in batches:
        found = []
        before = batch.column(2).to_pylist()
        for start, texts in text_slices(batch):
            for i, text in enumerate(texts, start):
                spans = before[i]
                for end, size in enumerate(automaton.matching(split_words(text)), 1):
                    if size >= least:
                        if spans and spans[-2] == end - size and spans[-1] == end - 1:
                            spans[-1] = end
                        else:
                            spans += [end - size, end]
                found.append(spans)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "text", "spans"])


def _without(batches):
    for batch in batches:
        kept = []
        for start, texts in text_slices(batch):
            for i, text in enumerate(texts, start):
                words = split_words(text)
                spans = batch.column(2)[i].values.to_numpy()
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, spans[0::2], 1)
                np.add.at(edge, spans[1::2], -1)
                kept.append(b" ".join(words[j] for j in np.flatnonzero(np.cumsum(edge[:-1]) == 0)).decode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], names=["doc_id", "kept"])


def remove_reference_spans(docs: DataFrame, shards: Iterable[list[str]], least: int = WINDOW, most_words: int = 200_000) -> DataFrame:
    """doc_id and the kept text of each row, without the spans of ``least`` words or more that some shard holds.

    Each shard is a list of texts of at most ``most_words`` words. One automaton is built and broadcast at a time, and documents stream through
    it; the spans found are a table between one shard and the next.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.array().cast("array<long>").alias("spans"))
    own = docs.schema["doc_id"].dataType.simpleString()
    for shard in shards:
        texts = [split_words(t) for t in shard]
        if sum(map(len, texts)) > most_words:
            raise ValueError(f"a shard has more than {most_words} words")
        shared, before = spark.sparkContext.broadcast(SuffixAutomaton(texts)), rows
        rows = materialise(before.mapInArrow(partial(_through, automaton=shared, least=least), f"doc_id {own}, text string, spans array<long>"), "spans")
        shared.destroy()
        discard(before)
    return rows.mapInArrow(_without, f"doc_id {own}, kept string")
