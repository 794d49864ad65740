"""Near-duplicate documents by 64-bit SimHash, found through an index of the fingerprints' bytes by position.

Two fingerprints that differ in at most ``d`` bits agree in at least ``8 - d`` of their 8 bytes, position by
position. A posting list for one positional byte would hold every 256th fingerprint, and tallying pairs in it
would be quadratic. The guaranteed number of matches allows longer keys with the same result: of the first 7
bytes at least ``7 - d`` agree, so postings are keyed by all ``7 - d`` positional bytes out of 7 at once (35
keys of 32 bits at ``d`` = 3). In a posting list the shared positional bytes of a pair are tallied, pairs with
fewer than ``8 - d`` are dropped, and the rest are verified by counting differing bits.

Only classes are wanted, so a list gives a spanning forest of its verified pairs instead of the pairs
themselves. Lists are compared in blocks; in one of more than ``BLOCKWISE`` different fingerprints (a very large
group of near copies) each fingerprint probes for the values within ``d`` flips of the bits outside the key, whose
number is fixed, so that the work is in proportion to the list; the pairs found are the same. Equal fingerprints
are one node, named by the smallest doc_id that has it.

Null texts and texts without words have fingerprint zero, and are linked like any other. Rows without a doc_id
never name a class: their component_id is that of their fingerprint where some row with an id has it, else
null. Rows that share a doc_id count as one document in linking. Repeated rows each get their own result row, texts
are read whole whatever their length, and an empty table gives an empty result. ``near_duplicates`` reads doc_id and
text only; ``keep_one_each`` carries all other columns along, whatever their names and types.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, quoted, row_hash, shuffle_partitions, spare, text_slices
from .components import connected_components

SHINGLE = 3
SEED = 42
DISTANCE = 3
#: Lists up to this length are tallied pair by pair (in blocks), longer ones probed; about here both take the same time.
BLOCKWISE = 8192

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of one text as an unsigned number."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        hashes = map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)), repeat(SEED))
    n = max(1, len(words) - shingle + 1)
    bits = np.unpackbits(np.fromiter(hashes, np.uint64, n).byteswap().view(np.uint8).reshape(-1, 8), axis=1)
    over = bits.sum(axis=0, dtype=np.int32) * 2 > n
    return int.from_bytes(np.packbits(over).tobytes(), "big")


def _fingerprints(batches, keep):
    for batch in batches:
        out = np.empty(batch.num_rows, np.uint64)
        for start, texts in text_slices(batch):
            out[start : start + len(texts)] = [fingerprint(t) for t in texts]
        columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(out.view(np.int64))], names=[*keep, "fp"])


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of each row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_fingerprints, keep=["doc_id"]), "doc_id long, fp long")


class _Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, pairs) -> None:
        for a, b in pairs:
            x, y = self.root(a), self.root(b)
            if x != y:
                self.up[max(x, y)] = min(x, y)
                self.edges.append((a, b))


def _tallied(a: np.ndarray, b: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of a and b that share enough positional bytes and are near enough."""
    x = a[:, None] ^ b[None, :]
    shared = (x.view(np.uint8).reshape(len(a), len(b), 8) == 0).sum(axis=2)
    i, j = np.nonzero(shared >= 8 - distance)
    near = np.bitwise_count(x[i, j]) <= distance
    return i[near], j[near]


def _flips(mask: int, distance: int) -> np.ndarray:
    """All values with 1 to ``distance`` bits set outside ``mask``."""
    free = [1 << i for i in range(64) if not mask >> i & 1]
    return np.array([sum(c) for d in range(1, distance + 1) for c in combinations(free, d)], np.uint64)


def list_forest(values: np.ndarray, mask: int, distance: int, flips: dict[int, np.ndarray]) -> list[tuple[int, int]]:
    """Edges between positions of ``values`` (distinct, equal under ``mask``) that connect what verified pairs connect."""
    n, forest = len(values), _Forest(len(values))
    if n <= BLOCKWISE:
        step = 512
        for s in range(0, n, step):
            for t in range(s, n, step):
                i, j = _tallied(values[s : s + step], values[t : t + step], distance)
                forest.join((a + s, b + t) for a, b in zip(i.tolist(), j.tolist(), strict=True) if a + s < b + t)
    else:
        order = np.argsort(values)
        ranked = values[order]
        if mask not in flips:
            flips[mask] = _flips(mask, distance)
        for flip in flips[mask]:
            probe = ranked ^ flip
            at = np.minimum(np.searchsorted(ranked, probe), n - 1)
            hit = np.flatnonzero((ranked[at] == probe) & (probe > ranked))
            forest.join(zip(order[hit].tolist(), order[at[hit]].tolist(), strict=True))
    return forest.edges


def key_masks(distance: int) -> list[int]:
    """The masks of ``7 - distance`` bytes out of the first 7."""
    return [sum(0xFF << 8 * p for p in c) for c in combinations(range(7), 7 - distance)]


def _links(batches, masks, distance):
    """Rows come sorted by (k, key); the edges of each run of equal keys leave as pairs of node numbers."""
    flips: dict[int, np.ndarray] = {}
    pieces: list[list[np.ndarray]] = []  # of the run that is still open: k, key, fp and node
    out_u: list[int] = []
    out_v: list[int] = []

    def link(k: int, fp: np.ndarray, node: np.ndarray) -> None:
        for a, b in list_forest(fp, masks[k], distance, flips):
            out_u.append(int(node[a]))
            out_v.append(int(node[b]))

    def close() -> None:
        k, _, fp, node = (np.concatenate(x) for x in zip(*pieces, strict=True))
        pieces.clear()
        if len(fp) > 1:
            link(int(k[0]), fp, node)

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        columns[2] = columns[2].astype(np.int64).view(np.uint64)
        k, key, fp, node = columns
        if pieces and (pieces[-1][0][-1] != k[0] or pieces[-1][1][-1] != key[0]):
            close()
        edges = np.concatenate(([0], np.flatnonzero((k[1:] != k[:-1]) | (key[1:] != key[:-1])) + 1, [len(k)]))
        pieces.append([c[: edges[1]] for c in columns])
        if len(edges) > 2:
            close()
            starts, ends = edges[1:-2], edges[2:-1]
            for i in np.flatnonzero(ends - starts > 1):  # most runs are of one row
                link(int(k[starts[i]]), fp[starts[i] : ends[i]], node[starts[i] : ends[i]])
            pieces.append([c[edges[-2] :] for c in columns])
        if len(out_u) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(out_u, pa.int64()), pa.array(out_v, pa.int64())], names=["u", "v"])
            out_u.clear(), out_v.clear()
    if pieces:
        close()
    yield pa.RecordBatch.from_arrays([pa.array(out_u, pa.int64()), pa.array(out_v, pa.int64())], names=["u", "v"])


def link_fingerprints(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs u, v of ``node`` that connect all rows of ``nodes`` (node, fp; fp distinct) whose fp differ in ``distance`` bits at most."""
    masks = key_masks(distance)
    signed = np.array(masks, np.uint64).view(np.int64).tolist()
    postings = nodes.select("node", "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("k", "key"))
    dealt = postings.select("k", "key", "fp", "node").repartition(shuffle_partitions(nodes.sparkSession), "k", "key")
    return dealt.sortWithinPartitions("k", "key").mapInArrow(partial(_links, masks=masks, distance=distance), "u long, v long")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row."""
    prints = materialise(with_fingerprints(docs), "fingerprints")
    nodes = materialise(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    classes = connected_components(link_fingerprints(nodes, distance).distinct())
    of_print = nodes.join(classes, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(of_print, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _rows_with_prints(batches):
    """doc_id, the hash of the row and the fingerprint of its text."""
    for batch in batches:
        out = np.empty(batch.num_rows, np.uint64)
        for start, texts in text_slices(batch):
            out[start : start + len(texts)] = [fingerprint(t) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out.view(np.int64))], names=["doc_id", "row", "fp"])


def keep_one_each(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` without the near duplicates: one row of each class of linked fingerprints stays.

    It is the one with the smallest doc_id, and among rows that share this id the first by a hash of the whole row, so
    reruns agree and different texts under one id, if they are no near duplicates, all stay. Rows that are equal in
    every column are one row. Rows without a doc_id are outside any class and stay.
    """
    own_id, own_row = spare(docs, "id", "row")
    named = docs.select(*quoted(docs.columns), F.col("doc_id").cast("long").alias(own_id), row_hash(docs).alias(own_row)).where(F.col(own_id).isNotNull())
    prints = named.select(F.col(own_id).alias("doc_id"), F.col(own_row).alias("row"), F.col("text").cast("string").alias("text")).mapInArrow(
        _rows_with_prints, "doc_id long, row long, fp long")
    prints = materialise(prints, "row-fingerprints")
    # a fingerprint's class is the least fingerprint that it is linked to
    nodes = materialise(prints.select("fp").distinct().withColumn("node", F.col("fp")), "print-nodes")
    classes = connected_components(link_fingerprints(nodes, distance).distinct())
    of_print = nodes.join(classes, "node", "left").select("fp", F.coalesce("component", "node").alias("class"))
    first = prints.join(of_print, "fp").groupBy("class").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    first = first.select(F.col("first.doc_id").alias(own_id), F.col("first.row").alias(own_row))
    kept = named.join(first, [own_id, own_row], "left_semi").dropDuplicates([own_id, own_row])
    return kept.select(*quoted(docs.columns)).unionByName(docs.where(F.col("doc_id").isNull()))
