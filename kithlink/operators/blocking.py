"""Candidate generation: seven blockers, their union with provenance bits, scores and pruning.

Neighbours are exact. S1 records and targets are dealt into blocks whose vectors travel packed, each pair of blocks is one sparse
product in an Arrow batch, and of its scores only the best of each record, and those of pairs that other blockers found, leave it:
no table of all pairs is stored or shuffled. Products are rough first (single precision, with a bound of the error); what may be
among the best is multiplied again in double precision. What leaves is ranked once more over all blocks, in one partitioning.

Limits hold for each S1 record and target source apart. Ties go to the smaller t_id; similarities are rounded to
``DIGITS`` before they are ranked, so that the order of summation doesn't decide.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import BlockingConfig
from ..functions import text
from ..session import by_merge, stored
from . import vectors

# Names of output columns, in the order of their bits.
BLOCKERS = ("b_name", "b_addr", "b_comb", "b_rare", "b_key", "b_postal", "b_acr")
BIT = {b: 1 << i for i, b in enumerate(BLOCKERS)}
# End of the fixed values.
DIGITS = vectors.DIGITS
#: Most records of a block, and rows of it that are multiplied at a time.
S1_BLOCK = 32768
TARGET_BLOCK = 131072
TILE = 32
#: Terms in more than one of so many targets of a block are multiplied as dense rows, the commonest of them in so many bytes.
DENSE = 50
DENSE_BYTES = 1 << 27
#: Records of a packed row; pairs that are multiplied at a time in double precision.
PACK = 4096
PAIRS_AT_ONCE = 1 << 14


def sides(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S1 records and targets."""
    return records.where("source = 'S1'"), records.where("source <> 'S1'")


def top_k(scored: DataFrame, score: str, k: int, least: float = 0.0) -> DataFrame:
    """The k best rows of each (s1_id, src) whose score is over ``least``; the plan keeps k rows a group before it shuffles."""
    rank = F.row_number().over(Window.partitionBy("s1_id", "src").orderBy(F.desc(score), "t_id"))
    return scored.where(F.col(score) > least).withColumn("rank", rank).where(F.col("rank") <= k)


def _terms(low: int, high: int):
    """Hashed character n-grams; which ones is of no matter here."""
    return lambda c: F.transform(text.char_grams(c, low, high), lambda g: F.xxhash64(g))


def record_vectors(records: DataFrame, config: BlockingConfig) -> DataFrame:
    """entity_id and src with the term hashes and the (not yet scaled) weights of name and address; of retrieval too where it has settings of its own."""
    low, high = config.char_ngram_range
    fields = {"n": ("name_core", low, high, 1.0), "a": ("addr_core", low, high, 1.0)}
    if own_retrieval(config):
        low, high = config.retrieval_ngram_range
        fields |= {"rn": ("name_core", low, high, config.retrieval_max_df), "ra": ("addr_core", low, high, config.retrieval_max_df)}
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), _terms(low, high)(F.col(c)).alias("terms")) for f, (c, low, high, _) in fields.items()]))
    terms = records.select("entity_id", each.alias("x")).select("entity_id", "x.field", F.explode("x.terms").alias("term"))
    counts = terms.groupBy("entity_id", "field", "term").agg(F.count(F.lit(1)).alias("tf"))
    total = F.broadcast(records.agg(F.count(F.lit(1)).alias("n")))  # one row
    most = reduce(lambda out, f: F.when(F.col("field") == f, F.lit(fields[f][3])).otherwise(out), fields, F.lit(1.0))
    df = counts.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df")).join(total).where((F.col("df") >= config.char_min_df) & (F.col("df") <= most * F.col("n")))
    weight = (1.0 + F.log("tf")) * (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0)
    weights = counts.join(by_merge(df), ["field", "term"]).select("entity_id", "field", "term", weight.alias("w"))
    own = lambda f, c: F.collect_list(F.when(F.col("field") == f, F.col(c)))
    lists = weights.groupBy("entity_id").agg(*[own(f, c).alias(f"{f}_{c}") for f in fields for c in ("term", "w")])
    empty = {"term": F.array().cast("array<long>"), "w": F.array().cast("array<double>")}
    out = records.select("entity_id", F.col("source").alias("src")).join(by_merge(lists), "entity_id", "left")
    return out.select("entity_id", "src", *[F.coalesce(f"{f}_{c}", empty[c]).alias(f"{f}_{c}") for f in fields for c in ("term", "w")])


def own_retrieval(config: BlockingConfig) -> bool:
    """Whether neighbours are searched with other vectors than they are scored with."""
    return config.retrieval_max_df < 1.0 or tuple(config.retrieval_ngram_range) != tuple(config.char_ngram_range)


class _Field:
    """The unit vectors of some records: equal ones are one class. ``of`` is each record's class; term, weight and row of each component are by class."""

    def __init__(self, packs: list[dict]):
        terms, weights = (np.concatenate([*(p[c] for p in packs), np.zeros(0, t)]) for c, t in (("term", np.int64), ("w", np.float64)))
        order = np.lexsort((weights, terms))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(terms[order]) != 0) | (np.diff(weights[order]) != 0)
        number = np.empty(len(order), np.int32)
        number[order] = np.cumsum(new) - 1
        starts = np.cumsum([0, *(len(p["term"]) for p in packs)])
        flat = np.concatenate([*(number[s + p["at"].astype(np.int64)] for s, p in zip(starts, packs, strict=False)), np.zeros(0, np.int32)])
        edge = np.cumsum([0, *np.concatenate([*(p["size"] for p in packs), np.zeros(0, np.int64)])])
        known: dict[bytes, int] = {}
        raw = flat.tobytes()
        # components are in the same order in every record, so equal vectors are equal bytes
        self.of = np.array([known.setdefault(raw[4 * s:4 * e], len(known)) for s, e in zip(edge[:-1], edge[1:], strict=True)], np.int64)
        self.n = len(known)
        at = np.frombuffer(b"".join(known), np.int32)
        size = np.array([len(k) // 4 for k in known], np.int64)
        self.edge = np.concatenate(([0], np.cumsum(size)))
        self.row = np.repeat(np.arange(self.n), size)
        self.term, w = terms[order][new][at], weights[order][new][at]
        length = np.sqrt(np.bincount(self.row, w * w, self.n))
        self.weight = w / np.maximum(length, 1e-300)[self.row]
        #: More than the error of a product in single precision.
        self.slack = (float(size.max(initial=0)) + 8.0) * 2.0**-23


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all stretches, one after the other."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


class _Targets:
    """Targets' classes by term: dense rows of common terms, postings of the others, in single precision; and their vectors in double."""

    def __init__(self, field: _Field):
        self.n, self.edge, self.weight = field.n, field.edge, field.weight
        self.term, self.at = np.unique(field.term, return_inverse=True)
        df = np.bincount(self.at, minlength=len(self.term))
        common = df * DENSE > self.n
        most = max(1, DENSE_BYTES // (4 * max(self.n, 1)))
        if common.sum() > most:
            common = np.zeros(len(df), bool)
            common[np.argsort(-df, kind="stable")[:most]] = True
        self.dense_row = np.where(common, np.cumsum(common) - 1, -1)
        self.dense = np.zeros((int(common.sum()), self.n), np.float32)
        held = common[self.at]
        self.dense[self.dense_row[self.at[held]], field.row[held]] = field.weight[held]
        order = np.argsort(self.at[~held], kind="stable")
        self.column, self.post = field.row[~held][order], field.weight[~held][order].astype(np.float32)
        self.size = np.where(common, 0, df)
        self.start = np.cumsum(self.size) - self.size
        self.slack = field.slack

    def asked(self, queries: _Field, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms (as targets number them), places and weights of some classes of queries; terms that no target has are left out."""
        size = queries.edge[rows + 1] - queries.edge[rows]
        span = _spread(queries.edge[rows], size)
        term, row, weight = queries.term[span], np.repeat(np.arange(len(rows)), size), queries.weight[span]
        at = np.minimum(np.searchsorted(self.term, term), max(len(self.term) - 1, 0))
        known = self.term[at] == term if len(self.term) else np.zeros(len(term), bool)
        return at[known], row[known], weight[known]

    def rough(self, asked: tuple[np.ndarray, np.ndarray, np.ndarray], n: int) -> np.ndarray:
        """The products of n classes of queries with all classes of targets, but for ``slack``."""
        at, row, weight = asked
        left = np.zeros((n, len(self.dense)), np.float32)
        dense = self.dense_row[at] >= 0
        left[row[dense], self.dense_row[at[dense]]] = weight[dense]
        out = left @ self.dense
        size = self.size[at]
        if size.any():
            # each component meets the postings of its term
            place = _spread(self.start[at], size)
            np.add.at(out.reshape(-1), np.repeat(row * self.n, size) + self.column[place], np.repeat(weight.astype(np.float32), size) * self.post[place])
        return out

    def exact(self, asked: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """The products of some of n classes of queries with as many classes of targets, rounded; equal pairs are multiplied once."""
        at, row, weight = asked
        pair, back = np.unique(rows * self.n + columns, return_inverse=True)
        r, c = pair // max(self.n, 1), pair % max(self.n, 1)
        term, place = np.unique(at, return_inverse=True)
        left = np.zeros((n, len(term) + 1))
        left[row, place] = weight
        local = np.full(len(self.term) + 1, len(term))
        local[term] = np.arange(len(term))
        out = np.zeros(len(pair))
        for s in range(0, len(pair), PAIRS_AT_ONCE):
            part = slice(s, s + PAIRS_AT_ONCE)
            size = self.edge[c[part] + 1] - self.edge[c[part]]
            span = _spread(self.edge[c[part]], size)
            of = np.repeat(np.arange(len(size)), size)
            out[part] = np.bincount(of, left[r[part][of], local[self.at[span]]] * self.weight[span], len(size))
        return np.round(out, DIGITS)[back]


def _nearly(scores: np.ndarray, k: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of all rough scores that may be among the k best of their row."""
    n = scores.shape[1]
    least = np.partition(scores, n - k, axis=1)[:, n - k, None] - np.float32(3 * slack) if k < n else np.full((len(scores), 1), -1.0, np.float32)
    cell = np.flatnonzero(scores >= np.maximum(least, np.float32(1e-10)))
    return cell // n, cell % n


class _Members:
    """The first records of each class, in the order of their ids."""

    def __init__(self, of: np.ndarray, n: int):
        self.order = np.argsort(of, kind="stable")
        self.count = np.bincount(of, minlength=n)
        self.start = np.cumsum(self.count) - self.count

    def best(self, rows: np.ndarray, classes: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and records of the k best positive scores of each row; ties to the first records."""
        size = np.where(scores > 0, np.minimum(self.count[classes], k), 0)
        record, row, score = self.order[_spread(self.start[classes], size)], np.repeat(rows, size), np.repeat(scores, size)
        order = np.lexsort((record, -score, row))
        row, record = row[order], record[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        return row[nth < k], record[nth < k]


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    """Records' vectors in one row: pairs of term and weight once, and their numbers in each record."""
    out = {"id": rows["entity_id"].tolist()}
    for f in (c[:-5] for c in rows.columns if c.endswith("_term")):
        size = np.array([len(t) for t in rows[f"{f}_term"]], np.int64)
        term, w = (np.concatenate([*rows[f"{f}_{c}"], np.zeros(0, t)]).astype(t) for c, t in (("term", np.int64), ("w", np.float64)))
        order = np.lexsort((w, term))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(term[order]) != 0) | (np.diff(w[order]) != 0)
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        at = at[np.lexsort((at, np.repeat(np.arange(len(size)), size)))]
        out[f] = {"term": term[order][new], "w": w[order][new], "at": at.astype(np.uint16 if new.sum() < 2**16 else np.uint32), "size": size}
    return pd.DataFrame({"src": [rows["src"].iloc[0]], "block": [rows["block"].iloc[0]], "data": [pickle.dumps(out, protocol=5)]})


NEAR = "s1_id string, t_id string, src string, found int, name_cos double, addr_cos double, name_near double, addr_near double"


def _near(packs: pd.DataFrame, pairs: pd.DataFrame, ks: tuple[int, int, int], weight: float, retrieval: bool) -> Iterator[pd.DataFrame]:
    """Of a block of S1 records and one of targets: each record's best targets by name, address and both, and all given pairs, with their scores."""
    names = [x.split()[0] for x in NEAR.split(", ")]
    left, right = ([pickle.loads(d) for d in packs["data"][own]] for own in (packs["src"] == "S1", packs["src"] != "S1"))
    if not left or not right:
        return
    source = packs["src"][packs["src"] != "S1"].iloc[0]
    ids, t_ids = (np.array([i for p in side for i in p["id"]], object) for side in (left, right))
    fields = ["n", "a", *(["rn", "ra"] if retrieval else [])]
    queries, found_in = {f: _Field([p[f] for p in left]) for f in fields}, {f: _Field([p[f] for p in right]) for f in fields}
    del left, right
    by_id, near = np.argsort(t_ids, kind="stable"), fields[-2:]
    t_ids, of = t_ids[by_id], {f: found_in[f].of[by_id] for f in fields}
    targets = {f: _Targets(found_in[f]) for f in fields}
    del found_in
    # targets with both vectors equal are one class
    both, both_of = np.unique(of[near[1]] * targets[near[0]].n + of[near[0]], return_inverse=True)
    both_class = dict(zip(near, (both % targets[near[0]].n, both // targets[near[0]].n), strict=True))
    members = [*(_Members(of[f], targets[f].n) for f in near), _Members(both_of, len(both))]
    slack = [*(max(targets[f].slack, queries[f].slack) for f in near), max(max(targets[f].slack, queries[f].slack) for f in near)]
    place = pd.Series(np.arange(len(ids)), ids)
    order = np.argsort(queries[near[0]].of, kind="stable")  # records of one name share its products
    tile_of = np.empty(len(ids), np.int64)
    tile_of[order] = np.arange(len(ids))
    given_row, given_column = tile_of[place.index.get_indexer(pairs["s1_id"])], pd.Index(t_ids).get_indexer(pairs["t_id"])
    sort = np.argsort(given_row, kind="stable")
    given_row, given_column, given_bits = given_row[sort], given_column[sort], pairs["found"].to_numpy()[sort]
    for s in range(0, len(ids), TILE):
        tile = order[s:s + TILE]
        own, inverse, asked = {}, {}, {}
        for f in fields:
            own[f], inverse[f] = np.unique(queries[f].of[tile], return_inverse=True)
            asked[f] = targets[f].asked(queries[f], own[f])
        rough = {f: targets[f].rough(asked[f], len(own[f])) for f in near}
        cells = []
        for f, k, which, error in zip(near, ks[:2], members[:2], slack[:2], strict=True):
            if k > 0:
                row, column = _nearly(rough[f], k, error)
                row, record = which.best(row, column, targets[f].exact(asked[f], len(own[f]), row, column), k)
                # what a class of queries found goes to each of its records
                count = np.bincount(row, minlength=len(own[f]))
                at = inverse[f]
                cells.append(np.repeat(np.arange(len(tile)), count[at]) * len(t_ids) + record[_spread((np.cumsum(count) - count)[at], count[at])])
        if ks[2] > 0:
            n, a = (np.take(rough[f], both_class[f], axis=1) for f in near)
            mixed = (np.float32(weight) * n)[inverse[near[0]]]
            mixed += (np.float32(1 - weight) * a)[inverse[near[1]]]
            row, column = _nearly(mixed, ks[2], slack[2])
            n, a = (targets[f].exact(asked[f], len(own[f]), inverse[f][row], both_class[f][column]) for f in near)
            row, record = members[2].best(row, column, np.round(weight * n + (1 - weight) * a, DIGITS), ks[2])
            cells.append(row * len(t_ids) + record)
        span = slice(*np.searchsorted(given_row, (s, s + len(tile))))
        known = given_column[span] >= 0
        given = (given_row[span][known] - s) * len(t_ids) + given_column[span][known]
        cell = np.unique(np.concatenate([*cells, given, np.zeros(0, np.int64)]).astype(np.int64))
        bits = np.zeros(len(cell), np.int64)
        bits[np.searchsorted(cell, given)] = given_bits[span][known]
        r, c = cell // len(t_ids), cell % len(t_ids)
        score = {f: targets[f].exact(asked[f], len(own[f]), inverse[f][r], of[f][c]) for f in fields}
        yield pd.DataFrame(dict(zip(names, (
            ids[tile][r], t_ids[c], source, bits, score["n"], score["a"], score[near[0]], score[near[1]]), strict=True)))


def _near_frame(packs: pd.DataFrame, pairs: pd.DataFrame, **settings) -> pd.DataFrame:
    out = list(_near(packs, pairs, **settings))
    return pd.concat(out) if out else pd.DataFrame({x.split()[0]: [] for x in NEAR.split(", ")})


def near_pairs(records: DataFrame, config: BlockingConfig, given: DataFrame | None = None) -> DataFrame:
    """Each S1 record's nearest targets, and the ``given`` pairs (s1_id, t_id, src, found): scores, and the ranks by name, address and both."""
    spark = records.sparkSession
    sizes = {r["src"]: r["count"] for r in records.groupBy(F.col("source").alias("src")).count().collect()}  # one row a source
    if given is None:
        given = spark.createDataFrame([], "s1_id string, t_id string, src string, found int")
    n_s1 = sizes.pop("S1", 0)
    right_blocks = {s: max(1, -(-n // TARGET_BLOCK)) for s, n in sizes.items()}
    # few blocks of S1 records: each is a copy of all targets
    wanted = -(-4 * spark.sparkContext.defaultParallelism // max(1, sum(right_blocks.values())))
    left_blocks = max(1, -(-n_s1 // S1_BLOCK), min(wanted, n_s1 // 256))
    block = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    of_source = lambda values, other: reduce(lambda out, s: F.when(F.col("src") == s, F.lit(values[s])).otherwise(out), values, F.lit(other))
    blocks_of = of_source(right_blocks, left_blocks)
    parts = of_source({s: max(1, -(-n // right_blocks[s] // PACK)) for s, n in sizes.items()}, max(1, -(-n_s1 // left_blocks // PACK)))
    rows = record_vectors(records, config).withColumn("block", block("entity_id", blocks_of)).withColumn("part", F.pmod(F.xxhash64("entity_id", F.lit(1)), parts))
    packs = stored(rows.groupBy("src", "block", "part").applyInPandas(_packed, "src string, block int, data binary"), "vectors")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    # S1 blocks meet the blocks of every source, each target block every S1 block
    sources = spark.createDataFrame([(s, n) for s, n in right_blocks.items()], "of string, n int")
    one = packs.where("src = 'S1'").join(F.broadcast(sources)).withColumn("b1", F.col("block")).withColumn("b2", every(F.col("n"))).drop("n")
    two = packs.where("src <> 'S1'").withColumn("of", F.col("src")).withColumn("b2", F.col("block")).withColumn("b1", every(F.lit(left_blocks)))
    pairs = given.withColumn("b1", block("s1_id", F.lit(left_blocks))).withColumn("of", F.col("src")).withColumn("b2", block("t_id", of_source(right_blocks, 1)))
    keys = ["b1", "of", "b2"]
    ks = (config.name_k, config.address_k, config.combined_k)
    near = one.unionByName(two).groupBy(*keys).cogroup(pairs.groupBy(*keys)).applyInPandas(
        partial(_near_frame, ks=ks, weight=config.combined_name_weight, retrieval=own_retrieval(config)), NEAR)
    both = F.round(config.combined_name_weight * F.col("name_near") + (1 - config.combined_name_weight) * F.col("addr_near"), DIGITS)
    rank = lambda c: F.row_number().over(Window.partitionBy("s1_id", "src").orderBy(F.desc(c), "t_id"))
    ranked = near.withColumn("comb", both)
    return ranked.select("*", rank("name_near").alias("name_rank"), rank("addr_near").alias("addr_rank"), rank("comb").alias("comb_rank"))


def _ids(df: DataFrame, name: str) -> DataFrame:
    out = df.withColumn(name, F.col("entity_id"))
    return out if name == "s1_id" else out.withColumn("src", F.col("source"))


def rare_token_pairs(records: DataFrame, config: BlockingConfig) -> DataFrame:
    """Pairs that share one of the S1 record's rarest name tokens."""
    s1, targets = sides(records)
    sizes = targets.groupBy(F.col("source").alias("src")).agg(F.count(F.lit(1)).alias("n"))
    postings = _ids(targets, "t_id").select("src", "t_id", F.explode(F.array_distinct("name_tokens")).alias("token"))
    postings = postings.where((F.length("token") >= 3) | F.col("token").rlike(r"^\p{Nd}+$"))
    usable = postings.groupBy("src", "token").agg(F.count(F.lit(1)).alias("df")).join(F.broadcast(sizes), "src").where(
        F.col("df") <= F.greatest(F.lit(config.rare_min_df), F.floor(config.rare_df_frac * F.col("n")))).select("src", "token", "df")
    own = _ids(s1, "s1_id").select("s1_id", F.explode(F.array_distinct("name_tokens")).alias("token"))
    rank = F.row_number().over(Window.partitionBy("s1_id", "src").orderBy("df", "token"))
    chosen = own.join(by_merge(usable), "token").withColumn("_r", rank).where(F.col("_r") <= config.rare_tokens_per_record)
    return chosen.select("s1_id", "src", "token").join(by_merge(postings), ["src", "token"]).select("s1_id", "t_id", "src").distinct()


def _keys(side: DataFrame, id_name: str) -> DataFrame:
    skeletons = F.array_join(F.array_sort(F.array_distinct("name_skel")), " ")
    keys = F.array(F.struct(F.lit(1).alias("kind"), skeletons.alias("key")), F.struct(F.lit(2).alias("kind"), F.col("name_nospace").alias("key")))
    out = _ids(side, id_name).select(id_name, *(["src"] if id_name == "t_id" else []), F.explode(keys).alias("k"))
    return out.select(id_name, *(["src"] if id_name == "t_id" else []), "k.kind", "k.key").where(
        ((F.col("kind") == 1) & (F.col("key") != "")) | ((F.col("kind") == 2) & (F.length("key") >= 3)))


def exact_key_pairs(records: DataFrame, config: BlockingConfig) -> DataFrame:
    """Pairs with equal sets of sound keys or equal names without blanks; a target bucket over the limit is ignored whole."""
    s1, targets = sides(records)
    right = _keys(targets, "t_id")
    small = right.groupBy("src", "kind", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= config.key_max_bucket).drop("n")
    return _keys(s1, "s1_id").join(by_merge(small), ["kind", "key"]).join(by_merge(right), ["src", "kind", "key"]).select("s1_id", "t_id", "src").distinct()


def shared_postal(records: DataFrame, config: BlockingConfig) -> DataFrame:
    """Pairs that share a postal code; a code of more targets of a source than the limit is ignored whole."""
    s1, targets = sides(records)
    right = _ids(targets, "t_id").select("t_id", "src", F.explode(F.array_distinct("addr_postal")).alias("code"))
    small = right.groupBy("src", "code").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= config.postal_max_bucket).drop("n")
    left = _ids(s1, "s1_id").select("s1_id", F.explode(F.array_distinct("addr_postal")).alias("code"))
    return left.join(by_merge(small), "code").join(by_merge(right), ["src", "code"]).select("s1_id", "t_id", "src").distinct()


def acronym_pairs(records: DataFrame, config: BlockingConfig) -> DataFrame:
    """Pairs in which one side's acronym is the other's single token."""
    s1, targets = sides(records)
    single = F.when((F.size("name_tokens") == 1) & (F.length(F.get("name_tokens", F.lit(0))) >= 2), F.get("name_tokens", F.lit(0)))
    alphabetic = F.when(single.rlike(r"^\p{L}+$"), single)
    acronym = F.when(F.length("name_acronym") >= 2, F.col("name_acronym"))

    def heads(key: Column) -> DataFrame:
        rows = _ids(targets, "t_id").select("t_id", "src", key.alias("key")).where("key is not null")
        rank = F.row_number().over(Window.partitionBy("src", "key").orderBy("t_id"))
        return rows.withColumn("_r", rank).where(F.col("_r") <= config.acronym_head).drop("_r")

    own = lambda key: _ids(s1, "s1_id").select("s1_id", key.alias("key")).where("key is not null")
    return own(acronym).join(by_merge(heads(alphabetic)), "key").unionByName(own(single).join(by_merge(heads(acronym)), "key")).select("s1_id", "t_id", "src").distinct()


def other_pairs(records: DataFrame, config: BlockingConfig) -> DataFrame:
    """One row a pair that blockers without vectors found, with their bits; postal codes are still to be ranked."""
    tag = lambda df, b: df.select("s1_id", "t_id", "src", F.lit(BIT[b]).alias("bit"))
    found = tag(rare_token_pairs(records, config), "b_rare")
    if config.use_exact_keys:
        found = found.unionByName(tag(exact_key_pairs(records, config), "b_key"))
    if config.use_postal_block:
        found = found.unionByName(tag(shared_postal(records, config), "b_postal"))
    if config.use_acronym_block:
        found = found.unionByName(tag(acronym_pairs(records, config), "b_acr"))
    return found.groupBy("s1_id", "t_id", "src").agg(F.bit_or("bit").alias("found"))


def union_bits(near: DataFrame, config: BlockingConfig) -> DataFrame:
    """``near_pairs`` that some blocker found, with all that did: bits, a flag each, and their number."""
    postal = F.col("found").bitwiseAND(F.lit(BIT["b_postal"])) != 0
    close = postal & (F.col("name_cos") > config.postal_min_cosine)
    nth = F.row_number().over(Window.partitionBy("s1_id", "src").orderBy(F.desc(close), F.desc("name_cos"), "t_id"))
    tests = {
        "b_name": (F.col("name_near") > 0) & (F.col("name_rank") <= config.name_k), "b_addr": (F.col("addr_near") > 0) & (F.col("addr_rank") <= config.address_k),
        "b_comb": (F.col("comb") > 0) & (F.col("comb_rank") <= config.combined_k), "b_postal": close & (F.col("_postal") <= config.postal_k)}
    flags = {b: tests.get(b, F.col("found").bitwiseAND(F.lit(BIT[b])) != 0).cast("int") for b in BLOCKERS}
    bits = reduce(Column.__add__, [flag * BIT[b] for b, flag in flags.items()])
    out = near.withColumn("_postal", nth).select("s1_id", "t_id", "src", bits.alias("bits"), *[v.alias(b) for b, v in flags.items()], "name_cos", "addr_cos")
    return out.where("bits <> 0").withColumn("n_blocks", F.bit_count("bits"))


def cheap_score(name_cos: Column, addr_cos: Column, name_missing: Column, addr_missing: Column, weight: float = 0.6) -> Column:
    """A weighted mean; only the name where an address is missing, only the address where a name is."""
    return F.when(name_missing, addr_cos).when(addr_missing, name_cos).otherwise(weight * name_cos + (1 - weight) * addr_cos)


def with_cheap(pairs: DataFrame, records: DataFrame, weight: float) -> DataFrame:
    """``pairs`` with the cheap score."""
    flags = records.select("entity_id", "name_missing", "addr_missing")
    scored = pairs.join(by_merge(flags.toDF("t_id", "_n2", "_a2")), "t_id").join(by_merge(flags.toDF("s1_id", "_n1", "_a1")), "s1_id")
    cheap = cheap_score(F.col("name_cos"), F.col("addr_cos"), F.col("_n1") | F.col("_n2"), F.col("_a1") | F.col("_a2"), weight)
    return scored.withColumn("cheap", F.round(cheap, DIGITS)).drop("_n1", "_a1", "_n2", "_a2")


def prune(scored: DataFrame, config: BlockingConfig) -> DataFrame:
    """Protected pairs and the best by each of three scores; the ranks share one partitioning."""
    rank = lambda c: F.row_number().over(Window.partitionBy("s1_id", "src").orderBy(F.desc(c), "t_id"))
    ranked = scored.select("*", rank("cheap").alias("_c"), rank("name_cos").alias("_n"), rank("addr_cos").alias("_a"))
    keep = (
        ((F.col("b_key") == 1) | (F.col("b_acr") == 1))
        | ((F.col("_c") <= config.max_candidates_per_source) & (F.col("cheap") >= config.min_cheap_score))
        | ((F.col("_n") <= config.keep_top_name) & (F.col("name_cos") >= config.min_cheap_score))
        | ((F.col("_a") <= config.keep_top_address) & (F.col("addr_cos") >= config.keep_address_cosine))
    )
    return ranked.where(keep).drop("_c", "_n", "_a")


def union_pairs(records: DataFrame, config: BlockingConfig) -> DataFrame:
    """The union of all blockers with both cosines of each pair, not pruned."""
    return union_bits(near_pairs(records, config, other_pairs(records, config)), config)


def generate_candidates(records: DataFrame, config: BlockingConfig | None = None) -> DataFrame:
    """All blockers, their union, scores and pruning."""
    config = config or BlockingConfig()
    return prune(with_cheap(union_pairs(records, config), records, config.combined_name_weight), config)
