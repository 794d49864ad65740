"""Readers, writers, rules, metrics, graph, decisions and the whole pipeline on generated splits."""

import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kithlink.config import BlockingConfig, Config
from kithlink.operators import blocking, decision, explore, features, graph, matcher, metrics, normalize, vectors
from kithlink.plans import cli, pipeline
from kithlink.session import stored
from kithlink.sources import records, sinks

NAMES = ["Acme", "Blue Sky", "Sharma", "Lakshmi", "Delta", "Orion", "Kumar", "Green Field", "Nova", "Summit", "Harbor", "Vertex", "Maple", "Cedar"]
KINDS = ["Traders", "Industries", "Pharma", "Engineering", "Foods", "Textiles", "Motors", "Logistics"]
ROADS = ["Main Street", "M.G. Road", "Rue de Lyon", "Park Avenue", "Lake Drive"]


def write_split(folder, split, n, seed=1):
    """A split with matches in either source, shared and unmatched targets, missing fields and odd characters."""
    rng = random.Random(seed)
    sides, truth = {1: [], 2: [], 3: []}, []
    for i in range(n):
        name = f"{rng.choice(NAMES)} {rng.choice(NAMES)} {rng.choice(KINDS)} {i}"
        place, country = f"{rng.randint(1, 99)} {rng.choice(ROADS)}, City {i % 17}, {10000 + i}", rng.choice(["India", "France"])
        sides[1].append((f"S1-{i}", f"{name} Ltd", place, country))
        matched = []
        for s in (2, 3):
            for k in range(rng.choice([0, 1, 1, 2]) if i % 4 else 0):
                other = f"{name} Limited" if k else name.replace("a", "aa", 1)
                sides[s].append((f"S{s}-{i}x{k}", other, place if rng.random() < 0.8 else "", country if rng.random() < 0.9 else "n/a"))
                matched.append(f"S{s}-{i}x{k}")
        truth.append((f"S1-{i}", ",".join(matched)))
    for s in (2, 3):
        sides[s] += [(f"S{s}-free{i}", f"{rng.choice(NAMES)} {rng.choice(KINDS)} \"{i}", "", "India") for i in range(n // 3)]
    base = folder / split
    base.mkdir(parents=True)
    for s, rows in sides.items():
        lines = ["\t".join(records.RECORD_COLUMNS), *("\t".join(r) for r in rows)]
        (base / f"{split}_source{s}.tsv").write_text("﻿" * (s == 2) + "\n".join(lines) + "\n\n", "utf-8")
    (base / f"{split}_ground_truth.tsv").write_text("\n".join("\t".join(r) for r in [records.TRUTH_COLUMNS, *truth]) + "\n", "utf-8")
    return truth


def test_read_tsv(spark, tmp_path):
    path = tmp_path / "x.tsv"
    path.write_text('﻿id \t name\n1\t"a\n\n2\n3\tNA\n', "utf-8")
    rows = records.read_tsv(spark, str(path))
    assert rows.columns == ["id", "name"] and sorted(map(tuple, rows.collect())) == [("1", '"a'), ("2", ""), ("3", "NA")]
    path.write_text("a\tb\n1\t2\t3\n", "utf-8")
    with pytest.raises(records.ContractError):
        records.read_tsv(spark, str(path))


def test_record_contract(spark):
    rows = spark.createDataFrame([("S1-1", "a", "b", "c"), ("S1-1", "a", None, "c")], ", ".join(f"{c} string" for c in records.RECORD_COLUMNS))
    with pytest.raises(records.ContractError):
        records.check_records(rows, "S1-")
    with pytest.raises(records.ContractError):
        records.check_records(rows, "S2-")
    with pytest.raises(records.ContractError):
        records.check_records(rows.drop("country"), "S1-")


def test_config():
    config = Config.from_dict({"blocking": {"name_k": 3, "char_ngram_range": [2, 3]}})
    assert config.blocking.name_k == 3 and config.blocking.char_ngram_range == (2, 3)
    with pytest.raises(KeyError):
        Config.from_dict({"blocking": {"nope": 1}})
    with pytest.raises(KeyError):
        Config.from_dict({"nope": {}})
    assert Config.from_dict(json.loads(json.dumps(Config().to_dict()))).to_dict() == Config().to_dict()


def test_rules(spark):
    lists = spark.createDataFrame([
        (2, ["S1-1", "S2-1,S2-1"]), (3, ["S1-1", "S2-1, S3-9"]), (4, ["S1-2", "S1-1"]), (5, ["S1-9", ""]), (6, ["S1-3", "a", "b"]), (7, ["S1-4"])], "line int, fields array<string>")
    s1 = spark.createDataFrame([(f"S1-{i}",) for i in (1, 2, 3, 4)], "s1_id string")
    targets = spark.createDataFrame([("S2-1",)], "t_id string")
    found = {(r["rule"], r["key"]) for r in sinks.list_violations(lists, s1, targets).collect()}
    assert found == {
        ("duplicate ids in a list", "line 2"), ("duplicate source1_entity_id", "S1-1"), ("empty id or whitespace", "line 3"), ("unknown target", "line 3"),
        ("not an S2 or S3 id", "line 4"), ("unknown S1 record", "S1-9"), ("not two columns", "line 6"), ("S1 record missing", "S1-3")}


def test_fbeta_truth_table(spark):
    rows = spark.createDataFrame([(0, 0, 0), (0, 1, 0), (0, 0, 2), (1, 1, 1), (1, 2, 1)], "tp int, p int, t int")
    got = [r[0] for r in rows.select(metrics.fbeta(F.col("tp"), F.col("p"), F.col("t"))).collect()]
    assert got == [1.0, 0.0, 0.0, 1.0, pytest.approx(1.25 / 2.25)]


def brute_expected_f(p, k, b2=0.25):
    total = 0.0
    for bits in itertools.product((0, 1), repeat=len(p)):
        prob = np.prod([x if b else 1 - x for x, b in zip(p, bits, strict=True)])
        tp, true = sum(bits[:k]), sum(bits)
        total += prob * (1.0 if k == 0 and true == 0 else 0.0 if b2 * true + k == 0 else (1 + b2) * tp / (b2 * true + k))
    return total


@pytest.mark.parametrize("p", [[0.9, 0.5, 0.1], [0.3], [0.99, 0.98, 0.97, 0.2], [0.05, 0.04]])
def test_expected_f(p):
    values = decision.expected_f(np.array(p))
    assert values == pytest.approx([brute_expected_f(p, k) for k in range(len(p) + 1)])
    assert decision.best_k(np.array(p)) == int(np.argmax(values))


def test_policies(spark):
    rows = [("S1-1", "S2-1", "S2", 0.9, 1), ("S1-2", "S2-1", "S2", 0.8, 0), ("S1-2", "S3-1", "S3", 0.6, 1), ("S1-3", "S3-2", "S3", 0.2, 0)]
    pairs = spark.createDataFrame(rows, "s1_id string, t_id string, src string, p double, y int")
    keys = lambda df: {(r["s1_id"], r["t_id"]) for r in df.collect()}
    assert keys(decision.apply_policy(pairs, decision.Policy(threshold=0.5))) == {("S1-1", "S2-1"), ("S1-2", "S2-1"), ("S1-2", "S3-1")}
    assert keys(decision.apply_policy(pairs, decision.Policy(threshold=0.5, exclusive=True))) == {("S1-1", "S2-1"), ("S1-2", "S3-1")}
    assert keys(decision.apply_policy(pairs, decision.Policy("source_threshold", False, 0.5, {"S2": 0.85}))) == {("S1-1", "S2-1"), ("S1-2", "S3-1")}
    assert ("S1-1", "S2-1") in keys(decision.apply_policy(pairs, decision.Policy("expected_f", True)))
    truth = pairs.where("y = 1").select("s1_id", "t_id")
    folds = spark.createDataFrame([("S1-1", 0), ("S1-2", 1), ("S1-3", 0), ("S1-4", 1)], "s1_id string, fold int")
    policy, table, crossfit = decision.tune_policy(pairs, truth, folds)
    assert len(table) == 838 and table["macro_f"].max() == pytest.approx(1.0) and 0 <= crossfit <= 1
    kept = decision.apply_policy(pairs, policy)
    assert metrics.macro_fbeta(kept, truth, folds.select("s1_id")) == pytest.approx(table["macro_f"][table["policy"] == policy.describe()].max())


def test_components_and_folds(spark):
    rng = random.Random(3)
    edges = [(f"S1-{rng.randint(0, 150)}", f"S2-{rng.randint(0, 150)}") for _ in range(120)] + [(f"S1-c{i}", f"S2-c{i + d}") for i in range(30) for d in (0, 1)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        up[max(root(a), root(b))] = min(root(a), root(b))
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "u string, v string")).collect()}
    groups = {}
    for x in up:
        groups.setdefault(root(x), set()).add(x)
    assert got == {x: min(g) for g in groups.values() for x in g}
    truth = spark.createDataFrame(edges, "s1_id string, t_id string")
    spine = spark.createDataFrame([(x,) for x in {a for a, _ in edges} | {"S1-alone"}], "s1_id string")
    folds = {r["s1_id"]: r["fold"] for r in graph.make_folds(truth, spine, spine.withColumn("country", F.lit("x")), 5).collect()}
    assert len(folds) == spine.count() and set(folds.values()) <= set(range(5))
    for g in groups.values():
        assert len({folds[x] for x in g if x.startswith("S1-")}) == 1


def test_calibrator(spark):
    step = matcher.Calibrator([0.1, 0.4, 0.8], [0.0, 0.5, 1.0])
    rows = spark.createDataFrame([(x,) for x in (0.0, 0.1, 0.25, 0.4, 0.6, 0.8, 0.9)], "p double")
    assert [r[0] for r in rows.select(step.column(F.col("p"))).collect()] == pytest.approx(np.interp([0, 0.1, 0.25, 0.4, 0.6, 0.8, 0.9], step.knots, step.values))


def test_ranking_metrics_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(300)]
    got = metrics.ranking_metrics(spark.createDataFrame(rows, "p double, y int")).first()
    pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
    assert got["auc"] == pytest.approx(np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg]))
    ap = sum(np.mean([y for p, y in rows if p >= s]) * sum(p == s and y for p, y in rows) for s in {p for p, _ in rows}) / len(pos)
    assert got["average_precision"] == pytest.approx(ap)


def test_whole_pipeline(spark, tmp_path, monkeypatch):
    write_split(tmp_path, "train", 90, seed=1)
    write_split(tmp_path, "test", 40, seed=2)
    (tmp_path / "config.json").write_text(json.dumps({"model": {"n_folds": 2, "max_iter": 4, "max_depth": 3, "min_instances": 5}, "blocking": {"char_min_df": 2}}))
    monkeypatch.chdir(tmp_path)
    assert cli.main(["run", "--data-dir", str(tmp_path), "--config", str(tmp_path / "config.json"), "--out", str(tmp_path / "out"), "--model", str(tmp_path / "model")], spark) == 0
    report = json.loads((tmp_path / "out/report.json").read_text())
    assert report["headline"]["macro_f"] > 0.6
    data = records.load_split(spark, str(tmp_path), "train")
    assert all(r["ok"] for r in records.check_ground_truth(data).collect())
    assert data.summary()["s1"] == 90 and explore.overview(data.records).count() == 3
    loaded = pipeline.TrainedPipeline.load(str(tmp_path / "model"))
    assert loaded.policy.describe() == report["policy"]
    files = [str(tmp_path / "out" / f) for f in ("matching_results.tsv", "candidate_pairs.tsv")]
    test = records.load_split(spark, str(tmp_path), "test")
    value = pipeline.score_file(spark, test.truth, test.spine, records.read_tsv(spark, files[0]))
    bound = pipeline.score_file(spark, test.truth, test.spine, records.read_tsv(spark, files[1]))
    assert 0 < value <= 1 and bound <= 1
    (tmp_path / "out/matching_results.tsv").write_text("wrong\theader\n")
    errors, _ = sinks.validate_submission(spark, *files, test.spine, test.targets.select(F.col("entity_id").alias("t_id")))
    assert errors


def test_exact_keys_on_a_stream(spark, tmp_path):
    from kithlink.operators.normalize import normalize_records
    from kithlink.streaming.link import exact_key_stream

    schema = ", ".join(f"{c} string" for c in records.RECORD_COLUMNS)
    targets = normalize_records(spark.createDataFrame([("S2-1", "Agarwal Foods", "", ""), ("S3-1", "Other", "", "")], schema))
    spark.createDataFrame([("S1-1", "Aggarwal Foods Ltd", "", "")], schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    run = exact_key_stream(stream, targets).writeStream.format("memory").queryName("linked").start()
    run.processAllAvailable()
    run.stop()
    assert {(r["s1_id"], r["t_id"]) for r in spark.table("linked").collect()} == {("S1-1", "S2-1")}


def plain_near(rows, config):
    """Every pair's cosines by dictionaries, and each record's best."""
    def grams(words):
        out = []
        for w in words.split():
            padded = f" {w} "
            for n in (3, 4):
                if n == 3 or len(padded) >= n:
                    out += [padded[i : i + n] for i in range(max(len(padded) - n + 1, 1))]
        return out

    def units(column):
        bags = {i: grams(r[column]) for i, r in rows.items()}
        df = {}
        for g in bags.values():
            for t in set(g):
                df[t] = df.get(t, 0) + 1
        out = {}
        for i, g in bags.items():
            w = {t: (1 + np.log(g.count(t))) * (np.log((1 + len(rows)) / (1 + df[t])) + 1) for t in set(g) if df[t] >= config.char_min_df}
            size = np.sqrt(sum(x * x for x in w.values()))
            out[i] = {t: x / size for t, x in w.items()}
        return out

    name, addr = units("name_core"), units("addr_core")
    dot = lambda a, b: round(sum(x * b[t] for t, x in a.items() if t in b), 9)
    found = {}
    for s in (i for i, r in rows.items() if r["source"] == "S1"):
        for src in ("S2", "S3"):
            near = [(t, dot(name[s], name[t]), dot(addr[s], addr[t])) for t, r in rows.items() if r["source"] == src]
            near = [(t, n, a, round(0.6 * n + 0.4 * a, 9)) for t, n, a in near]
            for i, k, b in ((1, config.name_k, 1), (2, config.address_k, 2), (3, config.combined_k, 4)):
                for t, n, a, _ in sorted((x for x in near if x[i] > 0), key=lambda x: (-x[i], x[0]))[:k]:
                    found[s, t] = (found.get((s, t), (0,))[0] | b, n, a)
    return found


@pytest.mark.parametrize("sizes", [(2048, 8192, 12), (7, 5, 2), (16, 300, 10**6)])
def test_neighbours_over_blocks(spark, monkeypatch, sizes):
    """Few or many blocks, all terms dense or none: the same neighbours, ties and copies included."""
    from kithlink.operators import blocking
    from kithlink.config import BlockingConfig

    for name, value in zip(("S1_BLOCK", "TARGET_BLOCK", "DENSE"), sizes, strict=True):
        monkeypatch.setattr(blocking, name, value)
    monkeypatch.setattr(blocking, "TILE", 4)
    rng, config = random.Random(7), BlockingConfig(char_min_df=2, name_k=5, address_k=3, combined_k=4)
    rows = {}
    for i in range(70):
        words = " ".join(rng.choice(NAMES).lower() for _ in range(rng.randint(0, 3)))
        rows[f"S{1 + i % 3}-{i}"] = {"name_core": words, "addr_core": rng.choice(["", "main road 5", f"lake drive {i}"]), "source": f"S{1 + i % 3}"}
    table = spark.createDataFrame([(i, r["source"], r["name_core"], r["addr_core"]) for i, r in rows.items()], "entity_id string, source string, name_core string, addr_core string")
    near = blocking.union_bits(blocking.near_pairs(table, config), config)
    got = {(r["s1_id"], r["t_id"]): (r["bits"], r["name_cos"], r["addr_cos"]) for r in near.collect()}
    assert got == plain_near(rows, config) and len(got) > 200
    assert blocking.near_pairs(table.limit(0), config).count() == 0 and blocking.near_pairs(table.where("source = 'S1'"), config).count() == 0


def test_lines_of_a_file_in_blocks(spark, tmp_path):
    path = tmp_path / "x.tsv"
    path.write_text("".join(f"S1-{i}\tS2-{i},S3-{i}\n" for i in range(3000)), "utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = sinks.parsed_lines(spark, str(path))
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 1
        assert [(r["line"], r["fields"][0]) for r in lines.orderBy("line").collect()] == [(i + 1, f"S1-{i}") for i in range(3000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_violations_of_both_files(spark, tmp_path):
    spine = spark.createDataFrame([("S1-1",), ("S1-2",)], "s1_id string")
    targets = spark.createDataFrame([("S2-1",), ("S3-1",)], "t_id string")
    (tmp_path / "matching_results.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\nS1-2\tS3-1\n")
    (tmp_path / "candidate_pairs.tsv").write_text("source1_entity_id\tcandidate_entity_ids\r\nS1-1\tS2-1\r\nS1-2\r\n")
    paths = [str(tmp_path / f) for f in ("matching_results.tsv", "candidate_pairs.tsv")]
    errors, warnings = sinks.validate_submission(spark, *paths, spine, targets)
    assert errors == [] and len(warnings) == 1 and "S1-2" in warnings[0] and "S3-1" in warnings[0]
    errors, _ = sinks.validate_submission(spark, paths[0], str(tmp_path / "none.tsv"), spine, targets)
    assert len(errors) == 1 and "not found" in errors[0]


def test_others_true():
    p = np.array([0.9, 0.5, 0.2, 0.0, 1.0])
    table = decision.others_true(p)
    for i in range(len(p)):
        rest = [x for j, x in enumerate(p) if j != i]
        want = np.zeros(len(p))
        for bits in itertools.product((0, 1), repeat=len(rest)):
            want[sum(bits)] += np.prod([x if b else 1 - x for x, b in zip(rest, bits, strict=True)])
        assert table[i] == pytest.approx(want)


def test_country_holdout_and_sweep(spark, tmp_path):
    write_split(tmp_path, "train", 60, seed=3)
    data = records.load_split(spark, str(tmp_path), "train")
    config = Config.from_dict({"model": {"max_iter": 2, "max_depth": 2, "min_instances": 5}, "blocking": {"char_min_df": 2}})
    prepared = pipeline.prepare_split(data, config)
    rows = pipeline.country_holdout(data, config, prepared, 2)
    assert sorted(r["country"] for r in rows) == ["france", "india"] and sum(r["entities"] for r in rows) == 60 and all(0 <= r["macro_f"] <= 1 for r in rows)
    swept = pipeline.blocking_sweep(data, prepared.views, [{"name_k": 1, "combined_k": 1}, {"name_k": 20}], config)
    assert swept[0]["candidate_pairs"] < swept[1]["candidate_pairs"] and swept[0]["name_k"] == 1


def test_products_of_pairs_are_rounded(spark):
    """To nine digits before anything rounds them again, as the blockers' are: 0.12345649996 is 0.1234565."""
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-2")], "s1_id string, t_id string")
    postings = spark.createDataFrame([("S1-1", "a", 1.0), ("S2-1", "a", 0.12345649996), ("S2-2", "b", 1.0)], "entity_id string, term string, weight double")
    assert {r["t_id"]: r["cos"] for r in vectors.pair_dot(pairs, postings, "cos").collect()} == {"S2-1": 0.1234565, "S2-2": 0.0}


def test_tables_that_grow_are_not_broadcast(spark):
    """Spark guesses exploded and packed tables far too small; broadcast, they go through the driver. Tables of one row a source may."""
    config = BlockingConfig()
    rows = [("S1-1", "Acme Blue Traders", "1 Main Street, Pune 100001", "India", "S1"), ("S2-1", "Acme Blue Traders", "1 Main St., Pune 100001", "India", "S2")]
    views = stored(normalize.normalize_records(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string, source string")), "views")
    pairs = stored(spark.createDataFrame([("S1-1", "S2-1", "S2", 0.9, 0.8)], "s1_id string, t_id string, src string, name_cos double, addr_cos double"), "pairs")
    truth = stored(spark.createDataFrame([("S1-1", "S2-1")], "s1_id string, t_id string"), "truth")
    found = {
        "vectors": blocking.record_vectors(views, config), "keys": blocking.exact_key_pairs(views, config), "postal": blocking.shared_postal(views, config),
        "acronyms": blocking.acronym_pairs(views, config), "rare": blocking.rare_token_pairs(views, config), "cheap": blocking.with_cheap(pairs, views, 0.6),
        "tfidf": vectors.char_tfidf(views, "name_core"), "dot": vectors.pair_dot(pairs, vectors.char_tfidf(views, "name_core"), "cos"),
        "idf": features.with_idf(views, "name_tokens", "name"), "labels": matcher.label_pairs(pairs, truth)}
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    assert {k: v._jdf.queryExecution().sparkPlan().toString().count("BroadcastHashJoin") for k, v in found.items()} == {k: int(k == "rare") for k in found}


def test_equal_vectors_are_multiplied_once(monkeypatch):
    """A thousand copies of a target and of a record cost one product; each record gets the first copies."""
    import pandas as pd
    from kithlink.operators import blocking

    def pack(source, names):
        table = pd.DataFrame({"entity_id": [f"{source}-{i:04d}" for i in range(len(names))], "src": source, "block": 0})
        for f in "na":
            table[f"{f}_term"], table[f"{f}_w"] = [[1, 2] if n else [2, 3] for n in names], [[1.0, 2.0]] * len(names)
        return blocking._packed(table)

    pairs, exact = [], blocking._Targets.exact
    monkeypatch.setattr(blocking._Targets, "exact", lambda self, asked, n, rows, columns: pairs.append(len(rows)) or exact(self, asked, n, rows, columns))
    monkeypatch.setattr(blocking, "TILE", 1000)
    packs = pd.concat([pack("S1", [True] * 1000), pack("S2", [False, *[True] * 1000, False])], ignore_index=True)
    near = blocking._near_frame(packs, pd.DataFrame({"s1_id": [], "t_id": [], "found": []}), ks=(5, 3, 0), weight=0.6, retrieval=False)
    assert pairs[:2] == [2, 2]  # by name and by address: both classes of targets, for the only class of records
    best = near.groupby("s1_id")["t_id"].agg(list)
    assert len(best) == 1000 and set(map(tuple, best)) == {("S2-0001", "S2-0002", "S2-0003", "S2-0004", "S2-0005")}


def test_queries_train_as_shipped(spark, monkeypatch):
    """The queries on the matcher train all its folds with the default settings, not few and shallow trees."""
    from kithlink.config import ModelConfig
    from kithlink.plans import queries

    seen = []

    def train(rows, folds, config=None):
        seen.append((config or ModelConfig(), folds.select("fold").distinct().count()))
        return matcher.Matcher([], None, {"name_char_cos": 1.0}), rows

    monkeypatch.setattr(queries.matcher, "train_matcher", train)
    assert queries.QUERIES["a25_importances"](spark, "/root/testdata/sf0.001").count() == 1
    assert seen == [(ModelConfig(), ModelConfig().n_folds)]
