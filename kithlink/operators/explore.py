"""Profiles of a split: counts, cardinalities, usage of targets, consistency, completeness, similarities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity, text
from . import vectors


def country_table(records: DataFrame) -> DataFrame:
    """Records by country label and source."""
    counted = records.select(text.country_label(F.col("country")).alias("country"), "source")
    return counted.groupBy("country").pivot("source", ["S1", "S2", "S3"]).count().na.fill(0)


def overview(records: DataFrame) -> DataFrame:
    """By source, the number of records and the labels with theirs."""
    labels = records.groupBy("source", text.country_label(F.col("country")).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "label", "n"))), lambda x: F.concat(x["label"], F.lit("="), x["n"].cast("string")))
    return labels.groupBy("source").agg(F.sum("n").alias("records"), F.array_join(listed, ", ").alias("countries"))


def match_counts(truth: DataFrame, spine: DataFrame, countries: DataFrame) -> DataFrame:
    """n_total, n_s2, n_s3 and country of every S1 record."""
    n = lambda s: F.count(F.when(F.col("t_id").startswith(s), 1))
    counts = truth.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_total"), n("S2-").alias("n_s2"), n("S3-").alias("n_s3"))
    rows = spine.select("s1_id").join(counts, "s1_id", "left").na.fill(0, ["n_total", "n_s2", "n_s3"])
    return rows.join(countries, "s1_id", "left").withColumn("country", text.country_label(F.col("country")))


def cardinality_shares(counts: DataFrame) -> DataFrame:
    """grp ("all" or a country), bucket and its share of the group."""
    rows = counts.select(F.explode(F.array(F.lit("all"), F.col("country"))).alias("grp"), text.cardinality_bucket(F.col("n_total")).alias("bucket"))
    sizes = rows.groupBy("grp", "bucket").agg(F.count(F.lit(1)).alias("n"))
    return sizes.select("grp", "bucket", (F.col("n") / F.sum("n").over(Window.partitionBy("grp"))).alias("share"))


def cardinality_by_source(counts: DataFrame) -> DataFrame:
    """matches (0 to 3+) and the shares of S1 records with so many in either source."""
    rows = counts.select(F.explode(F.array(*[F.struct(F.lit(s).alias("src"), text.cardinality_bucket(F.col(f"n_{s}")).alias("matches")) for s in ("s2", "s3")])).alias("x"))
    sizes = rows.groupBy("x.matches").agg(*[F.count(F.when(F.col("x.src") == s, 1)).alias(s) for s in ("s2", "s3")])
    whole = Window.partitionBy(F.lit(1))  # four rows at most
    return sizes.select("matches", *[(F.col(s) / F.greatest(F.sum(s).over(whole), F.lit(1))).alias(s) for s in ("s2", "s3")])


def cardinality_stats(counts: DataFrame) -> DataFrame:
    share = lambda c: F.avg(c.cast("double"))
    return counts.agg(
        F.avg("n_total").alias("mean_matches"), F.max("n_total").alias("max_matches"), F.max("n_s2").alias("max_s2"), F.max("n_s3").alias("max_s3"),
        share((F.col("n_s2") > 0) & (F.col("n_s3") > 0)).alias("in_both"), share((F.col("n_s2") > 1) | (F.col("n_s3") > 1)).alias("several_in_one"))


def target_usage(truth: DataFrame, targets: DataFrame) -> DataFrame:
    """How many targets are linked to so many S1 records, unmatched ones included."""
    links = truth.groupBy("t_id").agg(F.countDistinct("s1_id").alias("n"))
    used = links.groupBy(F.col("n").cast("long").alias("s1_linked")).agg(F.count(F.lit(1)).alias("targets"))
    free = targets.select(F.col("entity_id").alias("t_id")).join(links, "t_id", "left_anti").agg(F.lit(0).cast("long").alias("s1_linked"), F.count(F.lit(1)).alias("targets"))
    return used.unionByName(free)


def country_consistency(records: DataFrame, truth: DataFrame) -> DataFrame:
    """True pairs by the S1 record's label and the target's source: same, different or missing label."""
    own = records.select("entity_id", F.col("country").alias("c"), text.normalize_country(text.fold(F.col("country"))).alias("k"))
    pairs = truth.join(own.toDF("s1_id", "c1", "k1"), "s1_id", "left").join(own.toDF("t_id", "c2", "k2"), "t_id", "left")
    status = F.when(text.is_missing(F.col("c1")) | text.is_missing(F.col("c2")), "missing").when(F.col("k1") == F.col("k2"), "same").otherwise("different")
    rows = pairs.select(text.country_label(F.col("c1")).alias("s1_country"), F.substring("t_id", 1, 2).alias("target_source"), status.alias("status"))
    return rows.groupBy("s1_country", "target_source").pivot("status", ["same", "different", "missing"]).count().na.fill(0)


def orphan_countries(records: DataFrame) -> DataFrame:
    """Labels of S1 that no target has."""
    labels = records.select("source", text.normalize_country(text.fold(F.col("country"))).alias("label")).where("label <> ''").distinct()
    return labels.where("source = 'S1'").select("label").join(labels.where("source <> 'S1'").select("label"), "label", "left_anti")


def completeness(views: DataFrame) -> DataFrame:
    """By source and country, the shares of records with each kind of content."""
    share = lambda c: F.round(F.avg(c.cast("double")), 3)
    return views.groupBy("source", text.country_label(F.col("country_raw")).alias("country")).agg(
        share(F.col("name_missing")).alias("name_missing"), share(F.col("addr_missing")).alias("addr_missing"), share(F.size("addr_postal") > 0).alias("postal"),
        share(F.col("addr_house") != "").alias("house"), share(F.coalesce("addr_landmark", F.lit(False))).alias("landmark"), share(F.size("name_alts") > 0).alias("alternates"),
        share(F.col("name_legal") != "").alias("legal_form"), share(F.size("name_tokens")).alias("name_tokens"), share(F.size("addr_tokens")).alias("addr_tokens"))


def _draw(*parts: Column | str) -> Column:
    """A number from 0 to 2^32 - 1 by the MD5 of some texts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


def random_negatives(views: DataFrame, truth: DataFrame, per_positive: int = 2, seed: int = 0) -> DataFrame:
    """For each true pair, random S1 records with random targets of the same source, joined by their places in a hashed order.

    Places are dealt in buckets of the hash, so that no source is numbered in one task.
    """
    def numbered(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
        h = _draw("entity_id", F.lit(f"{seed} {name}"))
        rows = df.select(F.col("entity_id").alias(name), *keys, F.pmod(h, F.lit(256)).alias("b"), h.alias("h"))
        return rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys, "b").orderBy("h", name))).drop("h")

    s1 = numbered(views.where("source = 'S1'"), "s1_id", [])
    targets = numbered(views.where("source <> 'S1'").withColumn("src", F.col("source")), "t_id", ["src"])
    n1, n2 = s1.groupBy("b").agg(F.max("place").alias("m")), targets.groupBy("src", "b").agg(F.max("place").alias("m"))
    draws = truth.select(F.substring("t_id", 1, 2).alias("src"), "s1_id", "t_id", F.explode(F.sequence(F.lit(1), F.lit(per_positive)).cast("array<string>")).alias("i"))
    buckets = F.array_sort(F.collect_list(F.struct("b", "m")))
    one, two = n1.agg(buckets.alias("l1")), n2.groupBy("src").agg(buckets.alias("l2"))  # at most 256 buckets each
    drawn = draws.join(F.broadcast(two), "src").join(F.broadcast(one))
    pick = lambda what, top: F.pmod(_draw("s1_id", "t_id", "i", F.lit(f"{seed} {what}")), top)
    drawn = drawn.withColumn("x1", F.get("l1", pick("left", F.size("l1")).cast("int"))).withColumn("x2", F.get("l2", pick("right", F.size("l2")).cast("int")))
    placed = drawn.select("src", F.col("x1.b").alias("b"), (pick("first", F.col("x1.m")) + 1).alias("place"), F.col("x2.b").alias("bt"), (pick("second", F.col("x2.m")) + 1).alias("pt"))
    found = placed.join(s1, ["b", "place"]).join(targets.withColumnsRenamed({"b": "bt", "place": "pt"}), ["src", "bt", "pt"])
    return found.select("s1_id", "t_id", "src")


def similarity_profile(views: DataFrame, truth: DataFrame, name: DataFrame, address: DataFrame, per_positive: int = 2, seed: int = 0) -> DataFrame:
    """Similarities of true pairs and of random ones; the address cosine is NULL where an address is missing."""
    positive = truth.select("s1_id", "t_id", F.substring("t_id", 1, 2).alias("src"), F.lit("match").alias("label"))
    pairs = positive.unionByName(random_negatives(views, truth, per_positive, seed).withColumn("label", F.lit("random non-match")))
    pairs = vectors.pair_dot(vectors.pair_dot(pairs, name, "name_char_cos"), address, "addr_char_cos")
    own = views.select("entity_id", "name_core", "addr_missing", "country_raw")
    rows = pairs.join(own.toDF("s1_id", "n1", "m1", "country"), "s1_id").join(own.select("entity_id", "name_core", "addr_missing").toDF("t_id", "n2", "m2"), "t_id")
    return rows.select(
        "label", F.col("src").alias("target_source"), "country", "name_char_cos", F.when(~(F.col("m1") | F.col("m2")), F.col("addr_char_cos")).alias("addr_char_cos"),
        similarity.scores(F.col("n1"), F.col("n2"), "token_set")["token_set"].alias("name_token_set"))


def pair_view(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """``pairs`` with the raw texts of both sides."""
    side = lambda i, p: records.select(F.col("entity_id").alias(i), *[F.col(c).alias(f"{p}_{n}") for c, n in (("business_name", "name"), ("business_address", "address"), ("country", "country"))])
    return pairs.join(side("s1_id", "s1"), "s1_id", "left").join(side("t_id", "t"), "t_id", "left")


def errors(scored: DataFrame, kept: DataFrame, records: DataFrame, n: int = 20) -> dict[str, DataFrame]:
    """The most probable wrong matches, and the least probable missed ones, with their texts."""
    wrong = kept.where("y = 0").orderBy(F.desc("p"), "s1_id", "t_id").limit(n)
    missed = scored.where("y = 1").join(kept, ["s1_id", "t_id"], "left_anti").orderBy("p", "s1_id", "t_id").limit(n)
    return {"false_positives": pair_view(wrong, records), "false_negatives": pair_view(missed, records)}


def unmatched_labels(pred: DataFrame, records: DataFrame, labels: DataFrame, n: int = 5) -> DataFrame:
    """Samples of S1 records whose country label is among ``labels`` (such as those that training hasn't seen), with their matches' texts: the first n by id of each label."""
    own = records.where("source = 'S1'").join(labels.select("country").distinct(), "country", "left_semi").select(F.col("entity_id").alias("s1_id"), "country")
    rank = F.row_number().over(Window.partitionBy("country").orderBy("s1_id"))
    first = own.withColumn("_nth", rank).where(F.col("_nth") <= n).select("s1_id")
    return pair_view(first.join(pred.select("s1_id", "t_id"), "s1_id", "left"), records)
