"""Train and predict: split, normalise, block, features, model, policy, reports."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, DecisionConfig
from ..functions import text
from ..operators import blocking, decision, explore, features, graph, matcher, metrics, normalize
from ..session import read_text, stored, write_text
from ..sources import sinks
from ..sources.records import SplitData


@dataclass
class Prepared:
    """A split's views, candidates and features; text statistics are fitted on the split itself."""

    views: DataFrame
    candidates: DataFrame
    features: DataFrame


def prepare_split(data: SplitData, config: Config) -> Prepared:
    views = stored(normalize.normalize_records(data.records), "views")
    candidates = stored(blocking.generate_candidates(views, config.blocking), "candidates")
    return Prepared(views, candidates, stored(features.build_features(views, candidates), "features"))


@dataclass
class TrainedPipeline:
    matcher: matcher.Matcher
    policy: decision.Policy
    config: Config

    def save(self, folder: str) -> None:
        self.matcher.save(folder)
        write_text(SparkSession.active(), f"{folder}/pipeline.json", json.dumps({"policy": self.policy.to_dict(), "config": self.config.to_dict()}))

    @classmethod
    def load(cls, folder: str) -> TrainedPipeline:
        kept = json.loads(read_text(SparkSession.active(), f"{folder}/pipeline.json"))
        return cls(matcher.Matcher.load(folder), decision.Policy(**kept["policy"]), Config.from_dict(kept["config"]))


def fold_countries(data: SplitData) -> DataFrame:
    return data.countries.select("s1_id", text.normalize_country(text.fold(F.col("country"))).alias("country"))


def train(data: SplitData, config: Config | None = None, prepared: Prepared | None = None) -> tuple[TrainedPipeline, dict]:
    """The pipeline, and its reports: tables of out-of-fold results, importances, policies and both reports."""
    config = config or Config()
    prepared = prepared or prepare_split(data, config)
    truth, spine = data.truth, data.spine
    folds = stored(graph.make_folds(truth, spine, fold_countries(data), config.model.n_folds, config.model.seed), "folds")
    model, oof = matcher.train_matcher(matcher.label_pairs(prepared.features, truth), folds, config.model)
    oof = stored(oof, "scores")
    policy, table, crossfit = decision.tune_policy(oof, truth, folds, config.decision)
    kept = decision.apply_policy(oof, policy, config.decision)
    n_targets = data.targets.count()
    reports = {
        "policies": table, "policy_summary": decision.policy_summary(truth.sparkSession.createDataFrame(table)), "crossfit_macro_f": crossfit, "oof": oof, "kept": kept, "folds": folds,
        "evaluation": metrics.evaluation_report(kept, truth, spine, fold_countries(data), config.decision.beta),
        "blocking": metrics.blocking_report(prepared.candidates, truth, spine, n_targets, fold_countries(data)),
        "ranking": metrics.ranking_metrics(oof, "p_raw"), "importances": model.importances}
    return TrainedPipeline(model, policy, config), reports


def predict(trained: TrainedPipeline, data: SplitData, prepared: Prepared | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Matches, candidates and scores of a split."""
    prepared = prepared or prepare_split(data, trained.config)
    scored = stored(trained.matcher.predict(prepared.features), "scores")
    kept = decision.apply_policy(scored, trained.policy, trained.config.decision)
    return kept.select("s1_id", "t_id"), prepared.candidates.select("s1_id", "t_id"), scored


def predict_to(trained: TrainedPipeline, data: SplitData, folder: str) -> tuple[list[str], list[str]]:
    """Both id lists in ``folder``, and the errors and warnings of their rules."""
    spine, spark = data.s1.select(F.col("entity_id").alias("s1_id")), data.s1.sparkSession
    matches, candidates, scored = predict(trained, data)
    paths = sinks.write_submission(folder, spine, matches, candidates)
    sinks.write_tables({"scores": scored}, folder, compress=True)
    return sinks.validate_submission(spark, *paths, spine, data.targets.select(F.col("entity_id").alias("t_id")))


def explore_split(data: SplitData, views: DataFrame | None = None) -> dict[str, DataFrame]:
    """The profiles of a split; those of the truth where there is one."""
    views = views if views is not None else normalize.normalize_records(data.records)
    tables = {"overview": explore.overview(data.records), "countries": explore.country_table(data.records), "completeness": explore.completeness(views), "orphans": explore.orphan_countries(data.records)}
    if data.ground_truth is not None:
        counts = explore.match_counts(data.truth, data.spine, data.countries)
        tables |= {
            "cardinality": explore.cardinality_shares(counts), "cardinality_by_source": explore.cardinality_by_source(counts),
            "cardinality_stats": explore.cardinality_stats(counts), "target_usage": explore.target_usage(data.truth, data.targets),
            "country_consistency": explore.country_consistency(data.records, data.truth)}
    return tables


def country_holdout(data: SplitData, config: Config, prepared: Prepared, n_folds: int = 3) -> list[dict]:
    """For each country, macro F of a pipeline that is trained and tuned on the others."""
    config = Config.from_dict(config.to_dict())
    config.model.n_folds = n_folds
    countries, truth, spine, out = fold_countries(data), data.truth, data.spine, []
    for label in sorted(r[0] for r in countries.select("country").distinct().collect()):
        inside = countries.where(F.col("country") == label).select("s1_id")
        part = lambda df, how: df.join(inside, "s1_id", how)
        rest_truth, rest_spine = part(truth, "left_anti"), part(spine, "left_anti")
        if rest_spine.isEmpty():
            continue
        folds = stored(graph.make_folds(rest_truth, rest_spine, countries, n_folds, config.model.seed), "folds")
        model, oof = matcher.train_matcher(matcher.label_pairs(part(prepared.features, "left_anti"), rest_truth), folds, config.model)
        policy, _, crossfit = decision.tune_policy(stored(oof, "scores"), rest_truth, folds, config.decision)
        kept = decision.apply_policy(stored(model.predict(part(prepared.features, "left_semi")), "scores"), policy, config.decision)
        held = metrics.entity_scores(kept, part(truth, "left_semi"), part(spine, "left_semi"), config.decision.beta)
        row = held.agg(F.count(F.lit(1)).alias("n"), F.avg("f").alias("f")).first()
        out.append({"country": label, "entities": row["n"], "macro_f": row["f"], "crossfit_of_others": crossfit, "policy": policy.describe()})
    return out


def blocking_sweep(data: SplitData, views: DataFrame, settings: list[dict], config: Config) -> list[dict]:
    """The blocking headline for several settings of the blockers."""
    out = []
    for change in settings:
        own = Config.from_dict({"blocking": config.to_dict()["blocking"] | change}).blocking
        found = stored(blocking.generate_candidates(views, own), "candidates")
        out.append(change | metrics.blocking_headline(found, data.truth, data.spine, data.targets.count()).first().asDict())
    return out


def score_file(spark: SparkSession, truth: DataFrame, spine: DataFrame, lists: DataFrame, beta: float = DecisionConfig().beta) -> float:
    """Macro F of an id list: its first two columns, by position."""
    first, second = lists.columns[:2]
    pred = lists.select(text.strip(F.col(first)).alias("s1_id"), F.explode(text.id_list(F.col(second))).alias("t_id"))
    return metrics.macro_fbeta(pred, truth, spine, beta)
