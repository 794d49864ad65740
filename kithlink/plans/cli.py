"""Command line: train, predict, run, explore, validate and score."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..session import importable, write_text
from ..sources import records, sinks
from . import pipeline


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="kithlink", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("train", "predict", "run", "explore", "validate", "score"):
        command = commands.add_parser(name)
        command.add_argument("--data-dir")
        command.add_argument("--config")
        command.add_argument("--out", default="output")
        command.add_argument("--model", default="output/model")
        command.add_argument("--split", default="train")
        command.add_argument("--matching", default="output/matching_results.tsv")
        command.add_argument("--candidates", default="output/candidate_pairs.tsv")
    return parser


def _train(spark, args, config):
    data = records.load_split(spark, str(records.resolve_dataset_dir(args.data_dir)), "train")
    trained, reports = pipeline.train(data, config)
    trained.save(args.model)
    tables = {f"{k}_{n}": t for k in ("evaluation", "blocking") for n, t in reports[k].items()}
    sinks.write_tables(tables | {"oof": reports["oof"]}, args.out, compress=True)
    write_text(spark, f"{args.out}/policies.csv", reports["policies"].to_csv(index=False))
    row = reports["evaluation"]["headline"].first().asDict()
    sinks.write_report(spark, f"{args.out}/report.json", {"headline": row, "crossfit_macro_f": reports["crossfit_macro_f"], "policy": trained.policy.describe(), "config": config.to_dict(), "importances": reports["importances"]})
    print(f"policy: {trained.policy.describe()}; macro F {row['macro_f']:.5f}, cross-fitted {reports['crossfit_macro_f']:.5f}")
    return trained


def _predict(spark, args, trained):
    data = records.load_split(spark, str(records.resolve_dataset_dir(args.data_dir)), "test")
    orphans = pipeline.explore.orphan_countries(data.records).collect()
    if orphans:
        print(f"warning: S1 labels that no target has: {[r[0] for r in orphans]}")
    errors, warnings = pipeline.predict_to(trained, data, args.out)
    print("\n".join([*errors, *(f"warning: {w}" for w in warnings)]) or "no rule is broken")
    return int(bool(errors))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = build_parser().parse_args(argv)
    config = Config.load(args.config)
    spark = importable(spark or SparkSession.builder.appName("kithlink").getOrCreate())
    if args.command in ("train", "run"):
        trained = _train(spark, args, config)
        return _predict(spark, args, trained) if args.command == "run" else 0
    if args.command == "predict":
        return _predict(spark, args, pipeline.TrainedPipeline.load(args.model))
    folder = str(records.resolve_dataset_dir(args.data_dir))
    data = records.load_split(spark, folder, "test" if args.command == "validate" else args.split)
    if args.command == "explore":
        sinks.write_tables(pipeline.explore_split(data), args.out)
        return 0
    if args.command == "validate":
        errors, warnings = sinks.validate_submission(
            spark, args.matching, args.candidates, data.s1.select(F.col("entity_id").alias("s1_id")), data.targets.select(F.col("entity_id").alias("t_id")))
        print("\n".join([*errors, *(f"warning: {w}" for w in warnings)]) or "no rule is broken")
        return int(bool(errors))
    value = pipeline.score_file(spark, data.truth, data.spine, records.read_tsv(spark, args.matching), config.decision.beta)
    print(f"macro F{config.decision.beta:g}: {value:.5f}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
