"""Boosted trees over pair features, cross-validated by groups and calibrated."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ModelConfig
from ..session import by_merge, read_text, stored, write_text
from .features import FEATURES

#: Stands for NULL, below every feature; a second column tells the two apart where a feature can be NULL.
UNKNOWN = -1000.0


@dataclass
class Calibrator:
    """An isotonic step: linear between knots, constant outside."""

    knots: list[float]
    values: list[float]

    def column(self, p: Column) -> Column:
        if not self.knots:
            return p
        xs, ys = self.knots, self.values
        out = F.when(p <= xs[0], F.lit(ys[0])).when(p >= xs[-1], F.lit(ys[-1]))
        knots, values = F.lit(xs), F.lit(ys)
        steps = [1 << i for i in range(max(len(xs) - 1, 1).bit_length() - 1, -1, -1)]
        at = F.aggregate(F.lit(steps), F.lit(0), lambda i, s: F.when((i + s < len(xs)) & (F.get(knots, i + s) <= p), i + s).otherwise(i))
        x0, x1, y0, y1 = F.get(knots, at), F.get(knots, at + 1), F.get(values, at), F.get(values, at + 1)
        return out.otherwise(y0 + (y1 - y0) * (p - x0) / F.when(x1 > x0, x1 - x0).otherwise(1.0))


def fit_calibrator(scored: DataFrame, p: str = "p_raw") -> Calibrator:
    """An isotonic fit of y on p."""
    model = IsotonicRegression(featuresCol=p, labelCol="y").fit(scored.select(F.col("y").cast("double").alias("y"), p))
    return Calibrator([float(x) for x in model.boundaries], [min(max(float(y), 0.0), 1.0) for y in model.predictions])


def assembled(features: DataFrame) -> DataFrame:
    """``features`` with the vector column x."""
    filled = features.withColumns({f"_x_{c}": F.coalesce(F.when(~F.isnan(c), F.col(c)), F.lit(UNKNOWN)) for c in FEATURES})
    return VectorAssembler(inputCols=[f"_x_{c}" for c in FEATURES], outputCol="x").transform(filled).drop(*[f"_x_{c}" for c in FEATURES])


@dataclass
class Matcher:
    models: list[GBTClassificationModel]
    calibrator: Calibrator | None
    importances: dict[str, float]

    def predict_raw(self, features: DataFrame) -> DataFrame:
        """s1_id, t_id, src and p_raw, the mean over the folds' models."""
        out = assembled(features)
        for i, model in enumerate(self.models):
            model = model.copy().setFeaturesCol("x").setProbabilityCol(f"_p{i}").setPredictionCol(f"_c{i}").setRawPredictionCol(f"_r{i}")
            out = model.transform(out)
        mean = sum((vector_to_array(f"_p{i}")[1] for i in range(len(self.models))), F.lit(0.0)) / max(len(self.models), 1)
        keys = [c for c in ("s1_id", "t_id", "src", "y", "fold") if c in features.columns]
        return out.select(*keys, mean.alias("p_raw"))

    def predict(self, features: DataFrame) -> DataFrame:
        scored = self.predict_raw(features)
        return scored.withColumn("p", self.calibrator.column(F.col("p_raw")) if self.calibrator else F.col("p_raw"))

    def save(self, folder: str) -> None:
        for i, model in enumerate(self.models):
            model.write().overwrite().save(f"{folder}/model_{i}")
        calibrator = None if self.calibrator is None else vars(self.calibrator)
        write_text(SparkSession.active(), f"{folder}/matcher.json", json.dumps({"models": len(self.models), "calibrator": calibrator, "importances": self.importances}))

    @classmethod
    def load(cls, folder: str) -> Matcher:
        kept = json.loads(read_text(SparkSession.active(), f"{folder}/matcher.json"))
        models = [GBTClassificationModel.load(f"{folder}/model_{i}") for i in range(kept["models"])]
        return cls(models, Calibrator(**kept["calibrator"]) if kept["calibrator"] else None, kept["importances"])


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """``pairs`` with y: 1 for true pairs."""
    true = truth.select("s1_id", "t_id").distinct().withColumn("_y", F.lit(1))
    return pairs.join(by_merge(true), ["s1_id", "t_id"], "left").withColumn("y", F.coalesce("_y", F.lit(0))).drop("_y")


def train_matcher(features: DataFrame, folds: DataFrame, config: ModelConfig | None = None) -> tuple[Matcher, DataFrame]:
    """The matcher, and its out-of-fold scores: s1_id, t_id, src, p_raw, p, y and fold.

    A fold's model sees none of its pairs; with three folds or more it stops early by the next fold's. Calibration is cross-fitted in the same
    way. A fold whose training pairs have one class only is scored with that class's share.
    """
    config = config or ModelConfig()
    data = stored(features.join(by_merge(folds), "s1_id"), "features")
    names = sorted(r[0] for r in data.select("fold").distinct().collect())
    models, parts = [], []
    for i, fold in enumerate(names):
        check = F.col("fold") == names[(i + 1) % len(names)] if len(names) > 2 else F.lit(False)
        train = assembled(data.where(F.col("fold") != fold)).withColumn("_check", check).withColumn("y", F.col("y").cast("double"))
        share = train.where("not _check").agg(F.avg("y")).first()[0]
        held = data.where(F.col("fold") == fold)
        if share is None or share in (0.0, 1.0):
            parts.append(held.select("s1_id", "t_id", "src", "y", "fold", F.lit(float(share or 0.0)).alias("p_raw")))
            continue
        booster = GBTClassifier(
            featuresCol="x", labelCol="y", maxIter=config.max_iter, maxDepth=config.max_depth, stepSize=config.learning_rate, seed=config.seed,
            minInstancesPerNode=config.min_instances, subsamplingRate=config.bagging_fraction, featureSubsetStrategy=config.feature_fraction,
            maxBins=config.max_bins)
        if len(names) > 2:
            booster = booster.setValidationIndicatorCol("_check")
        model = booster.fit(train.select("x", "y", "_check"))
        models.append(model)
        parts.append(Matcher([model], None, {}).predict_raw(held))
    if not parts:
        return Matcher([], None, {}), data.select("s1_id", "t_id", "src", F.lit(0.0).alias("p_raw"), F.lit(0.0).alias("p"), "y", "fold")
    oof = parts[0]
    for part in parts[1:]:
        oof = oof.unionByName(part)
    oof = stored(oof, "oof")
    final = None
    if config.calibrate:
        p = F.col("p_raw")
        for fold in names:
            others = oof.where(F.col("fold") != fold)
            p = F.when(F.col("fold") == fold, fit_calibrator(others if len(names) > 1 else oof).column(F.col("p_raw"))).otherwise(p)
        oof, final = oof.withColumn("p", p), fit_calibrator(oof)
    else:
        oof = oof.withColumn("p", F.col("p_raw"))
    gains = np.mean([m.featureImportances.toArray() for m in models], axis=0) if models else np.zeros(len(FEATURES))
    return Matcher(models, final, dict(zip(FEATURES, map(float, gains), strict=True))), oof
