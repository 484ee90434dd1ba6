"""Degradation model operators.

The model is MLlib's distributed random forest (100 trees, depth 10, seed 42, every
feature considered at each split) behind a ``VectorAssembler``; training, scoring and
evaluation are DataFrame jobs. MLlib bins continuous features and uses its own RNG, so
results are compared with metrics and invariants, never row for row with another
library. ``linear_degradation`` (M8) is the SQL-checkable baseline scorer.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..staging import stage
from .clean import normalise_columns
from .ordering import partitions, split_join
from .panel import FEATURES, TARGET, engineer_features, fit_label_mappings
from .quantiles import exact_quantiles
from .stats import regression_metrics

R2_GATE = 0.75
MAE_GATE = 0.5


ENCODED = ("circuit", "driver", "tire_compound")
FIT_ROWS = 2_000_000        # laps of a task of the fit, once every core has one
FIT_NODES_MB = 16           # node statistics that a task of the fit holds in one pass


@dataclass
class FeatureStage:
    """What feature engineering learns from its input, to be used again on other laps: the label
    codes (column_name, value, code; a staged table) and the median gap."""
    codes: DataFrame
    gap_median: float | None

    @staticmethod
    def fit(laps: DataFrame) -> FeatureStage:
        median = None
        if "gap_to_leader" in laps.columns:
            median = exact_quantiles(laps, "gap_to_leader", [0.5], ["m"]).first()["m"]
        return FeatureStage(stage(fit_label_mappings(laps, ENCODED), "codes"), median)

    def transform(self, laps: DataFrame, pits: DataFrame | None = None, include_current: bool = True) -> DataFrame:
        """Engineered laps; values that the fit has not seen get the codes after its own (D3)."""
        mappings = {c: self.codes.where(F.col("column_name") == c).select("value", "code") for c in ENCODED}
        return engineer_features(laps, pits, include_current=include_current, mappings=mappings, gap_median=self.gap_median)


@dataclass
class DegradationModel:
    pipeline: PipelineModel
    features: list[str]
    target: str = TARGET
    metrics: dict = field(default_factory=dict)
    stage: FeatureStage | None = None

    @property
    def is_fitted(self) -> bool:
        return self.pipeline is not None


# M1 -------------------------------------------------------------------------
def fit_tasks(cores: int, rows: int) -> int:
    """Tasks of a fit: one a core, more where these would hold over ``FIT_ROWS`` rows each. What
    they exchange is the node statistics times the tasks, however many files the laps are in."""
    return max(1, cores, math.ceil(rows / FIT_ROWS))


def fit_degradation_model(train: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET,
                          num_trees: int = 100, max_depth: int = 10, seed: int = 42,
                          max_bins: int = 64) -> DegradationModel:
    """Fit the forest on rows with non-null features and target; records train metrics.
    Node ids are not cached: the cache holds a number per lap and tree, twice over, writes it anew
    in every pass and to the shared folder every tenth, which no longer fits beside the laps;
    finding a lap's node from the root gives the same splits and keeps nothing. At each
    level every task sends the statistics of all nodes, so the tasks are ``fit_tasks``. A lap adds to
    a place of its own per tree and feature, so the nodes of one pass are held in ``FIT_NODES_MB`` a
    task, near the core: more passes, each over fewer trees, and the same splits."""
    feats = [c for c in features if c in train.columns]
    data = train.select(*feats, target).dropna()
    dealt = data.coalesce(fit_tasks(data.sparkSession.sparkContext.defaultParallelism, data.count()))
    rf = RandomForestRegressor(featuresCol="_features", labelCol=target, predictionCol="prediction",
                               numTrees=num_trees, maxDepth=max_depth, seed=seed, maxBins=max_bins,
                               featureSubsetStrategy="all", cacheNodeIds=False, maxMemoryInMB=FIT_NODES_MB)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="_features", handleInvalid="skip"), rf])
    model = DegradationModel(pipe.fit(dealt), feats, target)
    m = regression_metrics(model.pipeline.transform(data), target, "prediction").first().asDict()
    model.metrics = {"train_r2": m["r2"], "train_mae": m["mae"], "train_rmse": m["rmse"]}
    return model


# M2 -------------------------------------------------------------------------
def score_laps(model: DegradationModel | None, df: DataFrame) -> DataFrame:
    """Input columns plus ``prediction``; unfitted model or missing feature raises."""
    if model is None or not model.is_fitted:
        raise ValueError("Model must be fitted before prediction")
    missing = [c for c in model.features if c not in df.columns]
    if missing:
        raise ValueError(f"Missing features: {missing}")
    out = model.pipeline.transform(df)
    return out.select(*df.columns, "prediction")


def score_raw_laps(model: DegradationModel, laps: DataFrame, pits: DataFrame | None = None) -> DataFrame:
    """Predictions for raw laps of any session: features by the codes and the median that the
    model was fitted with, so the same lap gets the same numbers wherever it is scored. The feature
    steps read the laps about ten times, so these are written to the shared folder once."""
    if model is None or model.stage is None:
        raise ValueError("The model has no fitted feature stage")
    return score_laps(model, model.stage.transform(stage(normalise_columns(laps), "raw"), pits))


# M3 / A14 -------------------------------------------------------------------
def evaluate_model(model: DegradationModel, test: DataFrame) -> DataFrame:
    """Test metrics (R², MAE, RMSE, target mean/std); also stored as ``test_*``."""
    scored = score_laps(model, test.dropna(subset=[*model.features, model.target]))
    m = regression_metrics(scored, model.target, "prediction")
    row = m.first()
    if row is not None:
        model.metrics.update({"test_r2": row["r2"], "test_mae": row["mae"], "test_rmse": row["rmse"]})
    return m


# M4 / T2 --------------------------------------------------------------------
def feature_importance(model: DegradationModel, spark: SparkSession, top: int | None = None) -> DataFrame:
    """(feature, importance) sorted by importance; importances sum to 1."""
    imp = model.pipeline.stages[-1].featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(model.features, [float(x) for x in imp])), "feature string, importance double")
    df = df.orderBy(F.desc("importance"), "feature")
    return df.limit(top) if top else df


# M5 -------------------------------------------------------------------------
def model_summary(model: DegradationModel, spark: SparkSession) -> DataFrame:
    rf = model.pipeline.stages[-1]
    rows = [("is_fitted", str(model.is_fitted)), ("n_features", str(len(model.features))),
            ("features", ",".join(model.features)), ("n_estimators", str(rf.getNumTrees)),
            ("max_depth", str(rf.getOrDefault("maxDepth")))]
    rows += [(k, json.dumps(v)) for k, v in sorted(model.metrics.items())]
    return spark.createDataFrame(rows, "key string, value string")


# M6 -------------------------------------------------------------------------
def score_condition_grid(model: DegradationModel, features_df: DataFrame,
                         ages: Sequence[int] = (5, 15, 25)) -> DataFrame:
    """Batch form of the single-condition predictor: every (circuit, compound) seen in
    ``features_df`` x ``ages``. Features of a grid row follow the reference defaults
    (position 10, gap = position x 0.5, driver code 0, no position change, relative
    performance 1, stint length and laps since pit = age); rolling means use the
    circuit/compound mean lap time instead of 0, and the compound is encoded with the
    fitted codes (D4)."""
    g = _condition_groups(features_df)
    g = g.select("*", F.explode(F.array(*[F.lit(a) for a in ages])).alias("tire_age"))
    grid = _grid_features(g)
    return score_laps(model, grid)


def _condition_groups(features_df: DataFrame) -> DataFrame:
    """One row per (circuit, compound) seen, with its codes and mean lap time."""
    return features_df.groupBy("circuit", "circuit_encoded", "tire_compound", "tire_compound_encoded").agg(
        F.avg(TARGET).alias("_mean_lap"))


def _grid_features(g: DataFrame) -> DataFrame:
    return g.select(
        "circuit", "tire_compound", "tire_age", "tire_compound_encoded", "circuit_encoded",
        F.lit(0).alias("driver_encoded"), F.col("tire_age").alias("lap_number"), F.lit(10.0).alias("position"),
        F.lit(5.0).alias("gap_to_leader"), dims.rate_expr(F.col("tire_compound")).alias("tire_degradation_rate"),
        F.col("tire_age").alias("stint_length"), F.col("tire_age").alias("laps_since_pit"),
        F.col("_mean_lap").alias("rolling_avg_lap_time_3"), F.col("_mean_lap").alias("rolling_avg_lap_time_5"),
        F.lit(0.0).alias("position_change"), F.lit(1.0).alias("relative_performance"))


def forest_lap_times(model: DegradationModel, features_df: DataFrame) -> DataFrame:
    """(circuit, compound, tire_age, lap_time): the segments on which the forest's prediction is
    constant as the tyre ages (see ``plans.lapmodel``). They start just above the split points
    of the features that follow the age; a forest has a bounded number of them."""
    aged = {i for i, c in enumerate(model.features) if c in ("tire_age", "lap_number", "stint_length", "laps_since_pit")}
    splits = re.findall(r"feature (\d+) <= (-?[\d.]+(?:E-?\d+)?)", model.pipeline.stages[-1].toDebugString)
    starts = sorted({0} | {math.floor(float(v)) + 1 for i, v in splits if int(i) in aged and float(v) >= 0})
    g = _condition_groups(features_df)
    g = g.select("*", F.explode(F.array(*[F.lit(a) for a in starts])).alias("tire_age"))
    scored = score_laps(model, _grid_features(g))
    return scored.select("circuit", F.col("tire_compound").alias("compound"), "tire_age",
                         F.col("prediction").alias("lap_time"))


# M7 -------------------------------------------------------------------------
def quality_gate(metrics: DataFrame, r2_col: str = "r2", mae_col: str = "mae") -> DataFrame:
    """Retrain when R² < 0.75; warn on R² < 0.75 or MAE > 0.5 (null R² fails)."""
    r2, mae = F.col(r2_col), F.col(mae_col)
    return metrics.select("*", F.coalesce(r2 < R2_GATE, F.lit(True)).alias("retrain"),
                          F.coalesce(r2 < R2_GATE, F.lit(True)).alias("warn_r2"),
                          F.coalesce(mae > MAE_GATE, F.lit(True)).alias("warn_mae"))


# M8 -------------------------------------------------------------------------
def linear_degradation(laps: DataFrame, by: Sequence[str] = ("circuit", "compound"), y: str = "lap_time",
                       x: str = "tyre_life") -> DataFrame:
    """Per group: OLS slope and intercept of lap time on tyre age, and row count."""
    d = laps.where(F.col(y).isNotNull() & F.col(x).isNotNull())
    return d.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                              F.count(F.lit(1)).alias("n"))


def linear_predict(laps: DataFrame, fit: DataFrame, by: Sequence[str] = ("circuit", "compound"),
                   x: str = "tyre_life") -> DataFrame:
    """Baseline predictions ``intercept + slope·x``; the fit has one row per group and meets
    the laps with the most frequent groups apart."""
    return split_join(laps, fit.select(*by, "slope", "intercept", "n"), list(by), rows="n") \
               .withColumn("prediction", F.col("intercept") + F.col("slope") * F.col(x))


# M9 -------------------------------------------------------------------------
def train_pipeline(laps: DataFrame, pits: DataFrame | None = None, num_trees: int = 100,
                   max_depth: int = 10, path: str | None = None) -> tuple[DegradationModel, DataFrame]:
    """Validate with the full chain (P16), engineer, split, fit, evaluate, save (``path``).

    The rolling means of the reported metrics stop before the current lap, so the features do
    not hold the target (D11). The valid and the engineered laps are written to
    the shared folder once and read from there."""
    from .clean import validate_laps
    clean = stage(validate_laps(laps), "valid")
    learned = FeatureStage.fit(clean)
    split = training_split(learned.transform(clean, pits, include_current=False))
    model = fit_degradation_model(split.where(~F.col("is_test")), num_trees=num_trees, max_depth=max_depth)
    model.stage = learned
    metrics = evaluate_model(model, split.where(F.col("is_test")))
    if path:
        save_model(model, path)
    return model, metrics


def training_split(features: DataFrame) -> DataFrame:
    """Engineered laps with ``is_test``: staged in the shared folder, dealt over all cores, so
    that the split's selection, the fit and the evaluation read them and compute nothing. Each file
    is in order of the target: laps that follow each other go down a tree the same way and add to
    the same nodes' statistics, which stay near the core."""
    from .panel import chronological_split
    order = [TARGET, *[c for c in FEATURES if c in features.columns]]
    dealt = features.repartition(partitions(features)).sortWithinPartitions(*order)
    return chronological_split(stage(dealt, "features"), rank=False)


# S12 ------------------------------------------------------------------------
def save_model(model: DegradationModel, path: str) -> None:
    spark = SparkSession.getActiveSession()
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    kept = None
    if model.stage is not None:
        model.stage.codes.coalesce(1).write.mode("overwrite").parquet(f"{path}/codes")
        kept = {"gap_median": model.stage.gap_median}
    meta = json.dumps({"features": model.features, "target": model.target, "metrics": model.metrics, "stage": kept})
    spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_model(path: str) -> DegradationModel | None:
    """The saved model with its feature stage, or None when there is nothing at ``path``. What is
    there but cannot be read raises."""
    spark = SparkSession.getActiveSession()
    try:
        text = spark.read.text(f"{path}/meta")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    meta = json.loads(text.first()["value"])
    kept = meta.get("stage")
    learned = kept and FeatureStage(spark.read.parquet(f"{path}/codes"), kept["gap_median"])
    return DegradationModel(PipelineModel.load(f"{path}/pipeline"), meta["features"], meta["target"], meta.get("metrics", {}), learned)
