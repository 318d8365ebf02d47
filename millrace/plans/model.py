"""Feature selection, training, choice of model, and evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import types as ty
from millrace.functions.types import ref
from millrace.operators import modelling as m
from millrace.operators.quality import problem_type as infer
from millrace.operators.screening import Selection, select_features
from millrace.sources.sinks import stage

_ROW = "row_number_"


@dataclass
class ModelResult:
    target: str
    problem_type: str
    best: m.Trained
    baseline_score: float
    best_score: float
    metrics: DataFrame
    sanity: DataFrame
    importance: DataFrame
    selection: Selection
    train: DataFrame
    test: DataFrame
    keys: list[str]

    def rows(self) -> DataFrame:
        """(section, metric, value): scores, metrics, sanity, importances."""
        spark = self.train.sparkSession
        scores = spark.createDataFrame(
            [("score", "baseline", self.baseline_score), ("score", self.best.name, self.best_score)],
            "section string, metric string, value double",
        )
        return (
            scores
            .unionByName(self.metrics.select(F.lit("metrics").alias("section"), "metric", "value"))
            .unionByName(
                self.sanity.select(
                    F.lit("sanity").alias("section"), F.col("check").alias("metric"),
                    F.col("passed").cast("double").alias("value"),
                )
            )
            .unionByName(
                self.importance.select(
                    F.lit("importance").alias("section"), F.col("feature").alias("metric"),
                    F.col("importance").alias("value"),
                )
            )
        )


def model(
    df: DataFrame,
    target: str,
    problem_type: str | None = None,
    keys: Sequence[str] = (),
    challenger: str = "forest",
    test_share: float = m.TEST_SHARE,
    seed: int = m.SEED,
    trees: int = m.FOREST_TREES,
    repeats: int = m.IMPORTANCE_REPEATS,
) -> ModelResult:
    """Select features, split, train baseline and challenger, keep the better.

    ``challenger`` is ``forest`` or ``tuned``.  Without row keys, rows are
    numbered once and written out, so that the split is stable.
    """
    ty.require_column(df, target)
    if challenger not in ("forest", "tuned"):
        raise ValueError("challenger is 'forest' or 'tuned'")
    if problem_type is None:
        problem_type = infer(df, target)
    if not keys:
        df = stage(df.withColumn(_ROW, F.monotonically_increasing_id()), "numbered")
        keys = [_ROW]
    df = df.filter(ref(target).isNotNull())
    chosen = select_features(df, target, keys)
    if not chosen.features:
        raise ValueError("no features left after selection")
    train, test = m.staged_split(chosen.table, keys, test_share, seed)
    baseline = m.train_baseline(train, chosen.features, target, problem_type)
    if challenger == "forest":
        rival = m.train_forest(train, chosen.features, target, problem_type, trees=trees, seed=seed)
    else:
        rival = m.train_tuned(train, chosen.features, target, problem_type, seed=seed)
    scored = {t.name: m.metrics_for(problem_type, m.score(t, test), target) for t in (baseline, rival)}
    points = {n: m.main_score(problem_type, s) for n, s in scored.items()}
    better = points[rival.name] > points[baseline.name]
    if problem_type != "classification":
        better = points[rival.name] < points[baseline.name]
    best = rival if better else baseline
    rows = df.sparkSession.createDataFrame(
        [(r["metric"], r["value"]) for r in scored[best.name].collect()], "metric string, value double"
    )
    return ModelResult(
        target, problem_type, best, points[baseline.name], points[best.name], rows,
        m.sanity_check(rows, problem_type),
        m.ranked_importance(best, test, keys, repeats=repeats), chosen, train, test, list(keys),
    )
