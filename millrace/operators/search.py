"""Model search within a budget of rows: successive halving on nested samples.

Every setting is fitted on a small sample and judged on the same held-out rows; the
better half goes on with twice the rows, until one is left.  Samples are nested, dealt
by a hash of the row's own values, so a search gives the same result when it is run
again.  The budget counts the rows of all fits and is never exceeded: a histogram of the
hashes tells how far a sample may reach.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.types import free_name, ref
from millrace.operators.modelling import SEED, TEST_SHARE, Trained, _fit
from millrace.sources.sinks import stage

#: (kind, trees or rounds, depth) that are tried; boosting needs a number or two classes.
SETTINGS = (
    ("forest", 20, 5), ("forest", 50, 10), ("forest", 100, 5), ("forest", 20, 12),
    ("boosted", 10, 3), ("boosted", 20, 5), ("boosted", 40, 3), ("boosted", 20, 7),
)
_CELLS = 4096


@dataclass
class Searched:
    """The winner, the (round, setting, rows, score, kept) table and the rows all fits took."""

    best: Trained
    rounds: DataFrame
    rows_spent: int


def _estimator(setting: tuple[str, int, int], label: str, problem_type: str, seed: int):
    kind, size, depth = setting
    shared = dict(featuresCol="features", labelCol=label, seed=seed, maxDepth=depth)
    if kind == "forest":
        return (RandomForestClassifier if problem_type == "classification" else RandomForestRegressor)(numTrees=size, **shared)
    return (GBTClassifier if problem_type == "classification" else GBTRegressor)(maxIter=size, **shared)


def _dealt(df: DataFrame, seed: int) -> Column:
    values = F.xxhash64(F.lit(seed), *[ref(c).cast("string") for c in df.columns])
    return F.pmod(values, F.lit(_CELLS)).cast("int")


def _cut(counts: Sequence[int], rows: int) -> tuple[int, int]:
    """(cells, rows) of the longest run of first cells with no more rows than wanted."""
    taken = 0
    for cell, n in enumerate(counts):
        if taken + n > rows:
            return cell, taken
        taken += n
    return len(counts), taken


def successive_halving(
    train: DataFrame, features: Sequence[str], label: str, problem_type: str, budget_rows: int,
    settings: Sequence[tuple[str, int, int]] = SETTINGS, test_share: float = TEST_SHARE, seed: int = SEED,
) -> Searched:
    """The setting that wins; ties go to the one listed first."""
    tried = list(dict.fromkeys(settings))
    if problem_type == "classification" and train.select(label).distinct().limit(3).count() > 2:
        tried = [s for s in tried if s[0] != "boosted"]
    if not tried:
        raise ValueError("no settings to try")
    cell = free_name(train, "cell")
    ready = train.withColumn(label, ref(label).cast("double")).withColumn(cell, _dealt(train, seed))
    held_out = int(_CELLS * test_share)
    ready = stage(ready.select(*[ref(c) for c in dict.fromkeys([*features, label])], cell), "search")
    judged = ready.filter(ref(cell) < held_out)
    found = {r[cell]: r["n"] for r in ready.filter(ref(cell) >= held_out).groupBy(cell).agg(F.count("*").alias("n")).collect()}
    counts = [found.get(c, 0) for c in range(held_out, _CELLS)]
    # As many fits a round as settings are left; rows a fit double from round to round.
    left, plan = len(tried), []
    while True:
        plan.append(left)
        if left == 1:
            break
        left = -(-left // 2)
    share = sum(n * 2**i for i, n in enumerate(plan))
    if problem_type == "classification":
        judge = MulticlassClassificationEvaluator(labelCol=label, metricName="weightedFMeasure")
    else:
        judge = RegressionEvaluator(labelCol=label, metricName="r2")
    rows, spent, fitted = [], 0, {}
    for i, n in enumerate(plan):
        cells, used = _cut(counts, budget_rows * 2**i // share)
        if not used:
            raise ValueError(f"a budget of {budget_rows} rows is too small for {len(tried)} settings")
        sample = ready.filter((ref(cell) >= held_out) & (ref(cell) < held_out + cells))
        scores = {}
        for s in tried:
            fitted[s] = _fit("Searched Model", _estimator(s, label, problem_type, seed), sample, list(features), label, problem_type)
            scores[s] = float(judge.evaluate(fitted[s].model.transform(judged)))
            spent += used
        ranked = sorted(tried, key=lambda s: (-scores[s], list(settings).index(s)))
        kept = ranked[: plan[i + 1]] if i + 1 < len(plan) else ranked[:1]
        rows += [(i + 1, "/".join(map(str, s)), used, scores[s], s in kept) for s in tried]
        tried = [s for s in tried if s in kept]
    rounds = train.sparkSession.createDataFrame(rows, "round int, setting string, rows bigint, score double, kept boolean")
    return Searched(fitted[tried[0]], rounds, spent)
