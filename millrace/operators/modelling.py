"""Train/test split, models, metrics and feature importance on ``pyspark.ml``."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import types as ty
from millrace.functions.expressions import ratio, rows_of
from millrace.functions.types import ref
from millrace.sources.sinks import stage

# Settings and limits that results must agree on.
TEST_SHARE = 0.2
SEED = 42
LOGISTIC_ITERATIONS = 1000
FOREST_TREES = 200
FOREST_DEPTH = 10
FOREST_MIN_LEAF = 3
IMPORTANCE_REPEATS = 3
# Node statistics per pass; more memory means fewer passes over the rows.
FOREST_MEMORY_MB = 1024
# Rows of a partition that trees are grown on: each pass reads it from the cache, as one
# object a row with a count for every tree.
TREE_ROWS = 500_000
GUESSING_ACCURACY = 0.55


# --- split ---------------------------------------------------------------


def _order_key(keys: Sequence[str], seed: int) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), *[ref(k).cast("string") for k in keys])
    return F.md5(text.cast("binary"))


def split_threshold(
    df: DataFrame, keys: Sequence[str], share: float, seed: int, rank_limit: int = 10_000
) -> str | None:
    """The hash key of rank ceil(share * rows), counted from the smallest.

    A histogram over four hex digits (65,536 groups at most) gives the row
    count and the prefix holding the rank.  While that prefix holds more than
    ``rank_limit`` rows, four more digits are looked at; then only the few
    keys below it are ranked.
    """
    hashed = df.select(_order_key(keys, seed).alias("h"))
    prefix, left = "", None
    while len(prefix) < 32:
        digits = F.substring("h", len(prefix) + 1, 4)
        counts = (
            hashed.filter(F.col("h").startswith(prefix)).groupBy(digits.alias("p"))
            .agg(F.count(F.lit(1)).alias("c"))
        )
        # At most 16^4 rows, so one small window over all of them.
        whole = Window.orderBy("p")
        running = counts.withColumn("upto", F.sum("c").over(whole)).withColumn(
            "total", F.sum("c").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        )
        wanted = F.ceil(F.lit(share) * F.col("total")) if left is None else F.lit(left)
        hit = running.withColumn("want", wanted).filter("upto >= want and want > 0").orderBy("p").first()
        if hit is None:
            return None
        prefix, left = prefix + hit["p"], hit["want"] - (hit["upto"] - hit["c"])
        if hit["c"] <= rank_limit:
            break
    within = hashed.filter(F.col("h").startswith(prefix)).orderBy("h").limit(int(left))
    return within.agg(F.max("h")).first()[0]


def with_split(
    df: DataFrame, keys: Sequence[str], test_share: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Add ``split``: exactly ceil(test_share * rows) rows are 'test'.

    ``keys`` must identify a row.  The rows are not moved: each compares its
    own hash with one literal.
    """
    cut = split_threshold(df, keys, test_share, seed)
    is_test = F.lit(False) if cut is None else _order_key(keys, seed) <= F.lit(cut)
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def staged_split(
    df: DataFrame, keys: Sequence[str], test_share: float = TEST_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test), written once to the shared folder.

    Training reads its rows many times; files make each pass cheap and safe
    against lost executors.
    """
    parts = stage(with_split(df, keys, test_share, seed), "split", rows=df.count())
    return tuple(parts.filter(F.col("split") == s).drop("split") for s in ("train", "test"))


def quick_split(df: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED) -> list[DataFrame]:
    """[train, test] of about the wanted sizes."""
    return df.randomSplit([1.0 - test_share, test_share], seed)


# --- training ------------------------------------------------------------


@dataclass
class Trained:
    name: str
    model: PipelineModel
    features: list[str]
    label: str
    problem_type: str


def _assemble(df: DataFrame, features: Sequence[str]) -> VectorAssembler:
    for f in features:
        ty.require_column(df, f)
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def _fit(name: str, estimator, train: DataFrame, features, label, problem_type) -> Trained:
    ready = train.withColumn(label, ref(label).cast("double"))
    model = Pipeline(stages=[_assemble(train, features), estimator]).fit(ready)
    return Trained(name, model, list(features), label, problem_type)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(class, weight): rows / (classes x rows of the class)."""
    counts = df.filter(ref(label).isNotNull()).groupBy(ref(label).alias("class")).agg(F.count(F.lit(1)).alias("cnt"))
    share = counts.agg(ratio(F.sum("cnt"), F.count(F.lit(1)))).scalar()
    return counts.select("class", ratio(share, F.col("cnt")).alias("weight"))


def with_class_weights(df: DataFrame, label: str, name: str = "weight", max_classes: int = 100) -> DataFrame:
    """Add the class weight; a few classes become a literal lookup."""
    weights = class_weights(df, label)
    rows = weights.limit(max_classes + 1).collect()
    if len(rows) <= max_classes:
        kind = ty.dtype_of(df, label)
        lookup = F.create_map(*[F.lit(x).cast(t) for r in rows for x, t in ((r[0], kind), (r[1], "double"))])
        return df.withColumn(name, F.try_element_at(lookup, ref(label)))
    joined = weights.withColumnsRenamed({"class": label, "weight": name})
    return df.join(joined, label, "left")


def train_baseline(train: DataFrame, features: Sequence[str], label: str, problem_type: str) -> Trained:
    """Logistic regression with penalty 1, or ordinary least squares.

    The penalty is stated per row, as the loss is averaged over rows.
    """
    if problem_type == "classification":
        est = LogisticRegression(
            featuresCol="features", labelCol=label, maxIter=LOGISTIC_ITERATIONS,
            regParam=1.0 / max(1, train.count()), elasticNetParam=0.0, standardization=False,
        )
    else:
        est = LinearRegression(featuresCol="features", labelCol=label, regParam=0.0)
    return _fit("Baseline Model", est, train, features, label, problem_type)


def _dealt(train: DataFrame) -> DataFrame:
    """The rows in partitions of bounded size; as they are, if none has more."""
    sizes = train.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("cnt"))
    found = sizes.agg(F.sum("cnt").alias("rows"), F.max("cnt").alias("most")).first()
    if (found["most"] or 0) <= TREE_ROWS:
        return train
    return train.repartition(math.ceil(found["rows"] / TREE_ROWS))


def train_forest(
    train: DataFrame, features: Sequence[str], label: str, problem_type: str,
    trees: int = FOREST_TREES, depth: int = FOREST_DEPTH, seed: int = SEED,
) -> Trained:
    """Random forest; classes are weighted to balance."""
    common = dict(
        featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth,
        minInstancesPerNode=FOREST_MIN_LEAF, seed=seed, maxMemoryInMB=FOREST_MEMORY_MB,
    )
    if problem_type == "classification":
        train = with_class_weights(train, label)
        est = RandomForestClassifier(weightCol="weight", **common)
    else:
        est = RandomForestRegressor(**common)
    return _fit("Random Forest", est, _dealt(train), features, label, problem_type)


def train_tuned(
    train: DataFrame, features: Sequence[str], label: str, problem_type: str,
    parallelism: int = 2, seed: int = SEED,
) -> Trained:
    """A small grid of forests and boosted trees, chosen on held-out rows.

    Boosted trees take part for regression and for two classes.
    """
    ready = _dealt(train).withColumn(label, ref(label).cast("double"))
    assembler = _assemble(train, features)
    shared = dict(featuresCol="features", labelCol=label, seed=seed)
    if problem_type == "classification":
        ready = with_class_weights(ready, label)
        forest = RandomForestClassifier(weightCol="weight", numTrees=50, **shared)
        boosted = GBTClassifier(maxIter=20, **shared)
        judge = MulticlassClassificationEvaluator(labelCol=label, metricName="weightedFMeasure")
        two = len(ready.select(label).distinct().limit(3).collect()) == 2
    else:
        forest = RandomForestRegressor(numTrees=50, **shared)
        boosted = GBTRegressor(maxIter=20, **shared)
        judge = RegressionEvaluator(labelCol=label, metricName="rmse")
        two = True
    families = [(forest, ParamGridBuilder().addGrid(forest.maxDepth, [5, 10]).build())]
    if two:
        families.append((boosted, ParamGridBuilder().addGrid(boosted.maxDepth, [3, 5]).build()))
    assembled = assembler.transform(ready)
    tried = []
    for est, grid in families:
        tuner = TrainValidationSplit(
            estimator=est, estimatorParamMaps=grid, evaluator=judge,
            trainRatio=0.8, parallelism=parallelism, seed=seed,
        )
        fitted = tuner.fit(assembled)
        tried += [(v, fitted.bestModel) for v in fitted.validationMetrics]
    pick = max if judge.isLargerBetter() else min
    best = PipelineModel([assembler, pick(tried, key=lambda t: t[0])[1]])
    return Trained("Tuned Trees", best, list(features), label, problem_type)


def score(trained: Trained, df: DataFrame) -> DataFrame:
    """The table with a ``prediction`` column."""
    out = trained.model.transform(df)
    return out.drop(*[c for c in ("features", "rawPrediction", "probability") if c not in df.columns])


# --- metrics -------------------------------------------------------------


def confusion(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """(y, yhat, cnt)."""
    return df.groupBy(ref(label).cast("double").alias("y"), ref(prediction).cast("double").alias("yhat")).agg(
        F.count(F.lit(1)).alias("cnt")
    )


def _class_scores(cells: DataFrame) -> DataFrame:
    cnt, zero = F.col("cnt"), F.lit(0).cast("bigint")
    sides = cells.select(
        rows_of(
            [
                F.struct(
                    F.col("y").alias("cls"), cnt.alias("actual"), zero.alias("said"),
                    F.when(F.col("y") == F.col("yhat"), cnt).otherwise(zero).alias("hit"),
                ),
                F.struct(F.col("yhat").alias("cls"), zero.alias("actual"), cnt.alias("said"), zero.alias("hit")),
            ]
        )
    )
    per = sides.groupBy("cls").agg(*[F.sum(c).alias(c) for c in ("actual", "said", "hit")])
    p = F.coalesce(ratio(F.col("hit"), F.col("said")), F.lit(0.0))
    r = F.coalesce(ratio(F.col("hit"), F.col("actual")), F.lit(0.0))
    f1 = F.coalesce(ratio(2 * p * r, p + r), F.lit(0.0))
    return per.select("cls", "actual", "hit", p.alias("p"), r.alias("r"), f1.alias("f1"))


def classification_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """(metric, value): accuracy, weighted precision, recall and F1, and for
    two classes the ROC AUC of the hard labels.

    The table is read once, into confusion cells.
    """
    per = _class_scores(confusion(df, label, prediction))
    n = F.sum("actual")
    w = F.col("actual")
    present = F.count_if(w > 0)
    wide = per.agg(
        ratio(F.sum("hit"), n).alias("accuracy"),
        ratio(F.sum(w * F.col("p")), n).alias("precision"),
        ratio(F.sum(w * F.col("r")), n).alias("recall"),
        ratio(F.sum(w * F.col("f1")), n).alias("f1_weighted"),
        F.when(present == 2, F.avg(F.when(w > 0, F.col("r")))).alias("roc_auc"),
    )
    names = ["accuracy", "precision", "recall", "f1_weighted", "roc_auc"]
    return _metric_rows(wide, names).filter("value is not null")


def _metric_rows(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    return wide.select(
        rows_of([F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names])
    )


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """(metric, value): rmse and r2, one aggregate."""
    y, yhat = ref(label).cast("double"), ref(prediction).cast("double")
    both = yhat.isNotNull() & y.isNotNull()
    miss = F.sum((y - yhat) * (y - yhat))
    n = F.count_if(both)
    wide = df.agg(
        F.sqrt(ratio(miss, n)).alias("rmse"),
        (1.0 - ratio(miss, n * F.var_pop(F.when(both, y)))).alias("r2"),
    )
    return _metric_rows(wide, ["rmse", "r2"])


def metrics_for(problem_type: str, df: DataFrame, label: str) -> DataFrame:
    if problem_type == "classification":
        return classification_metrics(df, label)
    return regression_metrics(df, label)


def main_score(problem_type: str, metrics: DataFrame) -> float:
    name = "f1_weighted" if problem_type == "classification" else "rmse"
    return metrics.filter(F.col("metric") == name).first()["value"]


def select_model(scores: DataFrame, problem_type: str) -> DataFrame:
    """(model, score) of the best row of (model, score, is_baseline).

    Higher F1 or lower RMSE wins; the baseline wins a tie.
    """
    best = F.desc("score") if problem_type == "classification" else F.asc("score")
    return scores.orderBy(best, F.desc("is_baseline")).limit(1).select("model", "score")


def sanity_check(metrics: DataFrame, problem_type: str) -> DataFrame:
    """(check, passed, detail): accuracy >= 0.55, or r2 >= 0."""
    name, floor = ("accuracy", GUESSING_ACCURACY) if problem_type == "classification" else ("r2", 0.0)
    worth = F.coalesce(F.max(F.when(F.col("metric") == name, F.col("value"))), F.lit(0.0))
    return metrics.agg(worth.alias("detail")).select(
        F.lit(name).alias("check"), (F.col("detail") >= floor).alias("passed"), "detail"
    )


# --- importance ----------------------------------------------------------


def _donor_rows(df: DataFrame, keys: Sequence[str], seed: int, rows_per_bucket: int) -> DataFrame:
    """Give each row another row's feature array (column ``donor``).

    Rows are dealt by hash into buckets and put in hash order there; each row
    takes the features of the next, the last those of the first.  That is a
    permutation of the table's rows, with one shuffle of evenly sized buckets.
    """
    buckets = max(1, math.ceil(df.count() / rows_per_bucket))
    key = [ref(k) for k in keys]
    bucket = F.pmod(F.xxhash64(F.lit(f"bucket{seed}"), *key), F.lit(buckets))
    order = Window.partitionBy("__bucket").orderBy(F.xxhash64(F.lit(f"order{seed}"), *key), *key)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn("__bucket", bucket).withColumn(
        "donor", F.coalesce(F.lead("x").over(order), F.first("x").over(whole))
    )


def permutation_importance(
    trained: Trained, test: DataFrame, keys: Sequence[str], repeats: int = IMPORTANCE_REPEATS,
    seed: int = SEED, rows_per_bucket: int = 10_000,
) -> DataFrame:
    """(feature, importance, std): mean drop of accuracy or R2 when permuted.

    Every row is scored once as is and once per feature with that one slot
    taken from its donor row, all in one ``transform`` per repeat.
    """
    feats, label = trained.features, trained.label
    assembler, model = trained.model.stages[0], trained.model.stages[-1]
    arrays = assembler.transform(test).select(
        *[ref(k) for k in keys], ref(label).cast("double").alias("y"), vector_to_array("features").alias("x")
    )
    slots = _slot_names(trained, test)
    frames = []
    for rep in range(repeats):
        donors = _donor_rows(arrays, keys, seed + rep, rows_per_bucket)
        variants = donors.select("y", "x", "donor", F.explode(F.sequence(F.lit(0), F.lit(len(slots)))).alias("slot"))
        mixed = F.transform("x", lambda v, i: F.when(i == F.col("slot") - 1, F.get("donor", i)).otherwise(v))
        scored = model.transform(variants.select("y", "slot", array_to_vector(mixed).alias("features")))
        if trained.problem_type == "classification":
            value = F.avg((F.col("prediction") == F.col("y")).cast("double"))
        else:
            gap = F.col("y") - F.col("prediction")
            value = 1.0 - ratio(F.sum(gap * gap), F.count(F.lit(1)) * F.var_pop("y"))
        frames.append(scored.groupBy("slot").agg(value.alias("score")).withColumn("rep", F.lit(rep)))
    scores = frames[0]
    for f in frames[1:]:
        scores = scores.unionByName(f)
    # One row per feature slot and repeat from here on.
    base = F.max(F.when(F.col("slot") == 0, F.col("score"))).over(Window.partitionBy("rep"))
    drops = scores.withColumn("drop", base - F.col("score")).filter("slot > 0")
    name = F.element_at(F.array(*[F.lit(s) for s in slots]), F.col("slot"))
    return drops.groupBy(name.alias("feature")).agg(
        F.avg("drop").alias("importance"), F.coalesce(F.stddev_pop("drop"), F.lit(0.0)).alias("std")
    )


def _slot_names(trained: Trained, df: DataFrame) -> list[str]:
    """One name per vector position; scalar features have one each."""
    attrs = trained.model.stages[0].transform(df.limit(0)).schema["features"].metadata
    size = attrs.get("ml_attr", {}).get("num_attrs", len(trained.features))
    if size == len(trained.features):
        return list(trained.features)
    named: dict[int, str] = {}
    for group in attrs["ml_attr"].get("attrs", {}).values():
        named.update({a["idx"]: a.get("name", f"f{a['idx']}") for a in group})
    return [named.get(i, f"f{i}") for i in range(size)]


def intrinsic_importance(trained: Trained) -> list[tuple[str, float]]:
    """Tree importances, else absolute coefficients (first class row)."""
    model = trained.model.stages[-1]
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif getattr(model, "numClasses", 2) > 2:
        values = abs(model.coefficientMatrix.toArray()[0])
    else:
        values = abs(model.coefficients.toArray())
    names = trained.features if len(values) == len(trained.features) else [f"f{i}" for i in range(len(values))]
    return [(f, float(v)) for f, v in zip(names, values)]


def ranked_importance(
    trained: Trained, test: DataFrame, keys: Sequence[str], top: int | None = None,
    repeats: int = IMPORTANCE_REPEATS,
) -> DataFrame:
    """(feature, importance) by size; the model's own when permuting shows nothing."""
    found = permutation_importance(trained, test, keys, repeats).select("feature", "importance")
    rows = [(r["feature"], r["importance"]) for r in found.collect()]
    if all(v in (None, 0.0) for _, v in rows):
        rows = intrinsic_importance(trained)
    ranked = test.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc(F.abs("importance")), "feature"
    )
    return ranked.limit(top) if top else ranked
