"""Feature pipelines, training, search, comparison, scoring and learning loops on spark.ml."""

from __future__ import annotations

import itertools
import random
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    PCA, Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.operators.evaluation import classification_summary, regression_summary
from brightledger.operators.selection import most_uncertain, pseudo_labels, pseudo_targets, random_split
from brightledger.session import materialise

SEED = 42


def with_features(df: DataFrame, array_column: str, name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(F.col(array_column).cast("array<double>")))


def for_rounds(df: DataFrame) -> DataFrame:
    """Rows for training in many rounds: in as many partitions as the cluster has cores, at most.

    Every task of a round sends a gradient and its counters to the driver, so what is sent follows the cores and the rounds, not the input.
    """
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism)


def split_parts(df: DataFrame, key: str, train_ratio: float = 0.8, seed: int = SEED, stored: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Training and test rows. With ``stored``, rows are written with their part first, so keys are hashed once and not in every pass of every fit."""
    s = random_split(df, key, {"train": train_ratio, "test": 1 - train_ratio}, seed)
    if stored:
        s = materialise(s, stored)
    return tuple(s.filter(F.col("split") == p).drop("split") for p in ("train", "test"))


# --- feature steps --------------------------------------------------------------------------------

def one_hot_steps(columns: Sequence[str], drop_last: bool = False) -> list[Estimator]:
    """Index by sorted value, then encode; a value unseen in training gets no flag of its own kind."""
    codes = [f"{c}_code" for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=codes, outputCols=[f"{c}_hot" for c in columns], dropLast=drop_last)]


def imputer(columns: Sequence[str], strategy: str = "mean") -> Imputer:
    return Imputer(inputCols=list(columns), outputCols=[f"{c}_filled" for c in columns], strategy=strategy)


def column_transformer(numeric: Sequence[str], nominal: Sequence[str]) -> Pipeline:
    """Imputed, scaled numeric columns and one-hot nominal columns in one ``features`` vector.

    The scaler divides by the sample deviation.
    """
    filled = [f"{c}_filled" for c in numeric]
    stages = [imputer(numeric), VectorAssembler(inputCols=filled, outputCol="numeric"),
              StandardScaler(inputCol="numeric", outputCol="scaled", withMean=True, withStd=True)]
    stages += one_hot_steps(nominal)
    stages.append(VectorAssembler(inputCols=["scaled", *[f"{c}_hot" for c in nominal]], outputCol="features"))
    return Pipeline(stages=stages)


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight n / (classes * n_class) per row; one aggregate row per class."""
    per = df.groupBy(label).agg(F.count("*").alias("_c"))
    total = per.agg(F.struct(F.sum("_c").alias("n"), F.count("*").alias("k"))).scalar()
    weights = per.select(label, (total.getField("n") / (total.getField("k") * F.col("_c"))).alias(name))
    return df.join(weights, label, "left")


# --- estimators ------------------------------------------------------------------------------------

def binary_classifiers(n_features: int) -> dict[str, Estimator]:
    return {
        "logistic_regression": LogisticRegression(maxIter=50),
        "random_forest": RandomForestClassifier(numTrees=20, maxDepth=5, seed=SEED),
        "gradient_boosting": GBTClassifier(maxIter=5, maxDepth=3, seed=SEED),
        "linear_svc": LinearSVC(maxIter=20),
        "perceptron": MultilayerPerceptronClassifier(layers=[n_features, 16, 16, 16, 2], maxIter=50, seed=SEED),
    }


def boosted_multiclass(max_iter: int = 3, max_depth: int = 3) -> OneVsRest:
    """Boosting is binary, so one booster per class."""
    return OneVsRest(classifier=GBTClassifier(maxIter=max_iter, maxDepth=max_depth, seed=SEED), parallelism=4)


def regressors() -> dict[str, Estimator]:
    return {
        "linear_regression": LinearRegression(maxIter=20),
        "decision_tree": DecisionTreeRegressor(maxDepth=5, seed=SEED),
        "random_forest": RandomForestRegressor(numTrees=20, maxDepth=5, seed=SEED),
        "gradient_boosting": GBTRegressor(maxIter=20, maxDepth=5, seed=SEED),
    }


def cross_validated(estimator: Estimator, grid: dict[str, list], evaluator: Evaluator, folds: int = 3,
                    parallelism: int = 4) -> CrossValidator:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    return CrossValidator(estimator=estimator, estimatorParamMaps=builder.build(), evaluator=evaluator, numFolds=folds,
                          parallelism=parallelism, seed=SEED)


def random_search(estimator: Estimator, space: dict[str, list], trials: int, evaluator: Evaluator, folds: int = 3,
                  parallelism: int = 4, seed: int = SEED) -> CrossValidator:
    """As a grid search over a seeded choice of ``trials`` settings."""
    every = list(itertools.product(*space.values()))
    chosen = random.Random(seed).sample(every, min(trials, len(every)))
    maps = [{estimator.getParam(n): v for n, v in zip(space, values)} for values in chosen]
    return CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds,
                          parallelism=parallelism, seed=SEED)


def search_table(spark, model) -> DataFrame:
    """One row per tried setting: parameters as text, mean metric."""
    rows = []
    for params, metric in zip(model.getEstimatorParamMaps(), model.avgMetrics):
        rows.append((", ".join(sorted(f"{p.name}={v}" for p, v in params.items())), float(metric)))
    return spark.createDataFrame(rows, "setting string, metric double").orderBy(F.desc("metric"), "setting")


def auc_evaluator(label: str) -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction")


def accuracy_evaluator(label: str) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")


# --- comparison, importance, scoring ----------------------------------------------------------------

def compare(models: dict[str, Estimator], train: DataFrame, test: DataFrame, label: str,
            kind: str = "classification") -> DataFrame:
    """Fit each model and report one metrics row per model."""
    out = None
    for name, est in models.items():
        fitted = est.copy({est.getParam("labelCol"): label}).fit(train)
        scored = fitted.transform(test).withColumn("prediction", F.col("prediction").cast("double"))
        summary = (classification_summary(scored.withColumn(label, F.col(label).cast("double")), label, "prediction")
                   if kind == "classification" else regression_summary(scored, label, "prediction"))
        row = summary.select(F.lit(name).alias("model"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    attrs = df.schema[column].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted(itertools.chain.from_iterable(attrs.values()), key=lambda a: a["idx"])]


def importance_table(spark, names: Sequence[str], values) -> DataFrame:
    """(feature, value): importances or coefficients, largest absolute value first."""
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, value double").orderBy(F.abs("value").desc(), "feature")


def score_table(model: Model, df: DataFrame, key: str) -> DataFrame:
    """Submission table (id, label)."""
    return model.transform(df).select(F.col(key).alias("id"), F.col("prediction").alias("label"))


def prediction_table(models: dict[str, Model], df: DataFrame, key: str) -> DataFrame:
    """One (label, confidence) column pair per model; models without probabilities give none."""
    out = df
    extra = []
    for name, m in models.items():
        scored = m.transform(out)
        confidence = F.lit(None).cast("double")
        if "probability" in scored.columns:
            confidence = F.array_max(vector_to_array("probability"))
        out = scored.withColumns({f"{name}_label": F.col("prediction").cast("int"), f"{name}_confidence": confidence}).drop(
            "prediction", "probability", "rawPrediction")
        extra += [f"{name}_label", f"{name}_confidence"]
    return out.select(key, *extra)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- learning loops -----------------------------------------------------------------------------------

def _class_probabilities(scored: DataFrame) -> DataFrame:
    return scored.withColumn("probs", vector_to_array("probability"))


def _history(spark, rows: list[tuple], metrics: str) -> DataFrame:
    return spark.createDataFrame(rows, f"round int, n_labelled bigint, {metrics}").orderBy("round")


def self_training(labelled: DataFrame, pool: DataFrame, test: DataFrame, key: str, label: str,
                  estimator: Estimator | None = None, rounds: int = 3, fraction: float = 0.1) -> DataFrame:
    """Each round: fit, measure on the fixed test part, move the most confident pool rows (with their
    predicted class) to the training rows. Moved rows are written, so plans do not grow."""
    est = estimator or LogisticRegression(labelCol=label, maxIter=30)
    cols = [key, "features", label]
    train, rest = materialise(labelled.select(*cols), "train"), materialise(pool.select(key, "features"), "pool")
    rows = []
    for r in range(1, rounds + 1):
        model = est.fit(train)
        scored = model.transform(test).select(F.col(label).cast("double").alias("y"), "prediction")
        q = classification_summary(scored, "y", "prediction").first()
        rows.append((r, train.count(), q["accuracy"], q["macro_f1"]))
        guesses = _class_probabilities(model.transform(rest)).select(key, "features", "probs")
        moved = materialise(pseudo_labels(guesses, "probs", key, fraction).select(
            key, "features", F.col("pseudo_label").cast(train.schema[label].dataType).alias(label)), "moved")
        if moved.isEmpty():
            break
        train = materialise(train.unionByName(moved), "train")
        rest = materialise(rest.join(moved.select(key), key, "left_anti"), "pool")
    return _history(labelled.sparkSession, rows, "accuracy double, macro_f1 double")


def self_training_regression(labelled: DataFrame, pool: DataFrame, test: DataFrame, key: str, label: str,
                             estimator: Estimator | None = None, rounds: int = 3, fraction: float = 0.1) -> DataFrame:
    """Regression form: rows predicted farthest from the mean prediction are moved."""
    est = estimator or LinearRegression(labelCol=label, maxIter=20, regParam=0.1)
    cols = [key, "features", label]
    train, rest = materialise(labelled.select(*cols), "train"), materialise(pool.select(key, "features"), "pool")
    rows = []
    for r in range(1, rounds + 1):
        model = est.fit(train)
        q = regression_summary(model.transform(test), label, "prediction").first()
        rows.append((r, train.count(), q["mse"], q["r2"]))
        guesses = model.transform(rest).select(key, "features", "prediction")
        moved = materialise(pseudo_targets(guesses, "prediction", key, fraction).select(
            key, "features", F.col("prediction").cast(train.schema[label].dataType).alias(label)), "moved")
        if moved.isEmpty():
            break
        train = materialise(train.unionByName(moved), "train")
        rest = materialise(rest.join(moved.select(key), key, "left_anti"), "pool")
    return _history(labelled.sparkSession, rows, "mse double, r2 double")


def active_learning(labelled: DataFrame, pool: DataFrame, answers: DataFrame, test: DataFrame, key: str, label: str,
                    strategy: str, per_round: int = 20, rounds: int = 3, estimator: Estimator | None = None) -> DataFrame:
    """Each round asks for the labels of the most uncertain pool rows; they arrive from the
    ``answers (key, label)`` table. Asked rows leave the pool whether or not an answer exists."""
    est = estimator or LogisticRegression(labelCol=label, maxIter=30)
    cols = [key, "features", label]
    train, rest = materialise(labelled.select(*cols), "train"), materialise(pool.select(key, "features"), "pool")
    rows = []
    for r in range(1, rounds + 1):
        model = est.fit(train)
        scored = model.transform(test).select(F.col(label).cast("double").alias("y"), "prediction")
        q = classification_summary(scored, "y", "prediction").first()
        rows.append((r, train.count(), q["accuracy"], q["macro_f1"]))
        asked = materialise(most_uncertain(_class_probabilities(model.transform(rest)), "probs", key, strategy, per_round)
                            .select(key, "features"), "asked")
        if asked.isEmpty():
            break
        train = materialise(train.unionByName(asked.join(answers.select(key, label), key).select(*cols)), "train")
        rest = materialise(rest.join(asked.select(key), key, "left_anti"), "pool")
    return _history(labelled.sparkSession, rows, "accuracy double, macro_f1 double")


def active_learning_regression(labelled: DataFrame, pool: DataFrame, answers: DataFrame, test: DataFrame, key: str,
                               label: str, per_round: int = 20, rounds: int = 3, estimator: Estimator | None = None) -> DataFrame:
    """Regression form: asks for the rows predicted farthest from the mean prediction."""
    est = estimator or LinearRegression(labelCol=label, maxIter=20, regParam=0.1)
    cols = [key, "features", label]
    train, rest = materialise(labelled.select(*cols), "train"), materialise(pool.select(key, "features"), "pool")
    rows = []
    for r in range(1, rounds + 1):
        model = est.fit(train)
        q = regression_summary(model.transform(test), label, "prediction").first()
        rows.append((r, train.count(), q["mse"], q["r2"]))
        guesses = model.transform(rest).select(key, "features", "prediction")
        mean = guesses.agg(F.avg("prediction")).scalar()
        far = guesses.withColumn("_mean", mean).orderBy(F.abs(F.col("prediction") - F.col("_mean")).desc(), key)
        asked = materialise(far.limit(per_round).select(key, "features"), "asked")
        if asked.isEmpty():
            break
        train = materialise(train.unionByName(asked.join(answers.select(key, label), key).select(*cols)), "train")
        rest = materialise(rest.join(asked.select(key), key, "left_anti"), "pool")
    return _history(labelled.sparkSession, rows, "mse double, r2 double")


# --- representation -----------------------------------------------------------------------------------

def principal_components(df: DataFrame, k: int, column: str = "features", name: str = "components"):
    """(projected frame, fitted model) from the square matrix of all dimensions; see ``principal`` for long vectors and shares."""
    model = PCA(k=k, inputCol=column, outputCol=name).fit(df)
    return model.transform(df), model
