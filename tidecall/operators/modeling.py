"""Encoding, training, scoring and search with Spark ML."""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecall import fixed_values as V
from tidecall.functions import columns as C
from tidecall.functions.ordered import number_rows
from tidecall.operators.boosting import BoostedTrees, Plan, as_model, boost
from tidecall.operators.evaluation import prediction_summary
from tidecall.session import materialize

#: Rows that one task of a forest holds, each with a number per tree.
FOREST_ROWS_PER_TASK = 200_000

# --- encoders as DataFrame functions -----------------------------------------------------


def standardize(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Subtract the mean and divide by the population deviation; a constant column becomes zero."""
    parts = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        parts += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    fitted = df if fit_on is None else fit_on
    scaled = {}
    for i, c in enumerate(cols):
        spread = F.col(f"__fit.s{i}")
        centered = (F.col(f"`{c}`") - F.col(f"__fit.m{i}")) / spread
        scaled[c] = F.when(spread == 0, F.lit(0.0)).otherwise(centered)
    with_fit = df.withColumn("__fit", fitted.agg(F.struct(*parts)).scalar())
    return with_fit.withColumns(scaled).drop("__fit")


def one_hot_stages(categorical: list[str]) -> list[Estimator]:
    """Indexer and encoder. Levels unseen in fitting encode to zeros; every seen level has a slot."""
    indexed = [f"{c}__index" for c in categorical]
    return [
        StringIndexer(
            inputCols=categorical, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
        ),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}__onehot" for c in categorical], dropLast=True),
    ]


def level_numbers(df: DataFrame, categorical: list[str]) -> DataFrame:
    """``column, level, slot``: the levels of each column in alphabetical order, numbered from 0 across columns.

    However many levels there are, they are a table and never meet on the driver or in one task.
    """
    entries = [F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("level")) for i, c in enumerate(categorical)]
    # Levels are counted per task before they are shuffled.
    levels = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where("level is not null").distinct()
    numbered = number_rows(levels, ["place", "level"], "slot")
    return numbered.select("column", "level", (F.col("slot") - 1).alias("slot"))


def one_hot_sparse(df: DataFrame, categorical: list[str], key: str, levels: DataFrame | None = None) -> DataFrame:
    """``key, slots, size``: the slots of each row that are 1, ascending, of ``size`` in all.

    ``levels`` is a table as of :func:`level_numbers`, by default that of ``df``. Each row's levels
    are joined with it as a table, so that their number has no bound; levels that it lacks have no slot.
    ``key`` must be unique.
    """
    levels = materialize(level_numbers(df, categorical) if levels is None else levels, "levels")
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("level")) for c in categorical]
    long = df.select(F.col(f"`{key}`"), F.explode(F.array(*entries)).alias("e")).select(key, "e.*")
    found = long.join(levels, ["column", "level"], "left").groupBy(key).agg(F.sort_array(F.collect_list("slot")).alias("slots"))
    size = levels.agg(F.count("*").alias("n"))
    return found.select(key, "slots", size.scalar().alias("size"))


def one_hot(
    df: DataFrame, categorical: list[str], fit_on: DataFrame | None = None, max_levels: int = 1000
) -> DataFrame:
    """One 0/1 column per fitted level, named ``column_level``.

    A plan with a column per level holds no more than ``max_levels`` of them, else a ``ValueError``
    points to :func:`one_hot_sparse`; their number is checked before any level is fetched.
    """
    fitted = df if fit_on is None else fit_on
    counts = fitted.agg(*[F.count_distinct(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(categorical)]).first()
    if sum(counts) > max_levels:
        raise ValueError(f"{sum(counts)} levels are more than {max_levels}; use one_hot_sparse")
    model = Pipeline(stages=one_hot_stages(categorical)).fit(fitted)
    encoded = model.transform(df)
    levels = dict(zip(categorical, model.stages[0].labelsArray))
    flags = [
        vector_to_array(f"{c}__onehot")[i].cast("int").alias(f"{c}_{level}")
        for c in categorical
        for i, level in enumerate(levels[c])
    ]
    helpers = [f"{c}__index" for c in categorical] + [f"{c}__onehot" for c in categorical]
    return encoded.select("*", *flags).drop(*helpers)


# --- pipelines -------------------------------------------------------------------------


def feature_stages(numeric: list[str], categorical: list[str]) -> list[Estimator]:
    """Standardised numbers and one-hot categories in the vector column ``features``."""
    stages: list[Estimator] = []
    parts = []
    if numeric:
        stages += [
            VectorAssembler(inputCols=numeric, outputCol="numbers", handleInvalid="keep"),
            StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        ]
        parts.append("scaled")
    if categorical:
        stages += one_hot_stages(categorical)
        parts += [f"{c}__onehot" for c in categorical]
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def boosted_trees(
    label: str = V.LABEL_COLUMN,
    learning_rate: float = V.LEARNING_RATE,
    n_estimators: int = V.N_ESTIMATORS,
    max_depth: int = V.MAX_DEPTH,
    seed: int = V.SEED,
) -> GBTClassifier:
    return BoostedTrees(
        labelCol=label, stepSize=learning_rate, maxIter=n_estimators, maxDepth=max_depth, seed=seed
    )


class SpreadForest(RandomForestClassifier):
    """``RandomForestClassifier`` whose tasks hold a bounded number of rows.

    Spark keeps each row with its count in every tree, over a kilobyte for 200 trees, in as many
    parts as the input has.
    """

    def _fit(self, dataset: DataFrame) -> Model:
        rows = materialize(dataset.select(self.getFeaturesCol(), self.getLabelCol()), "forest")
        parts = math.ceil(rows.count() / FOREST_ROWS_PER_TASK)
        return super()._fit(rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows)


def random_forest(
    label: str = V.LABEL_COLUMN,
    n_estimators: int = V.N_ESTIMATORS,
    max_depth: int = V.MAX_DEPTH,
    seed: int = V.SEED,
) -> RandomForestClassifier:
    return SpreadForest(labelCol=label, numTrees=n_estimators, maxDepth=max_depth, seed=seed)


def classifier_pipeline(
    classifier: Estimator, numeric: list[str] | None = None, categorical: list[str] | None = None
) -> Pipeline:
    numeric = V.NUMERIC_COLUMNS if numeric is None else numeric
    categorical = V.CATEGORICAL_COLUMNS if categorical is None else categorical
    return Pipeline(stages=[*feature_stages(numeric, categorical), classifier])


def train(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    return pipeline.fit(df)


# --- scoring -----------------------------------------------------------------------------


def score(model: Model, df: DataFrame, threshold: float = V.THRESHOLD) -> DataFrame:
    """Input columns plus ``probability`` of the positive class and the 0/1 ``prediction``.

    A model without probabilities keeps its own prediction.
    """
    out = model.transform(df)
    if "probability" in out.columns:
        chance = vector_to_array("probability")[1]
        out = out.withColumn("probability", chance).withColumn("prediction", C.decide("probability", threshold))
        return out.select(*df.columns, "probability", "prediction")
    return out.select(*df.columns, F.col("prediction").cast("int").alias("prediction"))


def wrapped_predict(
    model: Model,
    df: DataFrame,
    key: str | list[str],
    threshold: float = V.THRESHOLD,
    boost: float = V.CONFIDENCE_BOOST,
) -> tuple[DataFrame, DataFrame]:
    """Adjusted predictions per row, and their one-row summary."""
    scored = score(model, df, threshold)
    rows = scored.withColumn("prediction", C.adjust_prediction("prediction", key, boost))
    return rows, prediction_summary(rows, threshold=threshold)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- importances -------------------------------------------------------------------------


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names of the slots of ``features``, from the metadata that the stages leave behind."""
    field = model.transform(df).schema["features"]
    groups = field.metadata["ml_attr"]["attrs"].values()
    slots = sorted(((a["idx"], a.get("name", f"slot_{a['idx']}")) for g in groups for a in g))
    return [name for _, name in slots]


def feature_importance(model: PipelineModel, df: DataFrame, numeric: list[str] | None = None) -> DataFrame:
    """Importance per encoded feature as rows; one row per slot of the feature vector."""
    numeric = V.NUMERIC_COLUMNS if numeric is None else numeric
    names = feature_names(model, df)
    plain = [numeric[i] if i < len(numeric) else n.replace("__onehot_", "_") for i, n in enumerate(names)]
    values = model.stages[-1].featureImportances.toArray().tolist()
    return df.sparkSession.createDataFrame(list(zip(plain, values)), "feature string, importance double")


def top_importances(importance: DataFrame, n: int = V.TOP_IMPORTANCES) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def importance_summary(
    importance: DataFrame, originals: list[str] | None = None, n: int = V.TOP_IMPORTANCES
) -> DataFrame:
    """Mean importance, and how many of the top ``n`` names contain no original column name."""
    originals = originals or V.NUMERIC_COLUMNS + V.CATEGORICAL_COLUMNS
    from_original = F.exists(F.lit(originals), lambda o: F.contains(F.col("feature"), o))
    top = top_importances(importance, n).agg(F.count_if(~from_original).alias("engineered_in_top"))
    return importance.agg(F.avg("importance").alias("mean_importance")).withColumn(
        "engineered_in_top", top.scalar()
    )


# --- search ------------------------------------------------------------------------------


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The boosted model that stops after ``n`` trees; boosting adds trees and never changes earlier ones."""
    if n >= model.getNumTrees:
        return model
    jvm = SparkContext._active_spark_context._jvm
    trees = model._java_obj.trees()
    gateway = SparkContext._active_spark_context._gateway
    kept = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(jvm.double, n)
    for i in range(n):
        kept[i], weights[i] = trees[i], float(model.treeWeights[i])
    shorter = GBTClassificationModel(
        jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{model.uid}_{n}", kept, weights)
    )
    return model._copyValues(shorter)


def grid_search(
    df: DataFrame,
    grid: dict[str, list] | None = None,
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
    label: str = V.LABEL_COLUMN,
    parallelism: int = 4,
    seed: int = V.SEED,
) -> tuple[DataFrame, Model]:
    """Held-out ROC AUC of every parameter combination as rows, and the best model.

    Combinations that differ in the number of trees share a fit: the one with most trees
    also holds those with fewer, which are scored in stages. All fits go through the rows
    together; scores are evaluated ``parallelism`` at a time.
    """
    grid = grid or V.GRID
    encoders = Pipeline(stages=feature_stages(
        V.NUMERIC_COLUMNS if numeric is None else numeric,
        V.CATEGORICAL_COLUMNS if categorical is None else categorical,
    ))
    # The side of a row follows from its values, not from the layout of the table.
    side = F.pmod(F.xxhash64("features", label, F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    coded = encoders.fit(df).transform(df).select("features", label, (side >= V.TEST_FRACTION).alias("__fitted"))
    encoded = materialize(coded, "encoded")
    stages = sorted(set(grid["n_estimators"]))
    choices = [(float(r), int(d)) for r in grid["learning_rate"] for d in grid["max_depth"]]
    plans = [Plan(rate, depth, stages[-1]) for rate, depth in choices]
    trees, columns, margins = boost(encoded, label, plans, fitted=F.col("__fitted"), stages=stages)

    def evaluate(place: tuple[int, int]) -> float:
        m, n = place
        evaluator = BinaryClassificationEvaluator(rawPredictionCol=f"m{m}", labelCol=label, numBins=0)
        return evaluator.evaluate(margins[n])

    places = [(m, n) for m in range(len(plans)) for n in stages]
    with ThreadPool(min(parallelism, len(places))) as pool:
        values = pool.map(inheritable_thread_target(evaluate), places)
    found = [(value, *choices[m], n) for value, (m, n) in zip(values, places)]
    at = max(range(len(found)), key=lambda i: found[i][0])
    _, rate, depth, n = found[at]
    best = as_model(boosted_trees(label, rate, n, depth, seed), trees[places[at][0]][:n], columns)
    scores = df.sparkSession.createDataFrame(
        [(rate, depth, n, float(score)) for score, rate, depth, n in found],
        "learning_rate double, max_depth int, n_estimators int, score double",
    )
    return scores, best
