"""End-to-end jobs: prepare data, publish features and build a training set, train and score."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecall import fixed_values as V
from tidecall.operators import cleaning, evaluation, features, lookup, modeling, runs, splitting
from tidecall.session import materialize
from tidecall.sources import scans
from tidecall.sources.paths import DatasetPaths, save_split_paths
from tidecall.sources.tables import TableStore

log = logging.getLogger(__name__)


# --- prepare ---------------------------------------------------------------------------


def prepare(
    raw: DataFrame,
    key: list[str] | None = None,
    fraction: float = V.TEST_FRACTION,
    exact: bool = True,
) -> DataFrame:
    """Cleaned rows with their side of the split.

    For an exact split the cleaned table is written once and the labelled one
    once, partitioned by side: the passes of the split and the four copies made
    later read files instead of repeating the upstream plan.
    """
    cleaned = cleaning.clean(raw, keep=tuple(key or ()))
    if exact:
        labelled = splitting.split_exact(materialize(cleaned, "clean"), key, fraction)
    else:
        labelled = splitting.split_threshold(cleaned, key, fraction)
    return materialize(labelled, "labelled", ["split"])


def prepare_and_save(
    read: Callable[[], DataFrame],
    key: list[str],
    paths: DatasetPaths | None = None,
    tables: TableStore | None = None,
    tables_required: bool = True,
) -> DataFrame | None:
    """Scan, clean, split and store; ``None`` when the source is absent.

    Paths are written first. With ``tables_required=False`` a failing table
    write is only logged, because the paths already hold the data.
    """
    raw = scans.read_if_present(read, "source data")
    if raw is None:
        return None
    labelled = prepare(raw, key)
    if paths:
        save_split_paths(labelled, paths)
    if tables:
        try:
            tables.ensure_schema()
            tables.save_split(labelled)
        except Exception as e:
            if tables_required:
                raise
            log.warning("tables not saved: %s", e)
    return labelled


def load_split(
    spark: SparkSession, tables: TableStore | None, paths: DatasetPaths | None
) -> tuple[DataFrame, DataFrame, str]:
    """Training and test rows and the data version: both from tables, else both from paths.

    The two sides are one reader, so they never come from different splits.
    """
    readers = []
    if tables:
        readers.append(tables.load_pair)
    if paths:
        sides = [paths.path("processed", subset) for subset in ("train", "test")]
        readers.append(lambda: (*[scans.read_path(spark, p) for p in sides], "0"))
    train, test, version = scans.first_available(readers)
    return cleaning.encode_label(train), cleaning.encode_label(test), version


# --- features --------------------------------------------------------------------------


def publish_feature_tables(
    raw: DataFrame, tables: TableStore, buckets: int | None = None
) -> list[lookup.FeatureLookup]:
    """Derive the two feature tables, key them by a digest of their natural key, and publish them."""
    customers = lookup.surrogate_key(features.customer_features(raw), V.CUSTOMER_KEY, "customer_id")
    campaigns = lookup.surrogate_key(features.campaign_features(raw), V.CAMPAIGN_KEY, "campaign_id")
    tables.publish_features(customers, "customer_features", ["customer_id"], "Customer features", buckets)
    tables.publish_features(campaigns, "campaign_features", ["campaign_id"], "Campaign features", buckets)
    return lookup.standard_lookups(tables.load("customer_features"), tables.load("campaign_features"), published=True)


def build_training_set(raw: DataFrame, lookups: list[lookup.FeatureLookup], key: tuple[str, ...]) -> DataFrame:
    return lookup.training_set(features.normalize_text(raw), lookups, keep=key)


def build_scoring_set(raw: DataFrame, lookups: list[lookup.FeatureLookup], key: tuple[str, ...]) -> DataFrame:
    return lookup.scoring_set(features.normalize_text(raw), lookups, keep=key)


# --- train and score -----------------------------------------------------------------------


@dataclass(frozen=True)
class TrainedModel:
    model: PipelineModel
    path: str
    run_id: str
    metrics: DataFrame


def train_and_log(
    train: DataFrame,
    test: DataFrame,
    run_log: runs.RunLog,
    run_id: str,
    model_path: str,
    classifier: Estimator | None = None,
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
    data_version: str = "0",
    tags: dict[str, str] | None = None,
) -> TrainedModel:
    """Fit, save, evaluate on the test rows, and record parameters, metrics and the input."""
    classifier = classifier or modeling.boosted_trees()
    model = modeling.train(modeling.classifier_pipeline(classifier, numeric, categorical), train)
    modeling.save_model(model, model_path)
    scored = modeling.score(model, test).select(
        F.col(V.LABEL_COLUMN).alias("label"), F.col("probability").alias("score"), "prediction"
    )
    bundle = evaluation.metric_bundle(materialize(scored, "scores"))
    measured = {k: v for r in bundle.collect() for k, v in r.asDict().items() if v is not None}
    params = {p.name: v for p, v in classifier.extractParamMap().items()}
    run_log.log_params(run_id, params)
    run_log.log_tags(run_id, (tags or {}) | {"model_path": model_path})
    run_log.log_metrics(run_id, measured)
    run_log.append("inputs", runs.input_record(train, run_id, "train_processed", data_version, "training"))
    return TrainedModel(model, model_path, run_id, bundle)


def newest_model(run_log: runs.RunLog) -> PipelineModel:
    """The model of the run that logged its metrics last."""
    newest = run_log.read("metrics").groupBy("run_id").agg(F.max("ts").alias("ts"))
    saved = run_log.read("tags").where(F.col("key") == "model_path")
    row = saved.join(newest, "run_id").orderBy(F.desc("ts")).select("value").first()
    if row is None:
        raise RuntimeError("no model has been saved")
    return modeling.load_model(row.value)


def score_with_newest(run_log: runs.RunLog, df: DataFrame, threshold: float = V.THRESHOLD) -> DataFrame:
    return modeling.score(newest_model(run_log), df, threshold)


