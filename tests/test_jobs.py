"""The three jobs end to end, and the streaming variant of the first."""

import uuid

import pytest
from conftest import rows
from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from tidecall import fixed_values as V
from tidecall.operators import cleaning, evaluation, features, modeling, runs
from tidecall.plans import jobs
from tidecall.plans.contacts import contact_table
from tidecall.schema import CONTACT_KEY, contact_schema
from tidecall.session import materialize, scratch_path
from tidecall.sources import scans
from tidecall.sources.paths import DatasetPaths
from tidecall.sources.tables import TableStore
from tidecall.streaming import incremental

TEXT = ("duration",)


@pytest.fixture(scope="module")
def csv(spark, medium):
    path = scratch_path(spark, "contacts")
    scans.write_csv(contact_table(spark, medium), path)
    return path


@pytest.fixture(scope="module")
def stores(spark):
    name = f"jobs_{uuid.uuid4().hex[:8]}"
    tables = TableStore(spark, name, scratch_path(spark, "schema"))
    return tables, DatasetPaths(scratch_path(spark, "volume"))


@pytest.fixture(scope="module")
def prepared(spark, csv, stores):
    tables, paths = stores
    schema = contact_schema(CONTACT_KEY, TEXT)
    return jobs.prepare_and_save(lambda: scans.read_csv(spark, csv, schema), [CONTACT_KEY], paths, tables)


def test_absent_source(spark):
    assert jobs.prepare_and_save(lambda: spark.read.parquet("/no/such"), ["id"]) is None


def test_prepare_writes_four_copies(spark, prepared, stores):
    tables, paths = stores
    assert tables.list() == ["test_processed", "test_raw", "train_processed", "train_raw"]
    for subset, n in (("train", 12000), ("test", 3000)):
        processed = scans.read_path(spark, paths.path("processed", subset))
        raw = scans.read_path(spark, paths.path("raw", subset))
        assert processed.count() == raw.count() == tables.load(f"{subset}_raw").count() == n
        assert dict(processed.dtypes)["Target"] == "int" and dict(raw.dtypes)["Target"] == "string"
        assert processed.columns == [CONTACT_KEY, *V.CATEGORICAL_COLUMNS, *V.NUMERIC_COLUMNS, "Target", V.LOAD_TIME_COLUMN]
        wrong = processed.join(raw.select(CONTACT_KEY, F.col("Target").alias("t")), CONTACT_KEY)
        assert wrong.where("(Target = 1) <> (t = 'yes')").count() == 0


def test_failing_tables_are_tolerated_after_paths(spark, csv):
    class Broken(TableStore):
        def ensure_schema(self):
            raise OSError("no catalog")

    read = lambda: scans.read_csv(spark, csv, contact_schema(CONTACT_KEY, TEXT))
    paths = DatasetPaths(scratch_path(spark, "volume"))
    broken = Broken(spark, "x")
    assert jobs.prepare_and_save(read, [CONTACT_KEY], paths, broken, tables_required=False) is not None
    with pytest.raises(OSError):
        jobs.prepare_and_save(read, [CONTACT_KEY], paths, broken)


def test_load_falls_back_to_paths(spark, prepared, stores):
    tables, paths = stores
    train, test, version = jobs.load_split(spark, tables, paths)
    assert version == "1" and train.count() == 12000
    empty = TableStore(spark, tables.schema + "_none")
    train, test, version = jobs.load_split(spark, empty, paths)
    assert version == "0" and test.count() == 3000
    with pytest.raises(RuntimeError):
        jobs.load_split(spark, empty, DatasetPaths("/no/such"))


@pytest.fixture(scope="module")
def trained(spark, prepared, stores):
    train, test, version = jobs.load_split(spark, *stores)
    log = runs.RunLog(spark, scratch_path(spark, "runs"))
    classifier = modeling.boosted_trees(n_estimators=5, learning_rate=0.1)
    done = jobs.train_and_log(
        train, test, log, "run-1", scratch_path(spark, "model"), classifier, data_version=version
    )
    return done, log, test


def test_training_is_better_than_chance_and_logged(spark, trained):
    done, log, _ = trained
    measured = dict(rows(log.read("metrics").select("key", "value")))
    assert set(measured) == {"accuracy", "precision", "recall", "f1", "roc_auc"}
    assert measured["roc_auc"] > 0.8
    assert all(0 <= v <= 1 for v in measured.values())
    params = dict(rows(log.read("params").select("key", "value")))
    assert params["maxIter"] == "5" and params["stepSize"] == "0.1"
    record = log.read("inputs").first()
    assert record.version == "1" and record.context == "training" and int(record.digest) > 0


def test_scoring_with_the_saved_model(spark, trained):
    done, log, test = trained
    scored = jobs.score_with_newest(log, test)
    assert scored.count() == test.count()
    assert scored.where("probability < 0 or probability > 1").count() == 0
    assert scored.where("(probability >= 0.5) <> (prediction = 1)").count() == 0
    one = jobs.score_with_newest(log, test.limit(1))
    assert one.count() == 1


def test_wrapped_predictions_flip_only_zeros(spark, trained):
    done, _, test = trained
    plain = modeling.score(done.model, test).select(CONTACT_KEY, F.col("prediction").alias("plain"))
    adjusted, summary = modeling.wrapped_predict(done.model, test, CONTACT_KEY)
    both = adjusted.join(plain, CONTACT_KEY)
    zeros = both.where("plain = 0").count()
    flipped = both.where("plain = 0 and prediction = 1").count()
    assert both.where("plain = 1 and prediction = 0").count() == 0
    assert abs(flipped / zeros - 0.05) < 0.02
    row = summary.first()
    assert row["count"] == 3000 and row.positive_rate == pytest.approx(row.positive_count / 3000)


def test_feature_tables_and_training_set(spark, csv, stores):
    tables, _ = stores
    tables.ensure_schema()
    raw = scans.read_csv(spark, csv, contact_schema(CONTACT_KEY, TEXT))
    lookups = jobs.publish_feature_tables(raw, tables)
    training = jobs.build_training_set(raw, lookups, (CONTACT_KEY,))
    assert training.count() == 15000
    assert training.where("job_category is null or month_sin is null").count() == 0
    scoring = jobs.build_scoring_set(raw, lookups, (CONTACT_KEY,))
    assert "Target" not in scoring.columns and scoring.count() == 15000
    for name, key in (("customer_features", "customer_id"), ("campaign_features", "campaign_id")):
        assert key in tables.load(name).columns


def test_forest_importance(spark, prepared):
    train = prepared.where("split = 'train'").drop("split")
    pipeline = modeling.classifier_pipeline(modeling.random_forest(n_estimators=5))
    importance = modeling.feature_importance(pipeline.fit(train), train)
    assert sum(r.importance for r in importance.collect()) == pytest.approx(1.0)
    names = {r.feature for r in importance.collect()}
    assert set(V.NUMERIC_COLUMNS) <= names and "marital_single" in names
    top = modeling.top_importances(importance, 3).collect()
    assert {"duration", "campaign"} <= {r.feature for r in top}
    summary = modeling.importance_summary(importance).first()
    assert summary.engineered_in_top == 0 and summary.mean_importance == pytest.approx(1 / len(names))


def test_model_without_probabilities_keeps_its_prediction(spark, prepared):
    train = prepared.where("split = 'train'").drop("split")
    model = modeling.classifier_pipeline(LinearSVC(labelCol="Target", maxIter=2), ["duration", "campaign"], []).fit(train)
    scored = modeling.score(model, train)
    assert "probability" not in scored.columns and scored.count() == train.count()


def test_grid_search_scores(spark, prepared):
    train = materialize(prepared.where("split = 'train'").drop("split"))
    grid = {"learning_rate": [0.1], "max_depth": [2, 3], "n_estimators": [2]}
    scores, best = modeling.grid_search(train, grid)
    got = scores.collect()
    assert [(r.max_depth, r.n_estimators) for r in got] == [(2, 2), (3, 2)]
    assert all(0.5 < r.score <= 1 for r in got)
    assert best.getOrDefault("maxDepth") in (2, 3)


def test_staged_scores_are_those_of_shorter_fits(spark, prepared):
    """The first trees of a long fit are the short fit."""
    train = materialize(prepared.where("split = 'train'").drop("split"))
    staged, _ = modeling.grid_search(train, {"learning_rate": [0.1], "max_depth": [2], "n_estimators": [2, 6]})
    alone, best = modeling.grid_search(train, {"learning_rate": [0.1], "max_depth": [2], "n_estimators": [2]})
    assert {r.n_estimators: r.score for r in staged.collect()}[2] == pytest.approx(alone.first().score, abs=1e-12)
    assert modeling.first_trees(best, 1).getNumTrees == 1 and best.getNumTrees == 2


def test_standardize_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    assert sorted(rows(modeling.standardize(df, ["x", "c"]))) == [(-1.0, 0.0), (1.0, 0.0)]


def test_one_hot_unknown_level(spark):
    fit = spark.createDataFrame([("a",), ("b",)], "s string")
    df = spark.createDataFrame([("b",), ("z",)], "s string")
    assert sorted(rows(modeling.one_hot(df, ["s"], fit_on=fit))) == [("b", 0, 1), ("z", 0, 0)]


def test_one_hot_with_many_levels(spark):
    df = spark.range(2000).selectExpr("id", "concat('v', id % 1500) as a", "if(id % 5 = 0, null, id % 2) as b")
    with pytest.raises(ValueError, match="one_hot_sparse"):
        modeling.one_hot(df, ["a", "b"])
    got = {r.id: (r.slots, r["size"]) for r in modeling.one_hot_sparse(df, ["a", "b"], "id").collect()}
    names = sorted({f"v{i % 1500}" for i in range(2000)})
    want = {i: ([names.index(f"v{i % 1500}")] + ([] if i % 5 == 0 else [1500 + i % 2]), 1502) for i in range(2000)}
    assert got == want


def test_stream_equals_batch(spark, csv):
    schema = contact_schema(CONTACT_KEY, TEXT)
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        stream = incremental.cleaned_features(incremental.read_new_files(spark, csv, schema, 3), (CONTACT_KEY,))
        incremental.append_available(stream, out, checkpoint).awaitTermination()
    batch = features.engineer_features(cleaning.clean(scans.read_csv(spark, csv, schema), keep=(CONTACT_KEY,)))
    got = spark.read.parquet(out)
    assert got.count() == batch.count() == 15000
    assert got.exceptAll(batch.select(*got.columns)).count() == 0


def test_metric_bundle_of_known_scores(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (1, 1, 0.9)], "label int, prediction int, score double")
    assert set(evaluation.metric_bundle(df).first()) == {1.0}
