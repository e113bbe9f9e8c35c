import math

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidecall.operators import evaluation, profiling


@pytest.fixture(scope="module")
def sample(spark):
    data = [
        (1, 1.0, 2.0, "a", None, 5.0, None),
        (2, 2.0, 4.1, "b", None, 5.0, 1.0),
        (3, float("nan"), 6.2, "a", None, 5.0, 3.0),
        (4, float("inf"), 8.0, None, None, 5.0, 2.0),
        (5, 5.0, None, "a", None, 5.0, 7.0),
    ]
    return spark.createDataFrame(data, "i int, x double, y double, s string, e string, c double, p double")


def test_missing_counts_nan(sample):
    assert dict(rows(profiling.null_counts(sample))) == {"x": 1, "y": 1, "s": 1, "e": 5, "p": 1}


def test_infinite(sample):
    assert dict(rows(profiling.infinite_counts(sample))) == {"x": 1}


def test_constant(sample):
    assert {r[0] for r in rows(profiling.constant_columns(sample))} == {"e", "c"}


def test_correlation_like_pandas(spark, sample):
    cols = ["i", "y", "p", "c"]
    frame = sample.select(*cols).toPandas().astype(float)
    want = frame.corr().abs()
    got = {(a, b): v for a, b, v in rows(profiling.correlation_pairs(sample, cols))}
    assert len(got) == 6
    for (a, b), v in got.items():
        if math.isnan(want.loc[a, b]):
            assert v is None
        else:
            assert v == pytest.approx(want.loc[a, b], abs=1e-12)


def test_correlation_leaves_out_rows_that_are_not_finite(spark, sample):
    """Like pandas, a pair counts the rows where both values are finite."""
    got = {(a, b): v for a, b, v in rows(profiling.correlation_pairs(sample, ["i", "x", "y"]))}
    assert got["i", "x"] == pytest.approx(np.corrcoef([1, 2, 5], [1, 2, 5])[0, 1])
    assert got["x", "y"] == pytest.approx(1.0)


def test_correlation_of_constants_and_copies(spark):
    """Constants are null whatever their rounding, and nothing exceeds 1."""
    df = spark.range(1000).selectExpr("id * 0.1d as a", "id * 0.7d as b", "0.1d as c", "1e9 + id % 2 as d", "id % 2 as e")
    got = {(a, b): v for a, b, v in rows(profiling.correlation_pairs(df))}
    assert got["a", "c"] is None and got["c", "d"] is None
    assert got["d", "e"] == pytest.approx(1.0) and max(v for v in got.values() if v is not None) <= 1.0
    few = {(a, b): v for a, b, v in rows(profiling.correlation_pairs(df, ["a", "e"]))}
    assert few["a", "e"] == pytest.approx(got["a", "e"], rel=1e-12)


def test_describe_like_pandas(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"a": rng.normal(size=501), "b": rng.integers(0, 5, 501).astype(float)})
    got = {r["column"]: r for r in profiling.describe(spark.createDataFrame(frame)).collect()}
    want = frame.describe()
    for c in frame.columns:
        for mine, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")]:
            assert got[c][mine] == pytest.approx(want.loc[theirs, c], rel=1e-9)


def test_describe_sketch(spark):
    df = spark.range(1, 1001).selectExpr("cast(id as double) x")
    row = profiling.describe(df, exact=False).first()
    assert (row["q25"], row["q50"], row["q75"]) == (250.0, 500.0, 750.0)


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 9.0, 11.0], [4.0, 4.0], [0.0, 1.0] * 30 + [0.05 * i for i in range(21)]])
def test_histogram_like_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    got = sorted(rows(profiling.histogram(df, "x", bins=4)))
    counts, edges = np.histogram(values, bins=4)
    assert [r[3] for r in got] == counts.tolist()
    assert [r[1] for r in got] == pytest.approx(edges[:-1].tolist())
    assert [r[2] for r in got] == pytest.approx(edges[1:].tolist())


def test_histogram_ranges_are_per_class(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 1.0), (1, 10.0), (1, 20.0)], "y int, x double")
    got = {(r[0], r[1]): (r[2], r[3], r[4]) for r in rows(profiling.histogram(df, "x", bins=2, by="y"))}
    assert got == {(0, 0): (0.0, 0.5, 1), (0, 1): (0.5, 1.0, 1), (1, 0): (10.0, 15.0, 1), (1, 1): (15.0, 20.0, 1)}


def test_histogram_of_nothing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert profiling.histogram(df, "x").count() == 0


def test_small_groups_are_left_out(spark):
    df = spark.createDataFrame([("a", "yes")] * 10 + [("b", "no")] * 9, "g string, Target string")
    assert rows(profiling.target_rate_by(df, "g")) == [("a", 1.0, 10)]


def test_quality_score(spark, sample):
    checks = profiling.quality_checks(profiling.validation_report(sample))
    found = {r["check"]: r["passed"] for r in checks.collect()}
    assert found == {"missing_values": False, "infinite_values": False, "constant_features": False, "high_correlations": False}
    good = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "x int, s string")
    assert rows(profiling.quality_score(profiling.quality_checks(profiling.validation_report(good)))) == [(1.0,)]


# --- metrics -----------------------------------------------------------------------------

KNOWN = [(1, 1, 0.8), (0, 0, 0.3), (1, 0, 0.4), (0, 0, 0.1), (1, 1, 0.7), (0, 0, 0.2)]


def test_known_metrics(spark):
    df = spark.createDataFrame(KNOWN, "label int, prediction int, score double")
    got = evaluation.metric_bundle(df).first().asDict()
    assert got == pytest.approx(
        {"accuracy": 5 / 6, "precision": 1.0, "recall": 2 / 3, "f1": 0.8, "roc_auc": 1.0}
    )
    assert rows(evaluation.confusion(df)) == [(3, 0, 1, 2)]
    assert evaluation.roc_auc_hard(df).first()[0] == pytest.approx((2 / 3 + 1) / 2)


def test_perfect_predictions(spark):
    df = spark.createDataFrame([(y, y, float(y)) for y in (0, 1, 0, 1, 0)], "label int, prediction int, score double")
    assert set(evaluation.metric_bundle(df).first().asDict().values()) == {1.0}


def test_no_positive_predictions_give_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    assert rows(evaluation.metrics(df)) == [(0.5, 0.0, 0.0, 0.0)]


def test_empty_input_has_no_metrics(spark):
    df = spark.createDataFrame([], "label int, prediction int, score double")
    assert evaluation.metric_bundle(df).count() == 0


def test_class_report(spark):
    df = spark.createDataFrame(KNOWN, "label int, prediction int, score double")
    got = {r["class"]: r for r in evaluation.class_report(df).collect()}
    assert got["0"]["precision"] == pytest.approx(0.75) and got["0"]["recall"] == 1.0 and got["0"]["support"] == 3
    assert got["1"]["precision"] == 1.0 and got["1"]["f1"] == pytest.approx(0.8)
    assert got["macro avg"]["precision"] == pytest.approx(0.875)
    assert got["weighted avg"]["recall"] == pytest.approx(5 / 6)
    assert got["accuracy"]["f1"] == pytest.approx(5 / 6) and got["accuracy"]["support"] == 6


def test_prediction_summary(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (1,)], "prediction int")
    assert rows(evaluation.prediction_summary(df)) == [(4, 2, 0.5, 0.5, 0.5)]
    one = spark.createDataFrame([(1,)], "prediction int")
    assert rows(evaluation.prediction_summary(one)) == [(1, 1, 1.0, None, 0.5)]


@pytest.mark.parametrize("values", [[0.1 * i for i in range(31)], [0.0, 0.7, 0.1, 0.3, 1e-300], [1e300, -1e300, 3.0], [2.0] * 5])
def test_histogram_places_values_by_its_own_edges(spark, values):
    """A value on a printed edge counts above it, the largest one in the last bin."""
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = sorted(profiling.histogram(df, "x", 10).collect(), key=lambda r: r.bin)
    assert [r.bin for r in found] == list(range(10)) and all(a.upper == b.lower for a, b in zip(found, found[1:]))
    for r in found:
        last = r.bin == 9
        assert r.n == sum(r.lower <= v < r.upper or (last and v == r.upper) for v in values)
    assert sum(r.n for r in found) == len(values)


@pytest.mark.parametrize("max_columns", [2, 4, 5, 6, 7])
def test_blocks_of_columns_give_every_pair_once(spark, max_columns):
    names = [f"c{i}" for i in range(7)]
    df = spark.range(200).select(*[(F.sin(F.col("id") * (i + 1)) + F.col("id") * i / 300).alias(n) for i, n in enumerate(names)])
    whole = sorted(rows(profiling.correlation_pairs(df)))
    got = sorted(rows(profiling.correlation_pairs(df, max_columns=max_columns)))
    assert [r[:2] for r in got] == [r[:2] for r in whole] and len(got) == 21
    assert all(a[2] == pytest.approx(b[2], abs=1e-9) for a, b in zip(got, whole))
