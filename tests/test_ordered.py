"""Chunked ordered computations against plain windows and numpy, on skewed and odd inputs."""

import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidecall.functions.ordered import exact_quantiles, number_rows, with_history
from tidecall.operators import evaluation


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows; some keys are null; days repeat."""
    n = 3000
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 40).alias("k"),
        F.timestamp_seconds(F.col("id") * 7919 % 500000).alias("ts"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") * 1.5).alias("v"),
    )


def test_history_equals_plain_window(spark, skewed):
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = skewed.select("id", F.row_number().over(w).alias("n"), F.lag("v").over(w).alias("p"), F.lag("ts").over(w).alias("t"))
    got = with_history(skewed, ["k"], F.to_date("ts"), ["ts", "id"], {"p": "v", "t": "ts"}, "n")
    assert got.columns == ["id", "k", "ts", "v", "n", "p", "t"]
    assert sorted(rows(got.select("id", "n", "p", "t")), key=repr) == sorted(rows(want), key=repr)


def test_history_never_partitions_rows_by_the_key_alone(spark, skewed):
    got = with_history(skewed, ["k"], F.to_date("ts"), ["ts", "id"], {"p": "v"}, "n")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("rows_per_chunk", [1, 20, 400])
def test_over_full_chunks_are_cut_further(spark, rows_per_chunk):
    """Series of one day, of one minute and of one instant are spread; the result is that of one window."""
    from tidecall.operators.runs import step_series, time_chunks

    df = spark.range(3000).select(
        (F.col("id") * 7919 % 3000 * 1000).alias("id"),
        F.when(F.col("id") % 3 == 0, "day").when(F.col("id") % 3 == 1, "minute").otherwise("instant").alias("run_id"),
        F.lit("k").alias("key"),
        F.timestamp_micros(
            F.when(F.col("id") % 3 == 0, F.col("id") * 20_000_000).when(F.col("id") % 3 == 1, F.col("id") * 9000).otherwise(5)
        ).alias("ts"),
        F.col("id").cast("double").alias("value"),
    )
    got = step_series(df, time_chunks(df, "ts", "id"), ["ts", "id"], rows_per_chunk)
    w = Window.partitionBy("run_id").orderBy("ts", "id")
    want = df.withColumns({"step": F.row_number().over(w) - 1, "delta": F.col("value") - F.lag("value").over(w)})
    assert sorted(rows(got), key=repr) == sorted(rows(want.withColumn("step", F.col("step").cast("long"))), key=repr)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    cut = max(int(c) for c in "0123456" if f"__chunk{c}" in plan)
    assert cut == 5


def test_chunks_of_times_with_and_without_zone(spark):
    from tidecall.operators.runs import time_chunks

    df = spark.sql("SELECT timestamp_micros(1700000000123456) AS z, CAST(timestamp_micros(1700000000123456) AS timestamp_ntz) AS n")
    assert len({tuple(df.select(*time_chunks(df, c)).first()) for c in ("z", "n")}) == 1


def test_number_rows(spark, skewed):
    got = number_rows(skewed.select("id", "k"), ["k", "id"], "n")
    want = skewed.select("id", F.row_number().over(Window.orderBy("k", "id")).alias("n"))
    assert sorted(rows(got.select("id", "n"))) == sorted(rows(want))


@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [1.0, 2.0],
        [3.0] * 1000,
        [float(i) for i in range(1001)],
        [1.0] * 700 + [float(i) for i in range(301)],
        [10.0**i for i in range(-20, 20)],
        [-1.0, None, 2.0, float("nan"), 7.0],
    ],
    ids=["one", "two", "same", "line", "hot", "wide", "gaps"],
)
@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_exact_quantiles(spark, values, accuracy):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    points = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    found = exact_quantiles(df, ["x"], points, accuracy=accuracy, rows_per_range=10)
    got = {r.probability: r.value for r in found.collect()}
    kept = [v for v in values if v is not None and not math.isnan(v)]
    for p in points:
        assert got[p] == pytest.approx(np.quantile(kept, p), rel=1e-12)


def test_only_values_between_the_bounds_are_written(spark, monkeypatch):
    """Of 20,000 rows, half of them equal, few reach the second step."""
    from tidecall.functions import ordered

    written = {}
    plain = ordered.materialize
    monkeypatch.setattr(ordered, "materialize", lambda df, label="step": written.setdefault(label, plain(df, label)))
    df = spark.range(20000).select(F.when(F.col("id") % 2 == 0, 5.0).otherwise(F.sin("id") * 100).alias("x"), (F.col("id") * 7 % 1000).alias("y"))
    got = {(r["column"], r.probability): r.value for r in exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.9], accuracy=1000).collect()}
    table = df.toPandas()
    assert all(v == pytest.approx(np.quantile(table[c], p), rel=1e-12) for (c, p), v in got.items()) and len(got) == 6
    assert written["between"].count() < 6 * 20000 * 4 / 1000 + 1


def test_exact_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]).count() == 0


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return won / (len(pos) * len(neg))


@pytest.mark.parametrize("rows_per_range", [20, 200_000])
@pytest.mark.parametrize("seed, digits", [(1, 1), (2, 2), (3, 9)])
def test_auc_equals_pairwise_count(spark, seed, digits, rows_per_range):
    rng = np.random.default_rng(seed)
    scores = np.round(rng.random(400) ** 8, digits)
    labels = (rng.random(400) < 0.2 + 0.6 * scores).astype(int)
    pairs = list(zip(scores.tolist(), labels.tolist()))
    df = spark.createDataFrame(pairs, "score double, label int").repartition(5)
    assert evaluation.roc_auc(df, rows_per_range=rows_per_range).first()[0] == pytest.approx(brute_auc(pairs), abs=1e-12)


@pytest.mark.parametrize("rows", [3000, 12000])
def test_ranges_follow_the_number_of_rows(spark, monkeypatch, rows):
    """At four times the rows a task orders no more of them, also where a value holds a third of all."""
    from tidecall.functions import ordered

    written = {}
    plain = ordered.materialize
    monkeypatch.setattr(ordered, "materialize", lambda df, label="step": written.setdefault(label, plain(df, label)))
    df = spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(3)).alias("score"), (F.col("id") % 5 == 0).cast("int").alias("label")
    )
    evaluation.roc_auc(df, rows_per_range=500).collect()
    sizes = [r["count"] for r in written["ranged"].groupBy(F.shiftrightunsigned("__at", 33)).count().collect()]
    assert len(sizes) == -(-(2 * rows // 3 + 1) // 500) and max(sizes) < 1000


def test_number_rows_needs_one_shuffle(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("id"), F.lit(1).alias("v"))
    got = number_rows(df, ["id"], "n", rows_per_range=300)
    assert sorted(rows(got.select("id", "n"))) == [(i, i + 1) for i in range(5000)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan


def test_auc_equals_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(20000).select(
        F.rand(5).alias("score"), (F.rand(6) + F.rand(5) > 1).cast("int").alias("label")
    )
    path_df = spark.createDataFrame(df.toPandas())
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert evaluation.roc_auc(path_df).first()[0] == pytest.approx(evaluator.evaluate(path_df), abs=1e-9)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.2, 1), (0.4, 1)], "score double, label int")
    assert evaluation.roc_auc(df).first()[0] is None
