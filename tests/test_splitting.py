import math

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidecall.operators import splitting


def sides(df):
    return {(r[0]): r[1] for r in rows(df.groupBy("split").count())}


@pytest.mark.parametrize("n", [1, 4, 5, 6, 10, 999])
def test_exact_sizes(spark, n):
    split = splitting.split_exact(spark.range(n), "id")
    got = sides(split)
    assert got["test"] == math.ceil(0.2 * n)
    assert got.get("train", 0) == n - math.ceil(0.2 * n)


def test_split_of_nothing(spark):
    assert splitting.split_exact(spark.range(0), "id").count() == 0
    empty = spark.createDataFrame([], "id long, y string")
    assert splitting.split_exact(empty, "id", strata=["y"]).count() == 0


def test_recorded_sizes(spark):
    """45,211 rows split into 36,168 and 9,043."""
    assert sides(splitting.split_exact(spark.range(45211), "id")) == {"train": 36168, "test": 9043}


def test_same_rows_whatever_the_layout(spark):
    a = splitting.split_exact(spark.range(1000).repartition(1), "id")
    b = splitting.split_exact(spark.range(1000).repartition(13, F.rand(3)), "id")
    assert sorted(rows(a)) == sorted(rows(b))
    other = splitting.split_exact(spark.range(1000), "id", seed=7)
    assert sorted(rows(a)) != sorted(rows(other))


def test_disjoint_and_complete(spark):
    df = spark.range(500)
    split = splitting.split_exact(df, "id")
    test = split.where("split = 'test'").drop("split")
    rest = splitting.complement(df, test, "id")
    assert sorted(rows(rest)) == sorted(rows(split.where("split = 'train'").drop("split")))
    assert test.count() + rest.count() == 500


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.lists(st.integers(1, 60), min_size=1, max_size=4), fraction=st.sampled_from([0.1, 0.2, 0.5]))
def test_stratified_sizes(spark, sizes, fraction):
    data = [(i * 100 + j, f"s{i}") for i, n in enumerate(sizes) for j in range(n)]
    df = spark.createDataFrame(data, "id long, y string")
    split = splitting.split_exact(df, "id", fraction, strata=["y"])
    test = {r[0]: r[1] for r in rows(split.where("split = 'test'").groupBy("y").count())}
    total = math.ceil(fraction * len(data))
    assert sum(test.values()) == total
    for i, n in enumerate(sizes):
        assert abs(test.get(f"s{i}", 0) - total * n / len(data)) < 1


def test_null_stratum(spark):
    df = spark.range(100).withColumn("y", F.when(F.col("id") % 2 == 0, "a"))
    split = splitting.split_exact(df, "id", strata=["y"])
    assert split.count() == 100
    assert {r[0]: r[1] for r in rows(split.where("split = 'test'").groupBy("y").count())} == {"a": 10, None: 10}


def test_one_hot_stratum_is_not_ranked_as_a_whole(spark):
    split = splitting.split_exact(spark.range(1000).withColumn("y", F.lit("a")), "id", strata=["y"])
    plan = split._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "row_number" in line and "Window" in line]
    assert all("__b" in line or "__total" in line or "__place" in line for line in windows)


def test_threshold_share(spark):
    split = splitting.split_threshold(spark.range(20000), "id")
    assert abs(sides(split)["test"] / 20000 - 0.2) < 0.01
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("n, want", [(50, 5), (5000, 500), (20000, 1000)])
def test_sample_rows(spark, n, want):
    sample = splitting.sample_rows(spark.range(n), "id")
    assert sample.count() == want
    assert sample.distinct().count() == want


@pytest.mark.parametrize("key", ["k", None])
def test_exact_sizes_with_repeated_keys_and_without_a_key(spark, key):
    df = spark.range(1000).selectExpr("id % 7 as k", "id % 3 as v")
    found = [
        sorted(rows(splitting.split_exact(df.repartition(n), key, 0.2).where("split = 'test'"))) for n in (2, 5)
    ]
    assert len(found[0]) == 200 and found[0] == found[1]
    by_v = splitting.split_exact(df, key, 0.2, strata=["v"]).where("split = 'test'").groupBy("v").count()
    assert sorted(rows(by_v)) == [(0, 67), (1, 67), (2, 66)] or sum(r[1] for r in rows(by_v)) == 200


def task_rows(spark, action):
    """Most rows that a task of each stage read from a shuffle, by the status store, and what ``action`` gave."""
    store = spark.sparkContext._jsc.sc().statusStore()
    before = {s.stageId() for s in stages(store)}
    out = action()
    most = []
    for s in stages(store):
        if s.stageId() not in before:
            tasks = store.taskList(s.stageId(), s.attemptId(), 10000)
            read = [m.get().shuffleReadMetrics().recordsRead() for t in range(tasks.size()) if (m := tasks.apply(t).taskMetrics()).isDefined()]
            most.append(max(read, default=0))
    return most, out


def stages(store):
    found = store.stageList(None, False, False, spark_doubles(), None)
    return [found.apply(i) for i in range(found.size())]


def spark_doubles():
    from pyspark import SparkContext

    return SparkContext._active_spark_context._gateway.new_array(SparkContext._active_spark_context._jvm.double, 0)


@pytest.mark.parametrize("values", [1, 20_000])
def test_a_hot_key_at_the_border_is_not_one_task(spark, monkeypatch, values):
    """A key with a third of all rows: no task gets them, be they alike or all different.

    With 256 buckets, so that their counts are few beside the rows.
    """
    monkeypatch.setattr(splitting, "_BELOW_BUCKET", 52)
    n = 30_000
    df = spark.range(0, n, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("k"), (F.col("id") % values).alias("v")
    )
    # The fraction at which the hot key is the border, half of it inside.
    order = df.select("k").distinct().select("k", splitting.C.hash_order("k").alias("h"))
    mark = order.where("k = 7").first()["h"]
    lower = df.join(order.where(F.col("h") < mark), "k", "left_semi").count()
    fraction = (lower + n / 6) / n
    tested = F.col("split") == "test"
    both = [F.count_if(tested), F.count_if(tested & (F.col("k") == 7))]
    most, got = task_rows(spark, lambda: splitting.split_exact(df, "k", fraction).agg(*both).first())
    assert tuple(got) == (math.ceil(fraction * n), math.ceil(fraction * n) - lower)
    assert max(most) < n / 6


def test_the_input_is_read_once(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 7 as k", "id % 3 as v")
    path = str(tmp_path / "input")
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    split = splitting.split_exact(stored, "k", 0.2)
    assert path not in split._jdf.queryExecution().executedPlan().toString()
    assert split.where("split = 'test'").count() == 200


def test_sample_of_repeated_rows(spark):
    df = spark.range(3000).selectExpr("id % 2 as k", "id % 4 as v")
    for n in (2, 5):
        sample = splitting.sample_rows(df.repartition(n), "k", rows=400, fraction=0.5)
        assert sample.count() == 400 and sample.select("k").distinct().count() == 1
