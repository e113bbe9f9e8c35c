import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidecall import fixed_values as V
from tidecall.operators import runs
from tidecall.session import scratch_path


@pytest.fixture
def log(spark):
    made = runs.RunLog(spark, scratch_path(spark, "runs"))
    made.start("p", "demo-search", 1000)
    made.start("a", "demo-a", 2000, parent="p")
    made.start("b", "other-b", 3000, parent="p")
    made.start("c", "demo-c", 4000, parent="p", status="FAILED")
    made.log_params("a", {"depth": 3})
    made.log_tags("a", {"branch": "main"})
    for step, loss in enumerate([0.9, 0.5, 0.7]):
        made.log_metrics("a", {"loss": loss}, step)
    made.log_metrics("b", {"loss": 0.2, "auc": 0.8})
    return made


def test_empty_log(spark):
    assert runs.RunLog(spark, scratch_path(spark, "runs")).read("metrics").count() == 0


def test_last_value_and_maps(log):
    values = runs.last_values(log.read("metrics"))
    assert {r.run_id: r.metrics for r in runs.value_maps(values).collect()} == {
        "a": {"loss": 0.7}, "b": {"loss": 0.2, "auc": 0.8}
    }


def test_search(log):
    values = runs.last_values(log.read("metrics"))
    found = runs.search_runs(
        log.read("runs"), values, log.read("params"), after_ms=500, name_like="%demo%",
        metric_keys=("loss", "absent"), param_keys=("depth",),
    )
    assert "metrics_absent" not in found.columns
    assert [(r.run_id, r.metrics_loss, r.params_depth) for r in found.collect()] == [("a", 0.7, "3"), ("p", None, None)]
    none = runs.search_runs(log.read("runs"), values, after_ms=5000)
    assert none.count() == 0


def test_top_and_latest(log):
    wide = runs.spread(runs.last_values(log.read("metrics")), ["auc", "loss"])
    assert [r.run_id for r in runs.largest(wide, "auc", 2).collect()] == ["b", "a"]
    assert runs.latest(log.read("runs")).first().run_id == "c"


def test_versions_compare_as_numbers(spark):
    df = spark.createDataFrame([("9",), ("10",), ("2",)], "version string")
    assert rows(runs.newest_version(df)) == [(10,)]


def test_steps(log):
    series = runs.step_series(log.read("metrics").drop("step"), F.to_date("ts"), ["ts"]).where("run_id = 'a'")
    got = [(r.step, r.value, r.delta) for r in series.orderBy("step").collect()]
    assert [g[:2] for g in got] == [(0, 0.9), (1, 0.5), (2, 0.7)]
    assert got[0][2] is None and got[1][2] == pytest.approx(-0.4)


def test_grid():
    grid = runs.parameter_grid()
    assert len(grid) == 18 and grid[0] == {"learning_rate": 0.01, "max_depth": 3, "n_estimators": 50}
    assert grid[1]["n_estimators"] == 100 and len({tuple(g.values()) for g in grid}) == 18


def test_best_child_takes_the_earliest_of_equals(spark):
    parents = spark.createDataFrame([("p",), ("q",)], "run_id string")
    grid = [{"depth": d} for d in (3, 5, 7)]
    scores = [F.lit(0.5), F.lit(0.9), F.lit(0.9)]
    children = runs.child_runs(parents.where("run_id = 'p'"), grid, scores)
    assert children.count() == 3
    assert sorted(rows(runs.best_child(parents, children, ["depth"]))) == [("p", 0.9, 5), ("q", None, None)]


def test_digest_ignores_order_but_not_content(spark):
    df = spark.range(100).selectExpr("id", "id * 2 as v")
    same = df.repartition(7).orderBy(F.desc("id")).select("v", "id")
    assert rows(runs.content_digest(df)) == rows(runs.content_digest(same))
    assert rows(runs.content_digest(df)) != rows(runs.content_digest(df.where("id > 0")))
    assert rows(runs.content_digest(df.limit(0))) == [("0",)]


def test_input_record(spark, log):
    asked = spark.createDataFrame([("a",), ("b",)], "run_id string")
    log.append("inputs", runs.input_record(spark.range(3), "a", "train", "4", "training"))
    got = {r.run_id: r for r in runs.read_input(log.read("inputs"), asked).collect()}
    assert got["a"].version == "4" and got["a"].error is None and got["a"].source_uri == "train"
    assert got["b"].error == V.NO_INPUT and got["b"].source_uri == "Unknown URI"


def test_defaults():
    assert (V.LEARNING_RATE, V.N_ESTIMATORS, V.MAX_DEPTH, V.SEED) == (0.05, 200, 4, 42)
