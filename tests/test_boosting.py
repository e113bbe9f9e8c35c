"""Boosted trees from binned rows against Spark's own, and forests whose tasks stay small."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidecall.operators import boosting, modeling
from tidecall.session import materialize, scratch_path


@pytest.fixture(scope="module")
def encoded(spark):
    x = [(F.xxhash64("id", F.lit(i)) % 1000).cast("double").alias(c) for i, c in enumerate(("a", "b"))]
    df = spark.range(3000).select("id", *x, F.concat(F.lit("v"), F.pmod("id", F.lit(5))).alias("c"))
    df = df.withColumn("Target", ((F.col("a") > 100) & ((F.col("b") < 300) | (F.col("c") == "v3"))).cast("int"))
    stages = modeling.feature_stages(["a", "b"], ["c"])
    return Pipeline(stages=stages).fit(df).transform(df).select("id", "features", "Target")


def _chances(model, df):
    return {r.id: r.p for r in model.transform(df).select("id", vector_to_array("probability")[1].alias("p")).collect()}


@pytest.mark.parametrize("depth", [1, 4])
def test_trees_are_those_of_spark(spark, encoded, depth):
    params = {"labelCol": "Target", "stepSize": 0.1, "maxIter": 6, "maxDepth": depth, "seed": 42}
    own, theirs = boosting.BoostedTrees(**params).fit(encoded), GBTClassifier(**params).fit(encoded)
    path = scratch_path(spark, "boosted")
    own.write().save(path)
    got, want = _chances(GBTClassificationModel.load(path), encoded), _chances(theirs, encoded)
    assert got == pytest.approx(want, abs=1e-9)
    assert own.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)
    assert own.getOrDefault("maxIter") == 6 and own.getNumTrees == 6


def test_one_pass_for_many_fits(spark, encoded, monkeypatch):
    """Trees and held-out scores of several parameter sets at once, also across written margins, in few jobs."""
    monkeypatch.setattr(boosting, "TREES_PER_WRITE", 2)
    monkeypatch.setattr(boosting, "LEAST_PER_TASK", 500)
    plans = [boosting.Plan(0.1, 2, 5), boosting.Plan(0.3, 3, 5)]
    side = F.col("id") % 4 > 0
    tracker, group = spark.sparkContext.statusTracker(), "boosted-jobs"
    spark.sparkContext.setJobGroup(group, group)
    trees, columns, margins = boosting.boost(encoded, "Target", plans, fitted=side, stages=[3, 5])
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # 15 levels of the deeper trees; one fit after another takes 25 of them.
    assert jobs < 15 + 30
    for m, plan in enumerate(plans):
        alone = boosting.BoostedTrees(labelCol="Target", stepSize=plan.rate, maxIter=5, maxDepth=plan.depth)
        fit = alone.fit(encoded.where(side))
        here = boosting.as_model(alone, trees[m], columns)
        assert _chances(here, encoded) == pytest.approx(_chances(fit, encoded), abs=1e-9)
        for n in (3, 5):
            chances = sorted(_chances(modeling.first_trees(fit, n), encoded.where(~side)).values())
            own = sorted(r.p for r in margins[n].select((1 / (1 + F.exp(-2 * F.col(f"m{m}")))).alias("p")).collect())
            assert own == pytest.approx(chances, abs=1e-9)


def _made_up(n, depth):
    """Columns, a block of rows and a tree of ``depth`` levels that are split at random; some nodes stay leaves."""
    draw = np.random.default_rng(7)
    columns = [boosting.Column_((0,), tuple(range(40))), boosting.Column_((1, 2, 3)), boosting.Column_((4,), (0.5,))]
    codes = np.array([draw.integers(0, c.width, n) for c in columns]).astype(np.uint8)
    tree = boosting.Tree(depth)
    for node in range(2**depth - 1):
        if not node or (tree.column[(node - 1) // 2] >= 0 and draw.random() < 0.9):
            tree.column[node] = draw.integers(0, 3)
            tree.cut[node] = draw.integers(0, columns[tree.column[node]].width - 1)
    tree.levels = depth
    return columns, codes, tree


@pytest.mark.parametrize("depth", [0, 3, 7, 9])
def test_rows_find_their_node(depth):
    columns, codes, tree = _made_up(5000, depth)
    levels = np.array([c.borders is None for c in columns])
    node = tree.node_of(codes, levels)
    ends = tree.ends()
    assert set(node) <= set(ends.tolist())
    assert (ends[tree.place_of(ends, codes, levels)] == node).all()
    some = ends[::2]
    place = tree.place_of(some, codes, levels)
    assert ((place < len(some)) == np.isin(node, some)).all()
    assert (some[place[place < len(some)]] == node[place < len(some)]).all()


@pytest.mark.parametrize("entries", [1, 1 << 13])
def test_half_of_the_rows_are_counted(entries, monkeypatch):
    """Counts and sums of all nodes are those of all rows, though at most every other row below the root is looked at."""
    monkeypatch.setattr(boosting, "ENTRIES", entries)
    columns, codes, _ = _made_up(5000, 0)
    widths, levels = [c.width for c in columns], np.array([c.borders is None for c in columns])
    draw = np.random.default_rng(8)
    labels = np.where(codes[0] + 20 * (codes[1] == 2) + draw.normal(0, 9, 5000) > 30, 1, -1).astype(np.int8)
    margins = draw.normal(0, 0.3, (1, 5000))
    target = np.rint(4 * labels / (1 + np.exp(2 * labels * margins[0])) * 2.0**35).astype(np.int64)
    tree, above = boosting.Tree(5), None
    for level in range(5):
        counted = tree.counted()
        counts = boosting._Counts({0: (tree, counted)}, False, 35, widths, levels)
        for at in (slice(0, 3000), slice(3000, None)):
            counts.add((codes[:, at], labels[at], margins[:, at]))
        (found,) = counts.by_column()
        if level:
            assert 2 * found[0, :, : widths[0]].sum() <= tree.count[2 ** (level - 1) - 1 : 2**level - 1].sum()
        above = boosting._of_all_nodes(tree, found, above)
        node, offset = tree.node_of(codes, levels) - (2**level - 1), 0
        for c, width in enumerate(widths):
            want = np.zeros((2, 2**level, width), np.int64)
            here = node >= 0
            np.add.at(want[0], (node[here], codes[c][here]), 1)
            np.add.at(want[1], (node[here], codes[c][here]), target[here])
            assert (above[:, :, offset : offset + width] == want).all()
            offset += width
        boosting._grow(tree, above, columns, 2.0**-35)
    assert (tree.column >= 0).sum() > 10


def test_trees_do_not_depend_on_tasks(spark, encoded, monkeypatch):
    found = []
    for least, parts in ((100_000, 1), (300, 7)):
        monkeypatch.setattr(boosting, "LEAST_PER_TASK", least)
        plans = [boosting.Plan(0.1, 4, 8)]
        ((trees,), _, _) = boosting.boost(encoded.repartition(parts), "Target", plans)
        found.append([(t.column.tolist(), t.cut.tolist(), t.value.tolist()) for t in trees])
    assert found[0] == found[1]


def test_margins_found_anew_are_the_same(spark, encoded, monkeypatch):
    """However often they are found anew from the written rows, and no table of margins is left."""
    found = []
    for every in (2, 50):
        monkeypatch.setattr(boosting, "TREES_PER_WRITE", every)
        written = []
        monkeypatch.setattr(boosting, "materialize", lambda df, label: written.append(label) or materialize(df, label))
        ((trees,), _, _) = boosting.boost(encoded, "Target", [boosting.Plan(0.1, 2, 7)])
        found.append([(t.column.tolist(), t.cut.tolist(), t.value.tolist()) for t in trees])
        assert written == ["blocks"]
    assert found[0] == found[1]


def test_one_label_and_other_labels(spark, encoded):
    ones = encoded.where("Target = 1")
    model = boosting.BoostedTrees(labelCol="Target", maxIter=2, maxDepth=2).fit(ones)
    assert set(model.transform(ones).select("prediction").distinct().collect()) == {(1.0,)}
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        boosting.BoostedTrees(labelCol="Target").fit(encoded.withColumn("Target", F.lit(2)))
    with pytest.raises(ValueError, match="no rows"):
        boosting.BoostedTrees(labelCol="Target").fit(encoded.where("id < 0"))


def test_forest_is_trained_on_bounded_parts(spark, encoded, monkeypatch):
    parts = []
    fit = modeling.RandomForestClassifier._fit
    monkeypatch.setattr(modeling, "FOREST_ROWS_PER_TASK", 200)
    monkeypatch.setattr(
        modeling.RandomForestClassifier, "_fit", lambda self, df: parts.append(df.rdd.getNumPartitions()) or fit(self, df)
    )
    model = modeling.random_forest("Target", n_estimators=3).fit(encoded.coalesce(1))
    assert parts == [15] and len(model.trees) == 3
