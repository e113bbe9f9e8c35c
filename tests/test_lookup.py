import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidecall import fixed_values as V
from tidecall.operators import changes, features, lookup
from tidecall.plans.contacts import contact_table
from tidecall.schema import CONTACT_KEY


def test_lookup_keeps_rows_and_finds_every_feature(spark, small):
    raw = contact_table(spark, small)
    derived = features.engineer_features(raw)
    lookups = lookup.standard_lookups(features.customer_features(derived), features.campaign_features(derived))
    joined = lookup.training_set(features.normalize_text(raw), lookups, keep=(CONTACT_KEY,))
    assert joined.count() == raw.count()
    assert joined.columns == [CONTACT_KEY, *V.NUMERIC_COLUMNS, *V.CATEGORICAL_COLUMNS, V.LABEL_COLUMN,
                              *V.CUSTOMER_FEATURES, *V.CAMPAIGN_LOOKUP]
    added = V.CUSTOMER_FEATURES + V.CAMPAIGN_LOOKUP
    assert set(joined.agg(*[F.count_if(F.col(c).isNull()) for c in added]).first()) == {0}


def test_null_keys_match(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    feats = spark.createDataFrame([("a", 10), (None, 20)], "k string, f int")
    got = lookup.lookup(df, [lookup.FeatureLookup(feats, ["k"], ["f"])])
    assert sorted(rows(got)) == [(1, "a", 10), (2, None, 20), (3, "z", None)]


def test_surrogate_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("", None), (None, ""), ("a", "b"), ("ab", None)], "x string, y string")
    for method in ("md5", "xxhash64"):
        ids = [r[0] for r in rows(lookup.surrogate_key(df, ["x", "y"], "id", method).select("id"))]
        assert len(set(ids)) == 4
    with pytest.raises(ValueError):
        lookup.surrogate_key(df, ["x"], "id", "other")


def test_assert_key(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    with pytest.raises(ValueError):
        lookup.assert_key(df, ["k"])
    lookup.assert_key(df, ["k"], nullable=True)
    with pytest.raises(ValueError):
        lookup.assert_key(df.unionAll(df), ["k"], nullable=True)


def test_combine_keeps_the_first_source_of_a_column(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    b = spark.createDataFrame([(1, "other", 5)], "id int, v string, w int")
    got = lookup.combine([a, b], "id")
    assert got.columns == ["id", "v", "w"]
    assert sorted(rows(got)) == [(1, "a", 5), (2, "b", None)]
    with pytest.raises(ValueError):
        lookup.combine([], "id")


def test_snapshot_diff(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "n")], "id int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "c"), (4, "d"), (None, "m")], "id int, v string")
    got = changes.snapshot_diff(before, after, ["id"])
    assert sorted(rows(got), key=repr) == sorted(
        [
            ("update_preimage", 2, "b"),
            ("update_postimage", 2, "c"),
            ("delete", 3, None),
            ("insert", 4, "d"),
            ("update_preimage", None, "n"),
            ("update_postimage", None, "m"),
        ],
        key=repr,
    )
    assert changes.snapshot_diff(before, before, ["id"]).count() == 0


def test_repeated_keys_are_refused(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    for feats in ([("a", 10), ("a", 11)], [(None, 1), (None, 1)]):
        table = spark.createDataFrame(feats, "k string, f int")
        with pytest.raises(ValueError, match="not a primary key"):
            lookup.lookup(df, [lookup.FeatureLookup(table, ["k"], ["f"])])


def test_keys_of_other_types_are_compared_as_the_table_has_them(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "y")], "k double, v string")
    feats = spark.createDataFrame([(1, 10), (3, 30)], "k int, f int")
    got = lookup.lookup(df, [lookup.FeatureLookup(feats, ["k"], ["f"])])
    assert got.columns == ["k", "v", "f"] and sorted(rows(got)) == [(1.0, "x", 10), (2.0, "y", None)]


def test_stored_buckets_are_not_shuffled(spark):
    """The digest is a plain join column: of two sides only the rows that ask are shuffled."""
    from tidecall.sources.tables import TableStore

    tables = TableStore(spark, "bucketed")
    tables.ensure_schema()
    feats = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("f"))
    tables.publish_features(lookup.surrogate_key(feats, ["k"], "k_id"), "feats", ["k_id"], buckets=4)
    df = spark.range(500).select((F.col("id") % 250).alias("k"), "id")
    found = lookup.FeatureLookup(tables.load("feats"), ["k"], ["f"], "k_id", True)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lookup.lookup(df, [found])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "<=>" not in plan and "Bucketed: true" in plan
        assert got.count() == 500 and got.where("f = 2 * k").count() == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_diff_shuffles_keys_and_digests_of_unchanged_rows(spark):
    before = spark.range(1000).selectExpr("id", "repeat('x', 50) as wide", "id % 7 as v")
    after = before.withColumn("v", F.when(F.col("id") == 5, 99).otherwise(F.col("v"))).where("id <> 9")
    keys = changes.changed_keys(before, after, ["id"])
    plan = keys._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join FullOuter") :]
    sides = [line for line in join.splitlines() if "Project [" in line][:2]
    assert all("__k_" in s and "__d_" in s and "wide#" not in s.split("AS __d_")[1] for s in sides)
    assert sorted(r[0][0] for r in keys.collect()) == [5, 9]
    assert changes.snapshot_diff(before, after, ["id"]).count() == 3


def test_rows_that_only_look_different_are_no_change(spark):
    """Digests differ, values are equal: the last comparison decides."""
    before = spark.createDataFrame([(1, 0.0), (2, 1.0)], "id int, v double")
    after = spark.createDataFrame([(1, -0.0), (2, 2.0)], "id int, v double")
    assert changes.changed_keys(before, after, ["id"]).count() == 2
    kinds = sorted(r[0] for r in changes.snapshot_diff(before, after, ["id"]).collect())
    assert kinds == ["update_postimage", "update_preimage"]
