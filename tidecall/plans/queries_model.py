"""Encoding with SQL counterparts; training, scoring and search on held-out contacts."""

from __future__ import annotations

import math

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tidecall import fixed_values as V
from tidecall.operators import cleaning, evaluation, features, modeling, splitting
from tidecall.plans.contacts import contact_table
from tidecall.plans.queries_tables import store
from tidecall.plans.queries_profile import ENGINEERED_NUMBERS
from tidecall.plans.registry import on_all, on_clean, on_contacts, query
from tidecall.schema import CONTACT_KEY
from tidecall.session import materialize, scratch_path

ENGINEERED_TEXT = ["job_category", "age_group", "campaign_intensity"]


@query(
    "zscore",
    on_clean(
        "SELECT contact_id, "
        + ", ".join(
            f"round(CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0 "
            f"ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END, 6) + 0.0 AS {c}"
            for c in V.NUMERIC_COLUMNS
        )
        + " FROM clean"
    ),
)
def zscore(spark, sf):
    cleaned = materialize(cleaning.clean(contact_table(spark, sf), keep=(CONTACT_KEY,)), "clean")
    numbers = cleaned.select(CONTACT_KEY, *V.NUMERIC_COLUMNS)
    scaled = modeling.standardize(numbers, V.NUMERIC_COLUMNS)
    return scaled.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in V.NUMERIC_COLUMNS})


@query(
    "one_hot",
    on_contacts(
        """
SELECT contact_id, marital, month,
  CASE WHEN marital = 'divorced' THEN 1 ELSE 0 END AS marital_divorced,
  CASE WHEN marital = 'married' THEN 1 ELSE 0 END AS marital_married,
  CASE WHEN marital = 'single' THEN 1 ELSE 0 END AS marital_single,
  """
        + ",\n  ".join(
            f"CASE WHEN month = '{m}' THEN 1 ELSE 0 END AS month_{m}" for m in V.MONTHS if m not in ("nov", "dec")
        )
        + """
FROM contacts"""
    ),
)
def one_hot(spark, sf):
    """Fitted before November: the last two months are unseen levels and encode to zeros."""
    contacts = materialize(contact_table(spark, sf, "marital", "month"), "levels")
    early = contacts.where(~F.col("month").isin("nov", "dec"))
    return modeling.one_hot(contacts, ["marital", "month"], fit_on=early)


@query(
    "one_hot_sparse",
    on_contacts(
        """
long AS (
  SELECT contact_id, unnest([0, 1, 2]) AS place, unnest([job, marital, month]) AS level FROM contacts
),
levels AS (
  SELECT place, level, row_number() OVER (ORDER BY place, level) - 1 AS slot
  FROM (SELECT DISTINCT place, level FROM long WHERE level IS NOT NULL)
)
SELECT contact_id, string_agg(CAST(slot AS VARCHAR), ',' ORDER BY slot) AS slots, (SELECT count(*) FROM levels) AS size
FROM long LEFT JOIN levels USING (place, level) GROUP BY contact_id"""
    ),
)
def one_hot_sparse(spark, sf):
    contacts = materialize(contact_table(spark, sf, "job", "marital", "month"), "levels")
    coded = modeling.one_hot_sparse(contacts, ["job", "marital", "month"], CONTACT_KEY)
    return coded.withColumn("slots", F.array_join("slots", ","))


def labelled_contacts(spark, sf):
    """Cleaned contacts with derived features and their side of the split, written once."""
    cleaned = cleaning.clean(contact_table(spark, sf), keep=(CONTACT_KEY,))
    derived = features.engineer_features(cleaned)
    return materialize(splitting.split_threshold(derived, CONTACT_KEY), "labelled")


def _sides(labelled):
    return [labelled.where(F.col("split") == s).drop("split") for s in ("train", "test")]


#: Saved models by session and digest of the training rows: queries over equal rows share one fit.
_FITTED: dict[tuple[str, int, int], str] = {}


def _boosted(spark, sf):
    """Boosted trees with their default parameters, saved and loaded again, and both sides.

    A model is kept for the digest of the rows that it was trained on (their number and the sum of
    their hashes), so that tables that change get a model of their own.
    """
    train, test = _sides(labelled_contacts(spark, sf))
    hashed = F.xxhash64(*train.columns).cast("decimal(20,0)")
    n, digest = train.agg(F.count("*"), F.sum(hashed)).first()
    key = (spark.sparkContext.applicationId, n, int(digest or 0))
    if key not in _FITTED:
        path = scratch_path(spark, "model")
        modeling.save_model(modeling.train(modeling.classifier_pipeline(modeling.boosted_trees()), train), path)
        _FITTED[key] = path
    return modeling.load_model(_FITTED[key]), train, test


@query("gbt_score")
def gbt_score(spark, sf):
    """Trained, saved, loaded again and applied to the held-out contacts."""
    model, _, test = _boosted(spark, sf)
    scored = modeling.score(model, test)
    return scored.select(CONTACT_KEY, F.col(V.LABEL_COLUMN).alias("label"), "probability", "prediction")


@query("gbt_metrics")
def gbt_metrics(spark, sf):
    model, _, test = _boosted(spark, sf)
    scored = modeling.score(model, test).select(
        F.col(V.LABEL_COLUMN).alias("label"), F.col("probability").alias("score"), "prediction"
    )
    return evaluation.metric_bundle(materialize(scored, "scores"))


@query(
    "gbt_checks",
    on_clean(
        """
SELECT contact_id, "Target" AS label, true AS in_range, true AS by_threshold, true AS flips_upwards,
  true AS auc_agrees, true AS learned
FROM clean WHERE substr(md5(concat('42:', contact_id)), 1, 8) < '33333333'"""
    ),
)
def gbt_checks(spark, sf):
    """Every held-out contact once, with what must hold whatever the trees are and however many rows there are.

    The area under the curve equals that of Spark's own evaluator, and on the rows it was
    trained on the model's log loss lies below that of the base rate.
    """
    model, train, test = _boosted(spark, sf)
    scored = materialize(modeling.score(model, test), "scored")
    wrapped, _ = modeling.wrapped_predict(model, test, CONTACT_KEY)
    flipped = wrapped.select(CONTACT_KEY, F.col("prediction").alias("adjusted"))
    scores = scored.select(F.col(V.LABEL_COLUMN).cast("double").alias("label"), F.col("probability").alias("score"), "prediction")
    auc = evaluation.metric_bundle(scores).first()["roc_auc"]
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    agrees = auc is None or abs(auc - evaluator.evaluate(scores)) < 1e-9
    chance = modeling.score(model, train).select(F.col(V.LABEL_COLUMN).alias("y"), F.col("probability").alias("p"))
    of_label = F.when(F.col("y") == 1, F.col("p")).otherwise(1 - F.col("p"))
    loss, rate = chance.agg(F.avg(-F.log(of_label)), F.avg("y")).first()
    base = sum(-x * math.log(x) for x in (rate, 1 - rate) if x)
    return scored.join(flipped, CONTACT_KEY).select(
        CONTACT_KEY,
        F.col(V.LABEL_COLUMN).alias("label"),
        F.col("probability").between(0, 1).alias("in_range"),
        (F.col("prediction") == (F.col("probability") >= V.THRESHOLD).cast("int")).alias("by_threshold"),
        (F.col("adjusted") >= F.col("prediction")).alias("flips_upwards"),
        F.lit(agrees).alias("auc_agrees"),
        F.lit(base == 0 or loss < base).alias("learned"),
    )


def _importances(spark, sf):
    """Importances of a forest over all features, saved as a table and read back."""
    train, _ = _sides(labelled_contacts(spark, sf))
    numbers, texts = V.NUMERIC_COLUMNS + ENGINEERED_NUMBERS, V.CATEGORICAL_COLUMNS + ENGINEERED_TEXT
    pipeline = modeling.classifier_pipeline(modeling.random_forest(), numbers, texts)
    tables = store(spark)
    tables.save(modeling.feature_importance(modeling.train(pipeline, train), train, numbers), "feature_importance")
    return tables.load("feature_importance")


@query("forest_importance")
def forest_importance(spark, sf):
    importance = _importances(spark, sf)
    summary = modeling.importance_summary(importance)
    return modeling.top_importances(importance).withColumns(
        {c: summary.select(c).scalar() for c in ("mean_importance", "engineered_in_top")}
    )


def _levels(column: str) -> str:
    return f"SELECT DISTINCT '{column}_' || trim(lower(\"{column}\")) AS feature FROM train"


@query(
    "importance_checks",
    on_all(
        """
train AS (
  SELECT clean.*, job_category, age_group, campaign_intensity
  FROM clean JOIN (
    SELECT contact_id,
      CASE WHEN trim(lower(job)) IN ('management', 'admin') THEN 'management'
        WHEN trim(lower(job)) IN ('technician', 'services') THEN 'services'
        WHEN trim(lower(job)) = 'blue-collar' THEN 'manual' ELSE 'other' END AS job_category,
      CASE WHEN age < 30 THEN 'young' WHEN age < 50 THEN 'middle' ELSE 'senior' END AS age_group,
      CASE WHEN campaign <= 2 THEN 'low' WHEN campaign <= 5 THEN 'medium' ELSE 'high' END AS campaign_intensity
    FROM clean
  ) USING (contact_id)
  WHERE NOT substr(md5(concat('42:', contact_id)), 1, 8) < '33333333'
),
names AS (
  SELECT unnest(["""
        + ", ".join(f"'{c}'" for c in V.NUMERIC_COLUMNS + ENGINEERED_NUMBERS)
        + "]) AS feature\n  UNION ALL "
        + "\n  UNION ALL ".join(_levels(c) for c in V.CATEGORICAL_COLUMNS + ENGINEERED_TEXT)
        + """
)
SELECT feature, true AS in_range, true AS sums_to_one, round(1.0 / count(*) OVER (), 9) AS mean_importance,
  least("""
        + str(V.TOP_IMPORTANCES)
        + """, count(*) OVER ()) AS top_rows, true AS top_in_order
FROM names"""
    ),
)
def importance_checks(spark, sf):
    """Every encoded feature by its name, with what must hold for importances of any forest."""
    importance = _importances(spark, sf)
    top = [r.importance for r in modeling.top_importances(importance).collect()]
    summary = modeling.importance_summary(importance)
    best = [r.importance for r in importance.orderBy(F.desc("importance")).limit(len(top)).collect()]
    total = importance.agg(F.sum("importance").alias("s")).select((F.abs(F.col("s") - 1) < 1e-9).alias("one"))
    return importance.select(
        "feature",
        F.col("importance").between(0, 1).alias("in_range"),
        total.scalar().alias("sums_to_one"),
        F.round(summary.select("mean_importance").scalar(), 9).alias("mean_importance"),
        F.lit(len(top)).cast("bigint").alias("top_rows"),
        F.lit(top == sorted(best, reverse=True)).alias("top_in_order"),
    )


@query(
    "grid_search",
    """
SELECT learning_rate, CAST(max_depth AS INTEGER) AS max_depth, CAST(n_estimators AS INTEGER) AS n_estimators,
  true AS in_range
FROM (SELECT unnest(["""
    + ", ".join(f"{x}::DOUBLE" for x in V.GRID["learning_rate"])
    + f"""]) AS learning_rate), (SELECT unnest({V.GRID["max_depth"]}) AS max_depth),
  (SELECT unnest({V.GRID["n_estimators"]}) AS n_estimators)
WHERE (SELECT count(*) FROM orders) > 0""",
)
def grid_search(spark, sf):
    """All combinations of the grid; the scores themselves depend on the trees."""
    train, _ = _sides(labelled_contacts(spark, sf))
    scores, _ = modeling.grid_search(train)
    return scores.select("learning_rate", "max_depth", "n_estimators", F.col("score").between(0, 1).alias("in_range"))


@query("wrapped_predict")
def wrapped_predict(spark, sf):
    model, _, test = _boosted(spark, sf)
    rows, _ = modeling.wrapped_predict(model, test, CONTACT_KEY)
    return rows.select(CONTACT_KEY, "probability", "prediction")
