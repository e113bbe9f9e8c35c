"""Metrics and prediction post-processing on a deterministic score, and on supplied 0/1 pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecall.functions import columns as C
from tidecall.operators import cleaning, evaluation
from tidecall.plans.contacts import contact_table, table
from tidecall.plans.registry import on_clean, query
from tidecall.schema import CONTACT_KEY
from tidecall.session import materialize

# Contact length scaled to [0, 1] is the score; half of the range is the threshold.
SCORED = """
scored AS (
  SELECT contact_id, "Target" AS label,
    (duration - min(duration) OVER ()) / (max(duration) OVER () - min(duration) OVER ()) AS score,
    CASE WHEN (duration - min(duration) OVER ()) / (max(duration) OVER () - min(duration) OVER ()) >= 0.5
      THEN 1 ELSE 0 END AS prediction
  FROM clean
),
cells AS (
  SELECT CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn,
    CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn,
    CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp
  FROM scored
),
auc AS (
  SELECT sum(pos * (before + neg / 2)) / (sum(pos) * sum(neg)) AS roc_auc FROM (
    SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS before
    FROM (
      SELECT score, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS pos,
        CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS neg
      FROM scored GROUP BY score
    )
  )
)"""


def scored_contacts(spark, sf):
    contacts = cleaning.clean(
        contact_table(spark, sf, "duration", "Target"), categorical=[], numeric=["duration"], keep=(CONTACT_KEY,)
    )
    contacts = materialize(contacts, "scored")
    ends = contacts.agg(F.struct(F.min("duration").alias("lo"), F.max("duration").alias("hi"))).scalar()
    lo, hi = ends.getField("lo"), ends.getField("hi")
    score = (F.col("duration") - lo) / (hi - lo)
    scored = contacts.select(CONTACT_KEY, F.col("Target").alias("label"), score.alias("score"))
    return scored.withColumn("prediction", C.decide("score"))


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 9) for c in cols})


@query(
    "confusion",
    on_clean(
        SCORED
        + """
SELECT y.label, p.prediction, count(s.label) AS n
FROM (SELECT unnest([0, 1]) AS label) y CROSS JOIN (SELECT unnest([0, 1]) AS prediction) p
LEFT JOIN scored s ON s.label = y.label AND s.prediction = p.prediction GROUP BY ALL"""
    ),
)
def confusion(spark, sf):
    return evaluation.confusion_matrix(scored_contacts(spark, sf))


@query(
    "confusion_labels",
    """
SELECT count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS tn,
  count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS fp,
  count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS fn,
  count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS tp
FROM labels""",
)
def confusion_labels(spark, sf):
    return evaluation.confusion(table(spark, sf, "labels"), "quality", "toxic")


BASIC = """round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 9) AS "precision",
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 9) AS recall,
  round(CASE WHEN tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 9) AS f1"""


@query(
    "metric_bundle",
    on_clean(SCORED + f" SELECT {BASIC}, (SELECT round(roc_auc, 9) FROM auc) AS roc_auc FROM cells"),
)
def metric_bundle(spark, sf):
    bundle = evaluation.metric_bundle(scored_contacts(spark, sf))
    return _rounded(bundle, "accuracy", "precision", "recall", "f1", "roc_auc")


@query(
    "metrics_labels",
    f"""
WITH cells AS (
  SELECT CAST(count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS DOUBLE) AS tn,
    CAST(count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS DOUBLE) AS fn,
    CAST(count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS DOUBLE) AS tp
  FROM labels
) SELECT {BASIC} FROM cells""",
)
def metrics_labels(spark, sf):
    bundle = evaluation.metrics(table(spark, sf, "labels"), "quality", "toxic")
    return _rounded(bundle, "accuracy", "precision", "recall", "f1")


@query(
    "class_report",
    on_clean(
        SCORED
        + """,
per_class AS (
  SELECT '0' AS class, tn / nullif(tn + fn, 0) AS p, tn / nullif(tn + fp, 0) AS r,
    2 * tn / nullif(2 * tn + fn + fp, 0) AS f, tn + fp AS s FROM cells
  UNION ALL
  SELECT '1', tp / nullif(tp + fp, 0), tp / nullif(tp + fn, 0), 2 * tp / nullif(2 * tp + fp + fn, 0), tp + fn
  FROM cells
),
filled AS (
  SELECT class, coalesce(p, 0) AS p, coalesce(r, 0) AS r, coalesce(f, 0) AS f, s FROM per_class
)
SELECT class, round(p, 9) AS "precision", round(r, 9) AS recall, round(f, 9) AS f1, CAST(s AS BIGINT) AS support
FROM filled
UNION ALL SELECT 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f), 9), CAST(sum(s) AS BIGINT)
FROM filled
UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 9), round(sum(r * s) / sum(s), 9),
  round(sum(f * s) / sum(s), 9), CAST(sum(s) AS BIGINT) FROM filled
UNION ALL SELECT 'accuracy', a, a, a, n FROM (
  SELECT round((tp + tn) / (tp + tn + fp + fn), 9) AS a, CAST(tp + tn + fp + fn AS BIGINT) AS n FROM cells
)"""
    ),
)
def class_report(spark, sf):
    return _rounded(evaluation.class_report(scored_contacts(spark, sf)), "precision", "recall", "f1")


@query("roc_auc", on_clean(SCORED + " SELECT round(roc_auc, 9) AS roc_auc FROM auc"))
def roc_auc(spark, sf):
    return _rounded(evaluation.roc_auc(scored_contacts(spark, sf)), "roc_auc")


@query(
    "roc_auc_continuous",
    """
WITH grouped AS (
  SELECT l_extendedprice AS score, CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS pos,
    CAST(count(*) FILTER (WHERE l_returnflag <> 'R') AS DOUBLE) AS neg
  FROM lineitem GROUP BY 1
),
ranked AS (
  SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM grouped
)
SELECT round(sum(pos * (before + neg / 2)) / (sum(pos) * sum(neg)), 9) AS roc_auc FROM ranked""",
)
def roc_auc_continuous(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("score"), (F.col("l_returnflag") == "R").cast("int").alias("label")
    )
    return _rounded(evaluation.roc_auc(lines), "roc_auc")


@query(
    "roc_auc_hard",
    on_clean(SCORED + " SELECT round((tp / (tp + fn) + tn / (tn + fp)) / 2, 9) AS roc_auc_hard FROM cells"),
)
def roc_auc_hard(spark, sf):
    return _rounded(evaluation.roc_auc_hard(scored_contacts(spark, sf)), "roc_auc_hard")


@query("threshold_predict", on_clean(SCORED + " SELECT contact_id, prediction FROM scored"))
def threshold_predict(spark, sf):
    return scored_contacts(spark, sf).select(CONTACT_KEY, "prediction")


ADJUSTED = """,
adjusted AS (
  SELECT contact_id, label, score,
    CASE WHEN prediction = 0 AND substr(md5(concat('42:adjust:', contact_id)), 1, 8) < '0ccccccc' THEN 1
      ELSE prediction END AS prediction
  FROM scored
)"""


def _adjusted(spark, sf):
    scored = scored_contacts(spark, sf)
    return scored.withColumn("prediction", C.adjust_prediction("prediction", CONTACT_KEY))


@query("adjust_predictions", on_clean(SCORED + ADJUSTED + " SELECT contact_id, prediction FROM adjusted"))
def adjust_predictions(spark, sf):
    return _adjusted(spark, sf).select(CONTACT_KEY, "prediction")


@query(
    "prediction_summary",
    on_clean(
        SCORED
        + ADJUSTED
        + """
SELECT count(*) AS count, CAST(sum(prediction) AS BIGINT) AS positive_count,
  round(avg(prediction), 9) AS positive_rate, round(avg(prediction), 9) AS mean_prediction,
  CAST(0.5 AS DOUBLE) AS threshold
FROM adjusted"""
    ),
)
def prediction_summary(spark, sf):
    return _rounded(evaluation.prediction_summary(_adjusted(spark, sf)), "positive_rate", "mean_prediction")


@query("actual_vs_predicted", on_clean(SCORED + " SELECT contact_id, label, prediction FROM scored"))
def actual_vs_predicted(spark, sf):
    predicted = scored_contacts(spark, sf).select(CONTACT_KEY, "prediction")
    actual = cleaning.encode_label(contact_table(spark, sf, "Target"))
    return evaluation.actual_vs_predicted(predicted, actual, CONTACT_KEY)
