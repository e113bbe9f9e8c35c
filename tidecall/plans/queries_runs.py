"""Run-log queries. The runs are the users of the event table: a user is a run, an event
type a metric key, an event's value the metric and its time the step order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecall.operators import cleaning, runs
from tidecall.plans.contacts import contact_table, table
from tidecall.plans.registry import on_clean, query
from tidecall.schema import CONTACT_KEY
from tidecall.session import scratch_path

RUNS = """
runs AS (
  SELECT concat('run-', user_id) AS run_id, concat('run-', user_id // 10 * 10) AS parent_run_id,
    concat(CASE WHEN user_id % 3 = 0 THEN 'demo' ELSE 'nightly' END, '-', user_id) AS run_name,
    CASE WHEN arg_max(event_type, (ts, event_id)) = 'error' THEN 'FAILED' ELSE 'FINISHED' END AS status,
    max(epoch_us(ts) // 1000) AS start_time
  FROM events GROUP BY user_id
),
last_values AS (
  SELECT concat('run-', user_id) AS run_id, event_type AS key, arg_max(value, (ts, event_id)) AS value
  FROM events GROUP BY 1, 2
),
cutoff AS (SELECT min(start_time) + (max(start_time) - min(start_time)) / 2 AS ms FROM runs)"""


def run_tables(spark, sf):
    events = table(spark, sf, "events")
    user, when = F.col("user_id"), F.col("ts").cast("timestamp")
    kind = F.when(user % 3 == 0, "demo").otherwise("nightly")
    last = F.max_by("event_type", F.struct("ts", "event_id"))
    found = events.groupBy("user_id").agg(
        F.when(last == "error", "FAILED").otherwise("FINISHED").alias("status"),
        F.max(F.unix_millis(when)).alias("start_time"),
    )
    all_runs = found.select(
        F.concat(F.lit("run-"), user).alias("run_id"),
        F.concat(F.lit("run-"), user - user % 10).alias("parent_run_id"),
        F.concat_ws("-", kind, user.cast("string")).alias("run_name"),
        "status",
        "start_time",
    )
    return all_runs, metric_rows(events)


def metric_rows(events):
    return events.select(
        F.concat(F.lit("run-"), F.col("user_id")).alias("run_id"),
        F.col("event_type").alias("key"),
        "value",
        "ts",
        "event_id",
    )


@query(
    "run_search",
    f"""WITH {RUNS}
SELECT run_id, parent_run_id, run_name, status,
  make_timestamp(start_time * 1000) AS start_time,
  (SELECT value FROM last_values v WHERE v.run_id = r.run_id AND key = 'purchase') AS metrics_purchase,
  (SELECT value FROM last_values v WHERE v.run_id = r.run_id AND key = 'click') AS metrics_click
FROM runs r
WHERE status = 'FINISHED' AND run_name LIKE '%demo%'""",
)
def run_search(spark, sf):
    found, metrics = run_tables(spark, sf)
    values = runs.last_values(metrics, ["ts", "event_id"])
    result = runs.search_runs(
        found, values, after_ms=0, name_like="%demo%", metric_keys=("purchase", "refund", "click")
    )
    return result.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@query(
    "run_search_params",
    f"""WITH {RUNS}
SELECT run_id, status, params_k FROM runs LEFT JOIN (
  SELECT concat('run-', user_id) AS run_id, arg_max(props ->> '$.k', (ts, event_id)) AS params_k
  FROM events GROUP BY 1
) USING (run_id) WHERE status = 'FAILED'""",
)
def run_search_params(spark, sf):
    found, metrics = run_tables(spark, sf)
    params = table(spark, sf, "events").groupBy("user_id").agg(
        F.max_by(F.get_json_object("props", "$.k"), F.struct("ts", "event_id")).alias("value")
    )
    params = params.select(F.concat(F.lit("run-"), F.col("user_id")).alias("run_id"), F.lit("k").alias("key"), "value")
    result = runs.search_runs(found, metrics, params, status="FAILED", param_keys=("k", "absent"))
    return result.select("run_id", "status", "params_k")


@query(
    "run_search_recent",
    f"""WITH {RUNS}
SELECT run_id, start_time FROM runs, cutoff WHERE status = 'FINISHED' AND start_time > ms""",
)
def run_search_recent(spark, sf):
    found, _ = run_tables(spark, sf)
    ends = found.agg((F.min("start_time") + (F.max("start_time") - F.min("start_time")) / 2).alias("ms"))
    return found.where((F.col("status") == "FINISHED") & (F.col("start_time") > ends.scalar())).select(
        "run_id", "start_time"
    )


@query(
    "run_top3",
    f"""WITH {RUNS}
SELECT run_id, value AS best FROM last_values WHERE key = 'purchase'
ORDER BY value DESC NULLS LAST, run_id LIMIT 3""",
)
def run_top3(spark, sf):
    _, metrics = run_tables(spark, sf)
    values = runs.last_values(metrics, ["ts", "event_id"]).where(F.col("key") == "purchase")
    return runs.largest(values.select("run_id", F.col("value").alias("best")), "best", 3)


@query(
    "run_latest",
    f"""WITH {RUNS}
SELECT run_id, run_name, start_time FROM runs ORDER BY start_time DESC, run_id LIMIT 1""",
)
def run_latest(spark, sf):
    found, _ = run_tables(spark, sf)
    return runs.latest(found).select("run_id", "run_name", "start_time")


@query("newest_version", "SELECT max(CAST(event_id % 250 AS INTEGER)) AS version FROM events")
def newest_version(spark, sf):
    versions = table(spark, sf, "events").select((F.col("event_id") % 250).cast("string").alias("version"))
    return runs.newest_version(versions)


@query(
    "run_metric_map",
    f"""WITH {RUNS}
SELECT run_id, max(value) FILTER (WHERE key = 'click') AS click,
  max(value) FILTER (WHERE key = 'signup') AS signup, CAST(count(*) AS INTEGER) AS n_metrics
FROM last_values GROUP BY run_id""",
)
def run_metric_map(spark, sf):
    _, metrics = run_tables(spark, sf)
    maps = runs.value_maps(runs.last_values(metrics, ["ts", "event_id"]))
    return maps.select(
        "run_id",
        F.try_element_at("metrics", F.lit("click")).alias("click"),
        F.try_element_at("metrics", F.lit("signup")).alias("signup"),
        F.size("metrics").alias("n_metrics"),
    )


@query(
    "step_series",
    """
SELECT event_id, concat('run-', user_id) AS run_id, event_type AS key, value,
  row_number() OVER w - 1 AS step, round(value - lag(value) OVER w, 6) AS delta
FROM events
WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)""",
)
def step_series(spark, sf):
    metrics = metric_rows(table(spark, sf, "events"))
    series = runs.step_series(metrics, runs.time_chunks(metrics, "ts", "event_id"), ["ts", "event_id"])
    return series.select("event_id", "run_id", "key", "value", "step", F.round("delta", 6).alias("delta"))


@query(
    "run_log_roundtrip",
    """
SELECT concat('run-', user_id) AS run_id, event_type AS key, count(*) AS n, round(max(value), 6) AS best
FROM events GROUP BY ALL""",
)
def run_log_roundtrip(spark, sf):
    log = runs.RunLog(spark, scratch_path(spark, "runs"))
    rows = metric_rows(table(spark, sf, "events")).withColumn("step", F.col("event_id"))
    log.append("metrics", rows)
    return (
        log.read("metrics").groupBy("run_id", "key").agg(F.count("*").alias("n"), F.round(F.max("value"), 6).alias("best"))
    )


# --- nested runs: one search per calendar month over simple contact rules -----------------------

RULE_GRID = {"min_duration": [60, 90, 120], "min_campaign": [1, 3, 5], "any_balance": [0, 1]}

CHILDREN = """
children AS (
  SELECT c.month, g.ordinal, g.min_duration, g.min_campaign, g.any_balance,
    round(avg(CASE WHEN (CASE WHEN duration >= g.min_duration AND campaign >= g.min_campaign
      AND (g.any_balance = 1 OR balance > 0) THEN 1 ELSE 0 END) = "Target" THEN 1 ELSE 0 END), 9) AS score
  FROM clean c CROSS JOIN (
    SELECT (row_number() OVER (ORDER BY d, k, b) - 1) AS ordinal, d AS min_duration, k AS min_campaign,
      b AS any_balance
    FROM (SELECT unnest([60, 90, 120]) AS d) CROSS JOIN (SELECT unnest([1, 3, 5]) AS k)
      CROSS JOIN (SELECT unnest([0, 1]) AS b)
  ) g
  GROUP BY ALL
)"""


def _rule_children(spark, sf):
    """Accuracy of every rule per month, in one aggregate; the grid never multiplies the rows."""
    cleaned = cleaning.clean(
        contact_table(spark, sf, "month", "duration", "campaign", "balance", "Target"),
        categorical=["month"],
        numeric=["duration", "campaign", "balance"],
        keep=(CONTACT_KEY,),
    )
    grid = runs.parameter_grid(RULE_GRID)
    accuracy = [
        F.round(F.avg((_rule(g).cast("int") == F.col("Target")).cast("double")), 9).alias(f"s{i}")
        for i, g in enumerate(grid)
    ]
    parents = cleaned.groupBy(F.col("month").alias("run_id")).agg(*accuracy)
    scores = [F.col(f"s{i}") for i in range(len(grid))]
    return parents.select("run_id"), runs.child_runs(parents, grid, scores)


def _rule(g):
    balance = F.lit(True) if g["any_balance"] else F.col("balance") > 0
    return (F.col("duration") >= g["min_duration"]) & (F.col("campaign") >= g["min_campaign"]) & balance


@query(
    "grid_cross",
    on_clean(
        CHILDREN
        + """
SELECT concat(month, '-', ordinal) AS run_id, month AS parent_run_id, CAST(ordinal AS INTEGER) AS ordinal,
  min_duration, min_campaign, any_balance, score
FROM children"""
    ),
)
def grid_cross(spark, sf):
    _, children = _rule_children(spark, sf)
    return children


@query(
    "best_child",
    on_clean(
        CHILDREN
        + """
SELECT month AS run_id, max(score) AS best_score,
  arg_max(min_duration, (score, -ordinal)) AS best_min_duration,
  arg_max(min_campaign, (score, -ordinal)) AS best_min_campaign,
  arg_max(any_balance, (score, -ordinal)) AS best_any_balance
FROM children GROUP BY month"""
    ),
)
def best_child(spark, sf):
    parents, children = _rule_children(spark, sf)
    return runs.best_child(parents, children, list(RULE_GRID))


@query(
    "child_to_parent",
    f"""WITH {RUNS}
SELECT c.run_id, c.run_name, p.run_name AS parent_name, p.status AS parent_status
FROM runs c JOIN runs p ON p.run_id = c.parent_run_id""",
)
def child_to_parent(spark, sf):
    found, _ = run_tables(spark, sf)
    parents = found.select(
        F.col("run_id").alias("parent_run_id"),
        F.col("run_name").alias("parent_name"),
        F.col("status").alias("parent_status"),
    )
    return found.join(parents, "parent_run_id").select("run_id", "run_name", "parent_name", "parent_status")


# --- input records ---------------------------------------------------------------------------


@query(
    "input_record",
    """
WITH d AS (
  SELECT CAST(sum(CAST(CAST('0x' || substr(md5(concat_ws(chr(31), doc_id, quality, toxic)), 1, 15) AS BIGINT)
    AS HUGEINT)) AS VARCHAR) AS digest
  FROM labels
)
SELECT 'run-1' AS run_id, 'labels' AS name, digest, 'table' AS source_type, 'labels' AS source_uri,
  'labels' AS source_name, 'labels' AS table_name, '1' AS version, 'training' AS context,
  CAST(NULL AS VARCHAR) AS error
FROM d
UNION ALL
SELECT 'run-2', NULL, NULL, NULL, 'Unknown URI', 'Unknown Name', NULL, NULL, NULL, 'No dataset inputs found.'""",
)
def input_record(spark, sf):
    log = runs.RunLog(spark, scratch_path(spark, "runs"))
    log.append("inputs", runs.input_record(table(spark, sf, "labels"), "run-1", "labels", "1", "training"))
    asked = spark.createDataFrame([("run-1",), ("run-2",)], "run_id string")
    return runs.read_input(log.read("inputs"), asked)


@query(
    "clipped_metrics",
    "SELECT event_id, least(0.95, greatest(0.1, value / 100)) AS score FROM events",
)
def clipped_metrics(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.least(F.lit(0.95), F.greatest(F.lit(0.1), F.col("value") / 100)).alias("score")
    )
