"""Data-quality profile: on the contact table with planted dirt, and on supplied tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tidecall import fixed_values as V
from tidecall.operators import cleaning, features, profiling, splitting
from tidecall.plans.contacts import contact_table, table
from tidecall.plans.registry import on_all, on_clean, on_contacts, query
from tidecall.schema import CONTACT_KEY
from tidecall.session import materialize

# Planted dirt: infinities, NaN and a constant column.
DIRTY = """
dirty AS (
  SELECT age, CAST(NULL AS VARCHAR) AS empty, job, contact, balance, 'phone' AS channel,
    CASE WHEN contact_id % 103 = 0 THEN CAST('Infinity' AS DOUBLE)
      WHEN contact_id % 101 = 0 THEN CAST('NaN' AS DOUBLE)
      ELSE CAST(campaign AS DOUBLE) END AS reach,
    campaign, campaign * 2 + 1 AS touches
  FROM contacts
)"""


def dirty_contacts(spark, sf):
    raw = contact_table(spark, sf, "age", "job", "contact", "balance", "campaign")
    key = F.col(CONTACT_KEY)
    reach = (
        F.when(key % 103 == 0, F.lit(float("inf")))
        .when(key % 101 == 0, F.lit(float("nan")))
        .otherwise(F.col("campaign").cast("double"))
    )
    return raw.select(
        "age",
        F.lit(None).cast("string").alias("empty"),
        "job",
        "contact",
        "balance",
        F.lit("phone").alias("channel"),
        reach.alias("reach"),
        "campaign",
        (F.col("campaign") * 2 + 1).alias("touches"),
    )


@query(
    "null_counts",
    on_contacts(
        DIRTY
        + """
SELECT * FROM (
  SELECT 'age' AS "column", count(*) FILTER (WHERE age IS NULL) AS missing FROM dirty
  UNION ALL SELECT 'empty', count(*) FILTER (WHERE empty IS NULL) FROM dirty
  UNION ALL SELECT 'job', count(*) FILTER (WHERE job IS NULL) FROM dirty
  UNION ALL SELECT 'contact', count(*) FILTER (WHERE contact IS NULL) FROM dirty
  UNION ALL SELECT 'balance', count(*) FILTER (WHERE balance IS NULL) FROM dirty
  UNION ALL SELECT 'reach', count(*) FILTER (WHERE reach IS NULL OR isnan(reach)) FROM dirty
) WHERE missing > 0"""
    ),
)
def null_counts(spark, sf):
    return profiling.null_counts(dirty_contacts(spark, sf))


@query(
    "inf_counts",
    on_contacts(
        DIRTY + """SELECT 'reach' AS "column", count(*) FILTER (WHERE isinf(reach)) AS infinite FROM dirty"""
    ),
)
def inf_counts(spark, sf):
    return profiling.infinite_counts(dirty_contacts(spark, sf))


@query(
    "level_sets",
    """
SELECT 'o_orderstatus' AS "column", o_orderstatus AS level, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2""",
)
def level_sets(spark, sf):
    return profiling.category_levels(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query(
    "constant_columns",
    on_contacts(
        DIRTY
        + """
SELECT "column" FROM (
  SELECT 'age' AS "column", count(DISTINCT age) AS n FROM dirty
  UNION ALL SELECT 'empty', count(DISTINCT empty) FROM dirty
  UNION ALL SELECT 'job', count(DISTINCT job) FROM dirty
  UNION ALL SELECT 'contact', count(DISTINCT contact) FROM dirty
  UNION ALL SELECT 'balance', count(DISTINCT balance) FROM dirty
  UNION ALL SELECT 'channel', count(DISTINCT channel) FROM dirty
  UNION ALL SELECT 'reach', count(DISTINCT nullif(reach, CAST('NaN' AS DOUBLE))) FROM dirty
  UNION ALL SELECT 'campaign', count(DISTINCT campaign) FROM dirty
  UNION ALL SELECT 'touches', count(DISTINCT touches) FROM dirty
) WHERE n <= 1"""
    ),
)
def constant_columns(spark, sf):
    return profiling.constant_columns(dirty_contacts(spark, sf))


ENGINEERED_NUMBERS = ["education_level", "balance_positive", "month_number", "month_sin", "month_cos", "has_previous"]
#: Numbers and texts of the line items; with the date these are all their columns.
LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_OTHERS = ["l_returnflag", "l_linestatus", "l_shipdate"]


def _describe_sql(columns: list[str], source: str, prefix: str = "") -> str:
    one = """SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75 FROM {source}"""
    return prefix + "\nUNION ALL\n".join(one.format(c=c, source=source) for c in columns)


def _described(df, cols):
    report = profiling.describe(df, cols)
    return report.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query("describe", on_clean(_describe_sql(V.NUMERIC_COLUMNS, "clean")))
def describe(spark, sf):
    cleaned = cleaning.clean(contact_table(spark, sf), keep=(CONTACT_KEY,))
    numbers = materialize(cleaned.select(*V.NUMERIC_COLUMNS), "numbers")
    return _described(numbers, V.NUMERIC_COLUMNS)


@query("describe_lines", _describe_sql(LINE_NUMBERS, "lineitem"))
def describe_lines(spark, sf):
    return _described(table(spark, sf, "lineitem"), LINE_NUMBERS)


@query(
    "value_counts",
    on_contacts(
        """
SELECT contact, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share
FROM contacts WHERE contact IS NOT NULL GROUP BY contact"""
    ),
)
def value_counts(spark, sf):
    counts = profiling.value_counts(contact_table(spark, sf, "contact"), "contact")
    return counts.withColumn("share", F.round("share", 9))


@query(
    "positive_rate",
    on_contacts(
        """SELECT round(avg(CASE WHEN "Target" = 'yes' THEN 1 ELSE 0 END), 9) AS positive_rate FROM contacts"""
    ),
)
def positive_rate(spark, sf):
    rate = profiling.positive_rate(contact_table(spark, sf, "Target"))
    return rate.select(F.round("positive_rate", 9).alias("positive_rate"))


@query(
    "target_rate_events",
    """
SELECT event_type, round(avg(CASE WHEN value > 20 THEN 1 ELSE 0 END), 9) AS target_rate, count(*) AS n
FROM events GROUP BY event_type HAVING count(*) >= 10""",
)
def target_rate_events(spark, sf):
    events = table(spark, sf, "events").select("event_type", (F.col("value") > 20).cast("int").alias("Target"))
    rates = profiling.target_rate_by(events, "event_type")
    return rates.withColumn("target_rate", F.round("target_rate", 9))


# --- histograms ------------------------------------------------------------------------


def _edges(df):
    return df.withColumns({"lower": F.round("lower", 6), "upper": F.round("upper", 6)})


@query(
    "histogram",
    """
WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
bins AS (SELECT CAST(unnest(range(20)) AS INTEGER) AS bin),
edges AS (SELECT CASE WHEN i = 20 THEN hi ELSE lo + (hi - lo) / CAST(20 AS DOUBLE) * i END AS edge FROM r, range(21) AS t(i)),
placed AS (
  SELECT CAST(least((SELECT count(*) FROM edges WHERE edge <= o_totalprice) - 1, 19) AS INTEGER) AS bin FROM orders
)
SELECT bin, round(lo + (hi - lo) / CAST(20 AS DOUBLE) * bin, 6) AS lower,
  round(lo + (hi - lo) / CAST(20 AS DOUBLE) * (bin + 1), 6) AS upper,
  (SELECT count(*) FROM placed p WHERE p.bin = bins.bin) AS n
FROM bins, r""",
)
def histogram(spark, sf):
    return _edges(profiling.histogram(table(spark, sf, "orders").select("o_totalprice"), "o_totalprice"))


@query(
    "histogram_by_class",
    """
WITH r AS (SELECT o_orderstatus, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1),
bins AS (SELECT CAST(unnest(range(20)) AS INTEGER) AS bin),
edges AS (
  SELECT o_orderstatus AS s, CASE WHEN i = 20 THEN hi ELSE lo + (hi - lo) / CAST(20 AS DOUBLE) * i END AS edge
  FROM r, range(21) AS t(i)
),
placed AS (
  SELECT o_orderstatus,
    CAST(least((SELECT count(*) FROM edges WHERE s = o_orderstatus AND edge <= o_totalprice) - 1, 19) AS INTEGER) AS bin
  FROM orders
)
SELECT r.o_orderstatus, b.bin, round(lo + (hi - lo) / CAST(20 AS DOUBLE) * b.bin, 6) AS lower,
  round(lo + (hi - lo) / CAST(20 AS DOUBLE) * (b.bin + 1), 6) AS upper, count(p.bin) AS n
FROM r CROSS JOIN bins b LEFT JOIN placed p ON p.o_orderstatus = r.o_orderstatus AND p.bin = b.bin
GROUP BY ALL""",
)
def histogram_by_class(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_totalprice")
    return _edges(profiling.histogram(orders, "o_totalprice", by="o_orderstatus"))


# --- correlations ------------------------------------------------------------------------


def _safe_corr(a: str, b: str) -> str:
    return (
        f"CASE WHEN stddev_pop(CASE WHEN {b} IS NOT NULL THEN {a} END) > 0 "
        f"AND stddev_pop(CASE WHEN {a} IS NOT NULL THEN {b} END) > 0 "
        f"THEN round(abs(covar_pop({a}, {b}) / (stddev_pop(CASE WHEN {b} IS NOT NULL THEN {a} END) "
        f"* stddev_pop(CASE WHEN {a} IS NOT NULL THEN {b} END))), 9) END"
    )


@query(
    "label_correlation",
    on_all(
        """
merged AS (
  SELECT c.*, f.education_level, f.balance_positive, f.month_number, f.month_sin, f.month_cos, f.has_previous
  FROM clean c JOIN feat f USING (contact_id)
),
long AS ("""
        + "\nUNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {_safe_corr(c, chr(34) + 'Target' + chr(34))} AS abs_corr FROM merged"
            for c in V.NUMERIC_COLUMNS + ENGINEERED_NUMBERS
        )
        + """
)
SELECT * FROM long ORDER BY abs_corr DESC NULLS LAST, "column" LIMIT 15"""
    ),
)
def label_correlation(spark, sf):
    cleaned = cleaning.clean(contact_table(spark, sf), keep=(CONTACT_KEY,))
    derived = features.engineer_features(cleaned)
    cols = V.NUMERIC_COLUMNS + ENGINEERED_NUMBERS
    top = profiling.top_correlations(derived, cols)
    return top.withColumn("abs_corr", F.round("abs_corr", 9))


@query(
    "correlation_pairs",
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {_safe_corr(a, b)} AS abs_corr FROM lineitem"
        for a, b in [
            ("l_quantity", "l_extendedprice"),
            ("l_quantity", "l_discount"),
            ("l_quantity", "l_tax"),
            ("l_extendedprice", "l_discount"),
            ("l_extendedprice", "l_tax"),
            ("l_discount", "l_tax"),
        ]
    ),
)
def correlation_pairs(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    pairs = profiling.correlation_pairs(table(spark, sf, "lineitem"), cols)
    return pairs.withColumn("abs_corr", F.round("abs_corr", 9))


@query(
    "correlation_wide",
    "WITH wide AS (SELECT *, nullif(l_linenumber, 3) AS gaps, 0.1 AS same, 1000000 + l_linenumber % 2 AS nearly "
    "FROM lineitem)\n"
    + "\nUNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
        + ("max(CAST(NULL AS DOUBLE))" if "same" in (a, b) else _safe_corr(a, b))
        + " AS abs_corr FROM (SELECT * FROM wide)"
        for a, b in combinations([*LINE_NUMBERS, "gaps", "same", "nearly"], 2)
    ),
)
def correlation_wide(spark, sf):
    """All pairs of all numeric columns, with nulls, a constant and a nearly constant column."""
    wide = table(spark, sf, "lineitem").select(
        *LINE_NUMBERS,
        F.nullif("l_linenumber", F.lit(3)).alias("gaps"),
        F.lit(0.1).alias("same"),
        (F.col("l_linenumber") % 2 + 1_000_000).alias("nearly"),
    )
    return profiling.correlation_pairs(wide).withColumn("abs_corr", F.round("abs_corr", 9))


DIRTY_NUMBERS = ["age", "balance", "campaign", "touches", "reach"]


@query(
    "high_correlation_pairs",
    on_contacts(
        DIRTY
        + """,
finite AS (SELECT * REPLACE (CASE WHEN isfinite(reach) THEN reach END AS reach) FROM dirty)
SELECT * FROM (
"""
        + "\nUNION ALL ".join(
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, {_safe_corr(a, b)} AS abs_corr FROM finite"
            for a, b in combinations(DIRTY_NUMBERS, 2)
        )
        + """
) WHERE abs_corr > 0.95"""
    ),
)
def high_correlation_pairs(spark, sf):
    dirty = materialize(dirty_contacts(spark, sf), "dirty")
    pairs = profiling.correlation_pairs(dirty, DIRTY_NUMBERS, above=V.HIGH_CORRELATION)
    return pairs.withColumn("abs_corr", F.round("abs_corr", 9))


# --- reports -----------------------------------------------------------------------------

REPORT = (
    DIRTY
    + """,
findings AS (
  SELECT 'missing_values' AS "check", 'empty' AS subject, CAST(count(*) AS DOUBLE) AS value FROM dirty
  UNION ALL SELECT 'missing_values', 'contact', count(*) FROM dirty WHERE contact IS NULL
  UNION ALL SELECT 'missing_values', 'reach', count(*) FROM dirty WHERE isnan(reach)
  UNION ALL SELECT 'infinite_values', 'reach', count(*) FROM dirty WHERE isinf(reach)
  UNION ALL SELECT 'constant_features', 'empty', 1
  UNION ALL SELECT 'constant_features', 'channel', 1
  UNION ALL SELECT 'high_correlations', 'campaign,touches', round(abs(corr(campaign, touches)), 9) FROM dirty
  UNION ALL SELECT 'high_correlations', 'reach,campaign', round(abs(corr(reach, campaign)), 9)
    FROM dirty WHERE NOT isnan(reach) AND NOT isinf(reach)
  UNION ALL SELECT 'high_correlations', 'reach,touches', round(abs(corr(reach, touches)), 9)
    FROM dirty WHERE NOT isnan(reach) AND NOT isinf(reach)
)"""
)


@query("validation_report", on_contacts(REPORT + " SELECT * FROM findings"))
def validation_report(spark, sf):
    report = profiling.validation_report(materialize(dirty_contacts(spark, sf), "dirty"))
    return report.withColumn("value", F.round("value", 9))


@query(
    "report_json",
    on_contacts(
        REPORT
        + """
SELECT "check", '{' || string_agg('"' || subject || '":' || CAST(CAST(value AS BIGINT) AS VARCHAR), ','
  ORDER BY subject) || '}' AS findings
FROM findings GROUP BY 1"""
    ),
)
def report_json(spark, sf):
    report = profiling.validation_report(materialize(dirty_contacts(spark, sf), "dirty"))
    return profiling.report_json(report.withColumn("value", F.round("value").cast("bigint")))


@query(
    "quality_checks",
    on_contacts(
        REPORT
        + """
SELECT "check", count(*) AS issues, false AS passed FROM findings GROUP BY 1"""
    ),
)
def quality_checks(spark, sf):
    dirty = materialize(dirty_contacts(spark, sf), "dirty")
    return profiling.quality_checks(profiling.validation_report(dirty))


_LINE_COLUMNS = LINE_NUMBERS + LINE_OTHERS
_LINE_PAIRS = ", ".join(f"abs(corr({a}, {b}))" for a, b in combinations(LINE_NUMBERS, 2))


@query(
    "quality_score",
    f"""
SELECT (
  CASE WHEN count(*) FILTER (WHERE {" OR ".join(f"{c} IS NULL" for c in _LINE_COLUMNS)}) = 0 THEN 1 ELSE 0 END
  + CASE WHEN count(*) FILTER (WHERE {" OR ".join(f"isinf(CAST({c} AS DOUBLE))" for c in LINE_NUMBERS)}) = 0
    THEN 1 ELSE 0 END
  + CASE WHEN least({", ".join(f"count(DISTINCT {c})" for c in _LINE_COLUMNS)}) > 1 THEN 1 ELSE 0 END
  + CASE WHEN greatest({_LINE_PAIRS}) > 0.95 THEN 0 ELSE 1 END
) / CAST(4 AS DOUBLE) AS quality_score
FROM lineitem""",
)
def quality_score(spark, sf):
    """Over all columns of the line items."""
    report = profiling.validation_report(table(spark, sf, "lineitem"))
    return profiling.quality_score(profiling.quality_checks(report))


@query(
    "feature_stats",
    on_contacts(
        """SELECT CAST(12 AS BIGINT) AS numeric_features, CAST(14 AS BIGINT) AS categorical_features,
  CAST(26 AS BIGINT) AS total_features, CAST(9 AS BIGINT) AS engineered_features, count(*) AS num_rows
FROM contacts"""
    ),
)
def feature_stats(spark, sf):
    derived = features.engineer_features(contact_table(spark, sf).drop(CONTACT_KEY))
    return profiling.feature_stats(derived).withColumn("num_rows", profiling.row_count(derived).scalar())


@query(
    "table_shape",
    "SELECT count(*) AS num_rows, CAST(11 AS BIGINT) AS num_columns FROM lineitem",
)
def table_shape(spark, sf):
    return profiling.table_shape(table(spark, sf, "lineitem"))


@query(
    "data_summary",
    on_contacts(
        DIRTY
        + """
SELECT 'total_records' AS metric, CAST(count(*) AS DOUBLE) AS value FROM contacts
UNION ALL SELECT 'original_features', 17
UNION ALL SELECT 'engineered_features', 26
UNION ALL SELECT 'features_created', 9
UNION ALL SELECT 'target_rate', round(avg(CASE WHEN "Target" = 'yes' THEN 1 ELSE 0 END), 9) FROM contacts
UNION ALL SELECT 'training_samples', count(*) - ceil(CAST(0.2 AS DOUBLE) * count(*)) FROM contacts
UNION ALL SELECT 'test_samples', ceil(CAST(0.2 AS DOUBLE) * count(*)) FROM contacts
UNION ALL SELECT 'missing_values', 1 UNION ALL SELECT 'infinite_values', 0
UNION ALL SELECT 'constant_features', 0 UNION ALL SELECT 'high_correlations', 0"""
    ),
)
def data_summary(spark, sf):
    raw = materialize(contact_table(spark, sf), "contacts")
    contacts = raw.drop(CONTACT_KEY)
    derived = features.engineer_features(contacts)
    split = splitting.split_exact(raw.select(CONTACT_KEY), CONTACT_KEY)
    checks = profiling.quality_checks(profiling.validation_report(derived))
    summary = profiling.data_summary(contacts, derived, split, checks)
    return summary.withColumn("value", F.round("value", 9))


@query(
    "first_rows",
    "SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id LIMIT 5",
)
def first_rows(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    return profiling.first_rows(events, [F.desc("ts"), "event_id"], 5)
