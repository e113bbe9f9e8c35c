"""Cleaning, label coding and derived features, on the contact table and on supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecall import fixed_values as V
from tidecall.functions import columns as C
from tidecall.operators import cleaning, features, profiling
from tidecall.plans.contacts import contact_table, table
from tidecall.plans.registry import on_all, on_clean, on_contacts, on_features, query
from tidecall.schema import CONTACT_KEY


def digits(c):
    """Nine digits and no negative zero, so that both engines print the same."""
    return F.round(c, 9) + F.lit(0.0)


@query(
    "numeric_coerce",
    on_contacts(
        """
SELECT contact_id, TRY_CAST(age AS DOUBLE) AS age, TRY_CAST(balance AS DOUBLE) AS balance,
  TRY_CAST(day AS DOUBLE) AS day, TRY_CAST(duration AS DOUBLE) AS duration,
  TRY_CAST(campaign AS DOUBLE) AS campaign, TRY_CAST(pdays AS DOUBLE) AS pdays,
  TRY_CAST(previous AS DOUBLE) AS previous
FROM contacts"""
    ),
)
def numeric_coerce(spark, sf):
    return cleaning.coerce_numbers(contact_table(spark, sf, *V.NUMERIC_COLUMNS))


def _replaced(expressions: dict[str, str]) -> str:
    """All contact columns, some of them replaced."""
    return "SELECT * REPLACE (" + ", ".join(f'{e} AS "{c}"' for c, e in expressions.items()) + ") FROM contacts"


@query(
    "sentinel_to_null",
    on_contacts(_replaced({c: f"nullif(\"{c}\", 'unknown')" for c in V.CATEGORICAL_COLUMNS})),
)
def sentinel_to_null(spark, sf):
    return cleaning.sentinel_to_null(contact_table(spark, sf))


@query(
    "fill_missing",
    on_contacts(
        _replaced(
            {c: f"coalesce(\"{c}\", 'missing')" for c in V.CATEGORICAL_COLUMNS}
            | {c: f"coalesce({c}, 0)" for c in V.NUMERIC_COLUMNS}
            | {"duration": "coalesce(TRY_CAST(duration AS DOUBLE), 0)"}
        )
    ),
)
def fill_missing(spark, sf):
    return cleaning.fill_missing(cleaning.coerce_numbers(contact_table(spark, sf), ["duration"]))


@query(
    "encode_label",
    on_contacts("""SELECT contact_id, CASE WHEN "Target" = 'yes' THEN 1 ELSE 0 END AS "Target" FROM contacts"""),
)
def encode_label(spark, sf):
    return cleaning.encode_label(contact_table(spark, sf, "Target"))


@query(
    "decode_label",
    """
SELECT doc_id,
  CASE quality WHEN 1 THEN 'yes' WHEN 0 THEN 'no' END AS quality,
  CASE toxic WHEN 1 THEN 'yes' WHEN 0 THEN 'no' END AS toxic
FROM labels""",
)
def decode_label(spark, sf):
    return cleaning.decode_label(cleaning.decode_label(table(spark, sf, "labels"), "quality"), "toxic")


@query(
    "contract_select",
    on_contacts(
        """
SELECT contact_id, age, balance, day, duration, campaign, pdays, previous, job, marital, education,
  "default", housing, loan, contact, month, poutcome
FROM contacts"""
    ),
)
def contract_select(spark, sf):
    inputs, _ = cleaning.split_columns(contact_table(spark, sf), keep=(CONTACT_KEY,))
    return inputs


@query(
    "select_by_type",
    on_contacts("SELECT contact_id, age, balance, day, campaign, pdays, previous FROM contacts"),
)
def select_by_type(spark, sf):
    return profiling.select_numeric(contact_table(spark, sf)).drop(V.LABEL_COLUMN)


@query(
    "add_missing_columns",
    """
SELECT o_orderkey AS contact_id, o_orderstatus AS poutcome,
  CAST(0 AS BIGINT) AS age, CAST(0 AS BIGINT) AS balance, CAST(0 AS BIGINT) AS day,
  CAST(0 AS BIGINT) AS duration, CAST(0 AS BIGINT) AS campaign, CAST(0 AS BIGINT) AS pdays,
  CAST(0 AS BIGINT) AS previous, 'unknown' AS job, 'unknown' AS marital, 'unknown' AS education,
  'unknown' AS "default", 'unknown' AS housing, 'unknown' AS loan, 'unknown' AS contact,
  'unknown' AS month, 'no' AS "Target"
FROM orders""",
)
def add_missing_columns(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias(CONTACT_KEY), F.col("o_orderstatus").alias("poutcome")
    )
    return cleaning.add_absent_columns(orders)


@query("clean_contacts", on_clean("SELECT * FROM clean"))
def clean_contacts(spark, sf):
    return cleaning.clean(contact_table(spark, sf), keep=(CONTACT_KEY,))


@query(
    "normalize_text",
    on_features(
        """
SELECT contact_id, job, marital, education, "default", housing, loan, contact, month, poutcome
FROM normal"""
    ),
)
def normalize_text(spark, sf):
    return features.normalize_text(contact_table(spark, sf, *V.CATEGORICAL_COLUMNS))


def _one_feature(name, sql_columns, inputs, build):
    @query(name, on_features(f"SELECT contact_id, {sql_columns} FROM feat"))
    def run(spark, sf):
        df = features.normalize_text(contact_table(spark, sf, *inputs))
        return df.select(CONTACT_KEY, *[e.alias(n) for n, e in build().items()])

    return run


def _month_columns():
    number = C.month_number()
    sine, cosine = C.month_cycle(number)
    return {"month_number": number, "month_sin": digits(sine), "month_cos": digits(cosine)}


_one_feature("job_category", "job_category", ["job"], lambda: {"job_category": C.job_category()})
_one_feature(
    "education_level", "education_level", ["education"], lambda: {"education_level": C.education_level()}
)
_one_feature(
    "balance_flag", "balance_positive", ["balance"], lambda: {"balance_positive": C.positive_flag("balance")}
)
_one_feature("age_group", "age_group", ["age"], lambda: {"age_group": C.age_group()})
_one_feature(
    "month_cycle",
    "month_number, round(month_sin, 9) + 0.0 AS month_sin, round(month_cos, 9) + 0.0 AS month_cos",
    ["month"],
    _month_columns,
)
_one_feature(
    "campaign_intensity",
    "campaign_intensity",
    ["campaign"],
    lambda: {"campaign_intensity": C.campaign_intensity()},
)
_one_feature(
    "has_previous", "has_previous", ["previous"], lambda: {"has_previous": C.positive_flag("previous")}
)


def rounded_cycle(df):
    return df.withColumns({c: digits(c) for c in ("month_sin", "month_cos")})


@query(
    "engineered_features",
    on_features(
        """SELECT * REPLACE (round(month_sin, 9) + 0.0 AS month_sin, round(month_cos, 9) + 0.0 AS month_cos)
FROM feat"""
    ),
)
def engineered_features(spark, sf):
    return rounded_cycle(features.engineer_features(contact_table(spark, sf)))


@query(
    "new_columns",
    on_features(
        """
SELECT 'age_group,balance_positive,campaign_intensity,education_level,has_previous,job_category,month_cos,month_number,month_sin' AS new_columns,
  CAST(9 AS BIGINT) AS features_created, CAST(26 AS BIGINT) AS total_features,
  CAST(9 AS DOUBLE) / 17 AS engineering_ratio, count(*) AS n_rows FROM feat"""
    ),
)
def new_columns(spark, sf):
    raw = contact_table(spark, sf).drop(CONTACT_KEY)
    after = features.engineer_features(raw)
    growth = features.feature_growth(raw, after)
    return growth.withColumn("n_rows", profiling.row_count(after).scalar())


@query(
    "struct_defaults",
    """
SELECT o_orderkey, coalesce(CASE WHEN has_risk THEN score END, CAST(0.5 AS DOUBLE)) AS risk_score,
  coalesce(CASE WHEN has_risk THEN category END, 'MEDIUM') AS risk_category
FROM (
  SELECT o_orderkey, o_orderstatus <> 'P' AS has_risk,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice / 1000000 END AS score,
    CASE WHEN o_totalprice > 300000 THEN 'HIGH' WHEN o_totalprice < 50000 THEN 'LOW' END AS category
  FROM orders
)""",
)
def struct_defaults(spark, sf):
    score = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice") / 1000000)
    category = F.when(F.col("o_totalprice") > 300000, "HIGH").when(F.col("o_totalprice") < 50000, "LOW")
    risk = F.struct(score.alias("risk_score"), category.alias("risk_category"))
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", risk).alias("risk")
    )
    return features.risk_fields(orders, "risk")


@query(
    "nan_to_null",
    on_contacts(
        """SELECT contact_id, CASE WHEN contact_id % 101 = 0 THEN NULL ELSE CAST(balance AS DOUBLE) END AS balance
FROM contacts"""
    ),
)
def nan_to_null(spark, sf):
    nan = F.lit(float("nan"))
    dirty = contact_table(spark, sf, "balance").withColumn(
        "balance", F.when(F.col(CONTACT_KEY) % 101 == 0, nan).otherwise(F.col("balance").cast("double"))
    )
    return cleaning.nan_to_null(dirty)


@query("epoch_ms", "SELECT event_id, date_trunc('millisecond', ts) AS ts FROM events")
def epoch_ms(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms")
    )
    return events.select("event_id", C.epoch_millis("ms").cast("timestamp_ntz").alias("ts"))


ML_READY_SQL = on_contacts(
    _replaced(
        {c: f"TRY_CAST({c} AS DOUBLE)" for c in V.NUMERIC_COLUMNS}
        | {"Target": "CASE WHEN \"Target\" = 'yes' THEN 1 ELSE 0 END"}
    )
)


@query("ml_ready", ML_READY_SQL)
def ml_ready(spark, sf):
    return cleaning.ml_ready(contact_table(spark, sf))


@query(
    "audit_copy",
    on_clean(
        """SELECT * REPLACE (CASE "Target" WHEN 1 THEN 'yes' WHEN 0 THEN 'no' END AS "Target") FROM clean"""
    ),
)
def audit_copy(spark, sf):
    return cleaning.decode_label(cleaning.clean(contact_table(spark, sf), keep=(CONTACT_KEY,)))


@query(
    "target_rate_by",
    on_all(
        """
SELECT f.job_category, round(avg(c."Target"), 9) AS target_rate, count(*) AS n
FROM feat f JOIN clean c USING (contact_id)
GROUP BY f.job_category HAVING count(*) >= 10"""
    ),
)
def target_rate_by(spark, sf):
    cleaned = cleaning.clean(
        contact_table(spark, sf, "job", "Target"), categorical=["job"], numeric=[], keep=(CONTACT_KEY,)
    )
    derived = features.normalize_text(cleaned).withColumn("job_category", C.job_category())
    rates = profiling.target_rate_by(derived, "job_category")
    return rates.withColumn("target_rate", F.round("target_rate", 9))
