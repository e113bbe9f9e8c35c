"""Query catalogue: each entry is a Spark query and, where SQL can say it, its ANSI form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its SQL counterpart, if any."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


# --- shared SQL for the counterpart queries -------------------------------------------

CONTACTS = """
la AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty
  FROM lineitem GROUP BY l_orderkey
),
contacts AS (
  SELECT
    o_orderkey AS contact_id,
    18 + c_custkey % 68 AS age,
    CASE c_custkey % 12
      WHEN 0 THEN 'management' WHEN 1 THEN ' Management ' WHEN 2 THEN 'admin.' WHEN 3 THEN 'admin'
      WHEN 4 THEN 'technician' WHEN 5 THEN 'services' WHEN 6 THEN 'blue-collar'
      WHEN 7 THEN 'Blue-Collar' WHEN 8 THEN 'student' WHEN 9 THEN 'retired'
      WHEN 10 THEN 'housemaid' ELSE 'unknown' END AS job,
    CASE c_custkey % 3 WHEN 0 THEN 'married' WHEN 1 THEN 'single' ELSE 'divorced' END AS marital,
    CASE c_nationkey % 4 WHEN 0 THEN 'primary' WHEN 1 THEN 'secondary' WHEN 2 THEN 'tertiary'
      ELSE 'unknown' END AS education,
    CASE WHEN c_acctbal < -500 THEN 'yes' ELSE 'no' END AS "default",
    CAST(floor(c_acctbal) AS BIGINT) AS balance,
    CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'yes' ELSE 'no' END AS housing,
    CASE WHEN c_custkey % 7 = 0 THEN 'yes' ELSE 'no' END AS loan,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL
      WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'cellular'
      WHEN o_orderpriority = '3-MEDIUM' THEN 'telephone' ELSE 'unknown' END AS contact,
    CAST(day(o_orderdate) AS BIGINT) AS day,
    substring('janfebmaraprmayjunjulaugsepoctnovdec',
              CAST(3 * month(o_orderdate) - 2 AS INTEGER), 3) AS month,
    CASE WHEN o_orderkey % 97 = 0 THEN 'n/a'
      ELSE CAST(CAST(coalesce(qty, 0) AS BIGINT) AS VARCHAR) END AS duration,
    CAST(coalesce(n_lines, 0) AS BIGINT) AS campaign,
    CAST(coalesce(date_diff('day', lag(o_orderdate) OVER w, o_orderdate), -1) AS BIGINT) AS pdays,
    CAST(row_number() OVER w - 1 AS BIGINT) AS previous,
    CASE lag(o_orderstatus) OVER w WHEN 'F' THEN 'success' WHEN 'O' THEN 'failure'
      WHEN 'P' THEN 'other' ELSE 'unknown' END AS poutcome,
    CASE WHEN o_totalprice / 2500 + coalesce(qty, 0) > 270 THEN 'yes' ELSE 'no' END AS "Target"
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  LEFT JOIN la ON l_orderkey = o_orderkey
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
)"""

CLEAN = """
clean AS (
  SELECT
    contact_id,
    coalesce(nullif(job, 'unknown'), 'missing') AS job,
    coalesce(nullif(marital, 'unknown'), 'missing') AS marital,
    coalesce(nullif(education, 'unknown'), 'missing') AS education,
    coalesce(nullif("default", 'unknown'), 'missing') AS "default",
    coalesce(nullif(housing, 'unknown'), 'missing') AS housing,
    coalesce(nullif(loan, 'unknown'), 'missing') AS loan,
    coalesce(nullif(contact, 'unknown'), 'missing') AS contact,
    coalesce(nullif(month, 'unknown'), 'missing') AS month,
    coalesce(nullif(poutcome, 'unknown'), 'missing') AS poutcome,
    coalesce(TRY_CAST(age AS DOUBLE), 0) AS age,
    coalesce(TRY_CAST(balance AS DOUBLE), 0) AS balance,
    coalesce(TRY_CAST(day AS DOUBLE), 0) AS day,
    coalesce(TRY_CAST(duration AS DOUBLE), 0) AS duration,
    coalesce(TRY_CAST(campaign AS DOUBLE), 0) AS campaign,
    coalesce(TRY_CAST(pdays AS DOUBLE), 0) AS pdays,
    coalesce(TRY_CAST(previous AS DOUBLE), 0) AS previous,
    CASE WHEN "Target" = 'yes' THEN 1 ELSE 0 END AS "Target"
  FROM contacts
)"""

FEATURES = """
normal AS (
  SELECT
    contact_id, age,
    trim(lower(job)) AS job, trim(lower(marital)) AS marital, trim(lower(education)) AS education,
    trim(lower("default")) AS "default", balance, trim(lower(housing)) AS housing,
    trim(lower(loan)) AS loan, trim(lower(contact)) AS contact, day, trim(lower(month)) AS month,
    duration, campaign, pdays, previous, trim(lower(poutcome)) AS poutcome, "Target"
  FROM contacts
),
feat AS (
  SELECT *,
    sin(2 * pi() * month_number / 12) AS month_sin,
    cos(2 * pi() * month_number / 12) AS month_cos
  FROM (
    SELECT *,
      CASE WHEN job IN ('management', 'admin') THEN 'management'
        WHEN job IN ('technician', 'services') THEN 'services'
        WHEN job = 'blue-collar' THEN 'manual' ELSE 'other' END AS job_category,
      CASE education WHEN 'tertiary' THEN 3 WHEN 'secondary' THEN 2 WHEN 'primary' THEN 1
        ELSE 0 END AS education_level,
      CASE WHEN balance > 0 THEN 1 ELSE 0 END AS balance_positive,
      CASE WHEN age < 30 THEN 'young' WHEN age < 50 THEN 'middle' ELSE 'senior' END AS age_group,
      CASE month WHEN 'jan' THEN 1 WHEN 'feb' THEN 2 WHEN 'mar' THEN 3 WHEN 'apr' THEN 4
        WHEN 'may' THEN 5 WHEN 'jun' THEN 6 WHEN 'jul' THEN 7 WHEN 'aug' THEN 8
        WHEN 'sep' THEN 9 WHEN 'oct' THEN 10 WHEN 'nov' THEN 11 WHEN 'dec' THEN 12
        ELSE 6 END AS month_number,
      CASE WHEN campaign <= 2 THEN 'low' WHEN campaign <= 5 THEN 'medium'
        ELSE 'high' END AS campaign_intensity,
      CASE WHEN previous > 0 THEN 1 ELSE 0 END AS has_previous
    FROM normal
  )
)"""


def on_contacts(body: str) -> str:
    """SQL over the CTE ``contacts``; ``body`` starts with SELECT or further CTEs."""
    return _with(CONTACTS, body)


def on_clean(body: str) -> str:
    return _with(f"{CONTACTS},{CLEAN}", body)


def on_features(body: str) -> str:
    return _with(f"{CONTACTS},{FEATURES}", body)


def on_all(body: str) -> str:
    return _with(f"{CONTACTS},{CLEAN},{FEATURES}", body)


def _with(ctes: str, body: str) -> str:
    body = body.strip()
    joiner = "" if body.upper().startswith("SELECT") else ","
    return f"WITH {ctes.strip()}{joiner}\n{body}"
