"""The contact table: one row per order, joined from customers, orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecall.functions.ordered import with_history
from tidecall.schema import CONTACT_KEY, CONTACT_ORDER

JOBS = [
    "management",
    " Management ",
    "admin.",
    "admin",
    "technician",
    "services",
    "blue-collar",
    "Blue-Collar",
    "student",
    "retired",
    "housemaid",
    "unknown",
]
MARITAL = ["married", "single", "divorced"]
EDUCATION = ["primary", "secondary", "tertiary", "unknown"]
MONTH_TEXT = "janfebmaraprmayjunjulaugsepoctnovdec"

LINE_COLUMNS = {"duration", "campaign", "Target"}
HISTORY_COLUMNS = {"pdays", "previous", "poutcome"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _yes(condition) -> F.Column:
    return F.when(condition, "yes").otherwise("no")


def _pick(words: list[str], index) -> F.Column:
    return F.element_at(F.lit(words), (index + 1).cast("int"))


def contact_table(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """``contact_id`` and the named columns (all 17 by default).

    Line items are aggregated, and the contact history is computed, only when a
    named column needs them. The history (previous contact of the same customer)
    is cut by day, so a customer with very many contacts is spread over tasks.
    """
    wanted = list(columns) or CONTACT_ORDER
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    if HISTORY_COLUMNS & set(wanted):
        orders = with_history(
            orders,
            keys=["o_custkey"],
            chunk=F.to_date("o_orderdate"),
            order=["o_orderdate", "o_orderkey"],
            lags={"prev_date": "o_orderdate", "prev_status": "o_orderstatus"},
            number="contact_number",
        )
    joined = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    if LINE_COLUMNS & set(wanted):
        lines = (
            table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("qty"))
        )
        joined = joined.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")

    key, cust, qty = F.col("o_orderkey"), F.col("c_custkey"), F.coalesce("qty", F.lit(0.0))
    priority = F.col("o_orderpriority")
    definitions = {
        "age": F.lit(18) + cust % 68,
        "job": _pick(JOBS, cust % 12),
        "marital": _pick(MARITAL, cust % 3),
        "education": _pick(EDUCATION, F.col("c_nationkey") % 4),
        "default": _yes(F.col("c_acctbal") < -500),
        "balance": F.floor("c_acctbal"),
        "housing": _yes(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")),
        "loan": _yes(cust % 7 == 0),
        "contact": F.when(key % 89 == 0, F.lit(None))
        .when(priority.isin("1-URGENT", "2-HIGH"), "cellular")
        .when(priority == "3-MEDIUM", "telephone")
        .otherwise("unknown"),
        "day": F.dayofmonth("o_orderdate").cast("bigint"),
        "month": F.substring(F.lit(MONTH_TEXT), F.month("o_orderdate") * 3 - 2, F.lit(3)),
        "duration": F.when(key % 97 == 0, "n/a").otherwise(qty.cast("bigint").cast("string")),
        "campaign": F.coalesce("n_lines", F.lit(0)).cast("bigint"),
        "pdays": F.coalesce(F.datediff("o_orderdate", "prev_date"), F.lit(-1)).cast("bigint"),
        "previous": (F.col("contact_number") - 1).cast("bigint"),
        "poutcome": F.when(F.col("prev_status") == "F", "success")
        .when(F.col("prev_status") == "O", "failure")
        .when(F.col("prev_status") == "P", "other")
        .otherwise("unknown"),
        "Target": _yes(F.col("o_totalprice") / 2500 + qty > 270),
    }
    return joined.select(key.alias(CONTACT_KEY), *[definitions[c].alias(c) for c in wanted])
