import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidecall import fixed_values as V
from tidecall.functions import columns as C
from tidecall.operators import cleaning, features
from tidecall.plans.contacts import contact_table
from tidecall.schema import CONTACT_KEY, contact_schema, new_columns, numeric_columns, text_columns


def test_label_words(spark):
    """Only the exact positive word counts; case and blanks matter."""
    words = ["no", "No", "yes", None, "yes", "maybe", "yes"]
    df = spark.createDataFrame([(w,) for w in words], "Target string")
    assert [r[0] for r in rows(cleaning.encode_label(df))] == [0, 0, 1, 0, 1, 0, 1]


def test_label_is_left_alone_when_numeric(spark):
    df = spark.createDataFrame([(1,), (0,)], "Target int")
    assert rows(cleaning.encode_label(df)) == [(1,), (0,)]
    assert rows(cleaning.decode_label(df)) == [("yes",), ("no",)]
    text = spark.createDataFrame([("yes",)], "Target string")
    assert rows(cleaning.decode_label(text)) == [("yes",)]


def test_decode_of_other_numbers_is_null(spark):
    df = spark.createDataFrame([(2,), (None,)], "Target int")
    assert rows(cleaning.decode_label(df)) == [(None,), (None,)]


@pytest.mark.parametrize(
    "text, number",
    [("12", 12.0), (" 12 ", 12.0), ("-3.5", -3.5), ("1e3", 1000.0), (".5", 0.5), ("1d", None), ("5f", None), ("0x1p3", None), ("n/a", None), ("", None), (None, None)],
)
def test_to_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(C.to_number("x")).first()[0] == number


def test_null_numeric_label_is_zero(spark, small):
    raw = contact_table(spark, small).limit(3).withColumn(V.LABEL_COLUMN, F.lit(None).cast("double"))
    assert rows(cleaning.clean(raw).select(V.LABEL_COLUMN)) == [(0,)] * 3


def test_contract_names_label_first(spark):
    empty = spark.createDataFrame([], "x int")
    with pytest.raises(KeyError, match="Target"):
        cleaning.clean(empty)
    partial = spark.createDataFrame([], "Target string, age int")
    with pytest.raises(KeyError, match="job") as e:
        cleaning.clean(partial)
    assert "age" not in str(e.value).split("[")[1].split("'")[1::2]


def test_clean_has_no_nulls_and_keeps_rows(spark, small):
    raw = contact_table(spark, small)
    cleaned = cleaning.clean(raw, keep=(CONTACT_KEY,))
    assert cleaned.columns == [CONTACT_KEY, *V.CATEGORICAL_COLUMNS, *V.NUMERIC_COLUMNS, V.LABEL_COLUMN]
    assert cleaned.count() == raw.count()
    nulls = cleaned.agg(*[F.count_if(F.col(f"`{c}`").isNull()) for c in cleaned.columns]).first()
    assert set(nulls) == {0}
    assert cleaned.where("job = 'unknown' or contact = 'unknown'").count() == 0


def test_clean_is_one_projection(spark, small):
    """Cleaning adds no exchange and no Python to the scan."""
    path = f"{small}/orders.parquet"
    raw = cleaning.add_absent_columns(spark.read.parquet(path))
    plan = cleaning.clean(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert rows(cleaning.nan_to_null(df)) == [(None,), (1.0,), (None,)]


def test_absent_columns_get_typed_defaults(spark):
    df = cleaning.add_absent_columns(spark.createDataFrame([(30,)], "age int"))
    row = df.first().asDict()
    assert row["age"] == 30 and row["balance"] == 0 and row["job"] == "unknown" and row["Target"] == "no"
    assert set(df.columns) == set(V.NUMERIC_COLUMNS + V.CATEGORICAL_COLUMNS + [V.LABEL_COLUMN])


def test_ml_ready_casts(spark):
    df = spark.createDataFrame([("yes", "12", "x")], "Target string, age string, other string")
    assert rows(cleaning.ml_ready(df)) == [(1, 12.0, "x")]


# Every branch of every derived column, nulls included: they reach the last branch.
BRANCHES = [
    ("job_category", "job", [(" Management ", "management"), ("ADMIN", "management"), ("admin.", "other"),
     ("technician", "services"), ("services", "services"), ("Blue-Collar", "manual"), ("student", "other"),
     (None, "other")]),
    ("education_level", "education", [("tertiary", 3), ("Secondary", 2), ("primary", 1), ("unknown", 0), (None, 0)]),
    ("balance_positive", "balance", [(1, 1), (0, 0), (-5, 0), (None, 0)]),
    ("age_group", "age", [(29, "young"), (30, "middle"), (49, "middle"), (50, "senior"), (None, "senior")]),
    ("month_number", "month", [(m, i + 1) for i, m in enumerate(V.MONTHS)] + [("Mai", 6), (None, 6), (" DEC ", 12)]),
    ("campaign_intensity", "campaign", [(1, "low"), (2, "low"), (3, "medium"), (5, "medium"), (6, "high"),
     (None, "high")]),
    ("has_previous", "previous", [(1, 1), (0, 0), (None, 0)]),
]


@pytest.mark.parametrize("feature, source, cases", BRANCHES, ids=[b[0] for b in BRANCHES])
def test_branches(spark, feature, source, cases):
    schema = contact_schema()
    values = [tuple(v if f.name == source else None for f in schema.fields) for v, _ in cases]
    df = features.engineer_features(spark.createDataFrame(values, schema))
    assert [r[0] for r in df.select(feature).collect()] == [want for _, want in cases]


def test_month_circle(spark):
    df = spark.createDataFrame([("mar",), ("dec",)], "month string")
    number = C.month_number()
    sine, cosine = C.month_cycle(number)
    got = df.select(sine, cosine).collect()
    assert math.isclose(got[0][0], 1.0) and abs(got[0][1]) < 1e-12
    assert abs(got[1][0]) < 1e-12 and math.isclose(got[1][1], 1.0)


def test_schema_helpers(spark):
    df = spark.createDataFrame([], "a int, b string, c double, d date, e decimal(5,2)")
    assert numeric_columns(df) == ["a", "c", "e"]
    assert text_columns(df) == ["b"]
    assert new_columns(df.select("a"), df.select("a", "c", "b")) == ["b", "c"]


def test_struct_defaults(spark):
    schema = "risk struct<risk_score: double, risk_category: string>"
    df = spark.createDataFrame([((0.9, "HIGH"),), ((None, "LOW"),), (None,)], schema)
    assert rows(features.risk_fields(df, "risk")) == [(0.9, "HIGH"), (0.5, "LOW"), (0.5, "MEDIUM")]
