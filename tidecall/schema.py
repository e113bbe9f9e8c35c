"""Explicit schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

from tidecall.fixed_values import CATEGORICAL_COLUMNS, LABEL_COLUMN, NUMERIC_COLUMNS

CONTACT_KEY = "contact_id"

#: Order of the columns in a raw contact file.
CONTACT_ORDER = [
    "age",
    "job",
    "marital",
    "education",
    "default",
    "balance",
    "housing",
    "loan",
    "contact",
    "day",
    "month",
    "duration",
    "campaign",
    "pdays",
    "previous",
    "poutcome",
    LABEL_COLUMN,
]


def contact_schema(key: str | None = None, text_numbers: tuple[str, ...] = ()) -> T.StructType:
    """Schema of a raw contact file; ``text_numbers`` names numeric columns kept as text."""
    fields = [T.StructField(key, T.LongType())] if key else []
    for name in CONTACT_ORDER:
        numeric = name in NUMERIC_COLUMNS and name not in text_numbers
        fields.append(T.StructField(name, T.LongType() if numeric else T.StringType()))
    return T.StructType(fields)


def numeric_columns(df) -> list[str]:
    """Columns of any numeric type, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df) -> list[str]:
    """String columns, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def new_columns(before, after) -> list[str]:
    """Columns of ``after`` that ``before`` lacks, sorted."""
    return sorted(set(after.columns) - set(before.columns))


# Run-log tables.
_RUN_TEXT = [
    T.StructField("run_id", T.StringType(), False),
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.StringType()),
]
RUN_PARAMS = T.StructType(_RUN_TEXT)
RUN_TAGS = T.StructType(_RUN_TEXT)
RUN_METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("key", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
        T.StructField("step", T.LongType()),
        T.StructField("ts", T.TimestampType()),
    ]
)
RUN_INPUTS = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "run_id",
            "name",
            "digest",
            "source_type",
            "source_uri",
            "source_name",
            "table_name",
            "version",
            "context",
        )
    ]
)
RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("parent_run_id", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("start_time", T.LongType()),
    ]
)
LOAD_LOG = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("version", T.LongType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("operation", T.StringType()),
        T.StructField("num_rows", T.LongType()),
    ]
)
