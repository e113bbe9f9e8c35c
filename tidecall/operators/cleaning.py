"""Cleaning a contact table: coercion, missing values, label coding, column contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecall import fixed_values as V
from tidecall.functions import columns as C
from tidecall.schema import numeric_columns, text_columns


def check_contract(df: DataFrame, cols: list[str], label: str = V.LABEL_COLUMN) -> None:
    """Raise ``KeyError`` before any plan is built: the label first, then all absent columns."""
    if label not in df.columns:
        raise KeyError(f"label column {label!r} is missing")
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise KeyError(f"columns missing: {absent}")


def coerce_numbers(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Numeric columns to double; text that is no number becomes null."""
    return df.withColumns({c: _number(df, c) for c in _present(df, cols or V.NUMERIC_COLUMNS)})


def _number(df: DataFrame, c: str) -> Column:
    """The column as double; only text has to be parsed."""
    if isinstance(df.schema[c].dataType, T.StringType):
        return C.to_number(c)
    return F.col(f"`{c}`").cast("double")


def sentinel_to_null(df: DataFrame, sentinel: str = V.UNKNOWN) -> DataFrame:
    """Null wherever a text column holds exactly the sentinel."""
    return df.withColumns({c: C.drop_sentinel(c, sentinel) for c in text_columns(df)})


def fill_missing(
    df: DataFrame, categorical: list[str] | None = None, numeric: list[str] | None = None
) -> DataFrame:
    """Null categories to ``missing``, null numbers to zero."""
    texts = _present(df, categorical or V.CATEGORICAL_COLUMNS)
    numbers = _present(df, numeric or V.NUMERIC_COLUMNS)
    zero = {c: F.lit(0).cast(df.schema[c].dataType) for c in numbers}
    return df.withColumns(
        {c: C.fill(c, V.MISSING) for c in texts}
        | {c: F.coalesce(F.col(f"`{c}`"), zero[c]) for c in numbers}
    )


def encode_label(df: DataFrame, label: str = V.LABEL_COLUMN) -> DataFrame:
    """Label words to 1/0, only when the label is text."""
    if label in text_columns(df):
        return df.withColumn(label, C.encode_label(label))
    return df


def decode_label(df: DataFrame, label: str = V.LABEL_COLUMN) -> DataFrame:
    """Label numbers to words, only when the label is numeric."""
    if label in numeric_columns(df):
        return df.withColumn(label, C.decode_label(label))
    return df


def clean(
    df: DataFrame,
    categorical: list[str] | None = None,
    numeric: list[str] | None = None,
    label: str = V.LABEL_COLUMN,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The whole cleaning step as one projection.

    Output order is ``keep`` (row keys), categorical, numeric, label. Every
    filled column comes out non-null.
    """
    categorical = V.CATEGORICAL_COLUMNS if categorical is None else categorical
    numeric = V.NUMERIC_COLUMNS if numeric is None else numeric
    check_contract(df, [*keep, *categorical, *numeric, label], label)
    texts = [C.fill(C.drop_sentinel(F.col(f"`{c}`").cast("string")), V.MISSING).alias(c) for c in categorical]
    numbers = [_filled_number(df, c).alias(c) for c in numeric]
    is_text = isinstance(df.schema[label].dataType, T.StringType)
    target = C.encode_label(label) if is_text else C.fill(F.col(f"`{label}`").cast("int"), 0)
    return df.select(*keep, *texts, *numbers, target.alias(label))


def _filled_number(df: DataFrame, c: str) -> Column:
    """The column as double without null and NaN; what cannot occur in its type is not asked for."""
    field = df.schema[c]
    number = _number(df, c)
    if isinstance(field.dataType, (T.StringType, T.FloatType, T.DoubleType)):
        return C.fill(C.nan_to_null(number), 0.0)
    return C.fill(number, 0.0) if field.nullable else number


def split_columns(
    df: DataFrame,
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
    label: str = V.LABEL_COLUMN,
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Model inputs (numeric then categorical) and label; ``keep`` carries row keys into both."""
    inputs = (numeric or V.NUMERIC_COLUMNS) + (categorical or V.CATEGORICAL_COLUMNS)
    check_contract(df, inputs, label)
    return df.select(*keep, *inputs), df.select(*keep, label)


def add_absent_columns(
    df: DataFrame,
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
    label: str = V.LABEL_COLUMN,
) -> DataFrame:
    """Add configured columns that a source lacks, each with its typed default."""
    defaults = (
        {c: F.lit(V.ABSENT_NUMERIC).cast("bigint") for c in numeric or V.NUMERIC_COLUMNS}
        | {c: F.lit(V.UNKNOWN) for c in categorical or V.CATEGORICAL_COLUMNS}
        | {label: F.lit(V.ABSENT_LABEL)}
    )
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to null in every floating-point column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: C.nan_to_null(c) for c in floats})


def ml_ready(
    df: DataFrame, numeric: list[str] | None = None, label: str = V.LABEL_COLUMN
) -> DataFrame:
    """Text label to 1/0 and numeric columns to double; all other columns unchanged."""
    return coerce_numbers(encode_label(df, label), numeric)


def _present(df: DataFrame, cols: list[str]) -> list[str]:
    return [c for c in cols if c in df.columns]
