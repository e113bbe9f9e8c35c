"""Derived features of a contact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tidecall import fixed_values as V
from tidecall.functions import columns as C
from tidecall.schema import new_columns


def normalize_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Trim and lower-case the categorical columns that are present."""
    present = [c for c in cols or V.CATEGORICAL_COLUMNS if c in df.columns]
    return df.withColumns({c: C.normalize_text(c) for c in present})


def _customer_columns() -> dict[str, Column]:
    return {
        "job_category": C.job_category(),
        "education_level": C.education_level(),
        "balance_positive": C.positive_flag("balance"),
        "age_group": C.age_group(),
    }


def _campaign_columns() -> dict[str, Column]:
    number = C.month_number()
    sine, cosine = C.month_cycle(number)
    return {
        "month_number": number,
        "month_sin": sine,
        "month_cos": cosine,
        "campaign_intensity": C.campaign_intensity(),
        "has_previous": C.positive_flag("previous"),
    }


def engineer_features(df: DataFrame) -> DataFrame:
    """Normalised text plus nine derived columns, as two projections that Catalyst merges."""
    return normalize_text(df).withColumns(_customer_columns() | _campaign_columns())


def customer_features(contacts: DataFrame) -> DataFrame:
    """Distinct customer keys with their derived columns.

    The derived columns depend on the key alone, so they are added after the
    distinct: only the key is shuffled.
    """
    return normalize_text(contacts.select(*V.CUSTOMER_KEY)).distinct().withColumns(_customer_columns())


def campaign_features(contacts: DataFrame) -> DataFrame:
    """Distinct campaign keys with their derived columns."""
    return normalize_text(contacts.select(*V.CAMPAIGN_KEY)).distinct().withColumns(_campaign_columns())


def feature_growth(before: DataFrame, after: DataFrame) -> DataFrame:
    """Created columns, their number and their ratio to the original ones, as one row."""
    created = new_columns(before, after)
    row = [(",".join(created), len(created), len(after.columns), len(created) / len(before.columns))]
    return before.sparkSession.createDataFrame(
        row, "new_columns string, features_created bigint, total_features bigint, engineering_ratio double"
    )


def risk_fields(df: DataFrame, struct_column: str) -> DataFrame:
    """Score and category of a nested risk feature, with defaults where it is null."""
    return df.withColumns(
        {
            "risk_score": C.struct_field(struct_column, "risk_score", V.RISK_SCORE_DEFAULT),
            "risk_category": C.struct_field(struct_column, "risk_category", V.RISK_CATEGORY_DEFAULT),
        }
    ).drop(struct_column)


