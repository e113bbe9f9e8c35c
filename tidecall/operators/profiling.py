"""Data-quality profile of a table: counts, levels, distributions, correlations.

Every report is an aggregate; wide reports come out as one row per column.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import or_

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecall import fixed_values as V
from tidecall.functions import columns as C
from tidecall.functions.ordered import exact_quantiles, quantile_bounds
from tidecall.schema import numeric_columns, text_columns
from tidecall.session import materialize


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in numeric_columns(df)])


def select_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in text_columns(df)])


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("num_rows"))


def table_shape(df: DataFrame) -> DataFrame:
    """Row and column counts as one row."""
    return row_count(df).withColumn("num_columns", F.lit(len(df.columns)).cast("bigint"))


def first_rows(df: DataFrame, order: list[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows in a total order."""
    return df.orderBy(*order).limit(n)


# --- one row per column --------------------------------------------------------------


def per_column(df: DataFrame, measures: dict[str, dict[str, Column]]) -> DataFrame:
    """Aggregate once, then turn the wide row into one row per key of ``measures``."""
    names = list(next(iter(measures.values())))
    flat = [
        expr.alias(f"{i}_{n}") for i, by_name in enumerate(measures.values()) for n, expr in by_name.items()
    ]
    wide = df.agg(*flat)
    rows = [
        F.struct(F.lit(key).alias("column"), *[F.col(f"{i}_{n}").alias(n) for n in names])
        for i, key in enumerate(measures)
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_counts(df: DataFrame, only_present: bool = True) -> DataFrame:
    """Nulls (and NaN) per column; by default only columns that have some."""
    report = per_column(df, {c: {"missing": F.count_if(_is_missing(df, c))} for c in df.columns})
    return report.where("missing > 0") if only_present else report


def infinite_counts(df: DataFrame, only_present: bool = True) -> DataFrame:
    """Infinite values per numeric column."""
    report = per_column(df, {c: {"infinite": F.count_if(_is_infinite(c))} for c in numeric_columns(df)})
    return report.where("infinite > 0") if only_present else report


def constant_columns(df: DataFrame) -> DataFrame:
    """Columns with at most one distinct value besides null.

    Smallest equals largest says the same as counting distinct values, without
    keeping any of them.
    """
    report = per_column(df, {c: {"constant": _is_constant(df, c)} for c in df.columns})
    return report.where("constant").select("column")


def category_levels(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values of the named columns with their row counts, null included."""
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("level")) for c in cols])
        ).alias("p")
    ).select("p.*")
    return long.groupBy("column", "level").agg(F.count("*").alias("n"))


def describe(df: DataFrame, cols: list[str] | None = None, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column.

    Two passes over ``df``: one aggregate of all columns, with bounds for the quartiles, and
    one that counts around these bounds (``exact_quantiles``). ``exact=False`` takes the
    quartiles from the summary of the first pass.
    """
    cols = cols or numeric_columns(df)
    points = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    measures = {}
    for c in cols:
        x = C.nan_to_null(F.col(f"`{c}`").cast("double"))
        measures[c] = {
            "count": F.count(x),
            "mean": F.avg(x),
            "std": F.stddev_samp(x),
            "min": F.min(x),
            "max": F.max(x),
        }
        if exact:
            measures[c]["bounds"] = quantile_bounds(x, list(points), accuracy)
        else:
            for p, name in points.items():
                measures[c][name] = F.percentile_approx(x, list(points), accuracy)[list(points).index(p)]
    base = per_column(df, measures)
    if not exact:
        return base
    # One row per column.
    base = materialize(base, "measures")
    bounds = {r["column"]: (r["count"], r["bounds"]) for r in base.collect()}
    quartiles = (
        exact_quantiles(df, cols, list(points), accuracy, bounds)
        .groupBy("column")
        .agg(*[F.max(F.when(F.col("probability") == p, F.col("value"))).alias(n) for p, n in points.items()])
    )
    return base.drop("bounds").join(quartiles, "column", "left")


# --- distributions -------------------------------------------------------------------


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per value, nulls left out."""
    counts = df.where(F.col(f"`{column}`").isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n"))
    return counts.withColumn("share", F.col("n") / total.scalar())


def positive_rate(df: DataFrame, label: str = V.LABEL_COLUMN) -> DataFrame:
    """Share of rows whose label is the positive word (or 1)."""
    return df.agg(F.avg(_label(df, label)).alias("positive_rate"))


def target_rate_by(
    df: DataFrame, column: str, label: str = V.LABEL_COLUMN, min_rows: int = V.MIN_GROUP_ROWS
) -> DataFrame:
    """Positive rate and size of every group with at least ``min_rows`` rows."""
    return (
        df.where(F.col(f"`{column}`").isNotNull())
        .groupBy(column)
        .agg(F.avg(_label(df, label)).alias("target_rate"), F.count("*").alias("n"))
        .where(F.col("n") >= min_rows)
    )


def histogram(df: DataFrame, column: str, bins: int = V.HISTOGRAM_BINS, by: str | None = None) -> DataFrame:
    """Equal-width bins between the smallest and the largest finite value, empty bins included.

    A value is placed by comparing it with the edges that are returned, so that it lies between
    those of its bin; on an inner edge it counts above. With ``by`` every class gets its own
    range. The last bin is closed on the right; a constant column gets a range of one
    unit around its value.
    """
    groups = [by] if by else []
    data = df.select(*groups, C.finite(column).alias("__x")).where(F.col("__x").isNotNull())
    if by:
        data = data.where(F.col(f"`{by}`").isNotNull())
    flat = F.min("__x") == F.max("__x")
    half = F.when(flat, F.lit(0.5)).otherwise(F.lit(0.0))
    low, high = (F.min("__x") - half), (F.max("__x") + half)
    edge = lambda i: F.when(i == bins, F.col("__hi")).otherwise(
        F.col("__lo") + (F.col("__hi") - F.col("__lo")) / F.lit(float(bins)) * i
    )
    edges = F.transform(F.sequence(F.lit(0), F.lit(bins)), edge).alias("__edges")
    ranges = data.groupBy(*groups).agg(low.alias("__lo"), high.alias("__hi"))
    ranges = ranges.where(F.col("__lo").isNotNull()).select(*groups, edges)
    if by:
        # One row per class, written first so that the planner knows how small it is.
        ranges = materialize(ranges, "ranges")
        placed = data.join(ranges, by)
    else:
        placed = data.withColumn("__edges", ranges.select("__edges").scalar())
    # A bin near the value by division, moved by the edges themselves.
    at = lambda i: F.get("__edges", i)
    x, width = F.col("__x"), (at(F.lit(bins)) - at(F.lit(0))) / F.lit(float(bins))
    near = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((x - at(F.lit(0))) / width).cast("int")))
    place = F.when(x < at(F.col("__near")), F.col("__near") - 1).otherwise(
        F.when((F.col("__near") < bins - 1) & (x >= at(F.col("__near") + 1)), F.col("__near") + 1).otherwise(F.col("__near"))
    )
    counts = placed.withColumn("__near", near).groupBy(*groups, place.alias("bin")).agg(F.count("*").alias("__n"))
    frame = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return frame.join(counts, [*groups, "bin"], "left").select(
        *groups,
        "bin",
        F.get("__edges", F.col("bin")).alias("lower"),
        F.get("__edges", F.col("bin") + 1).alias("upper"),
        F.coalesce("__n", F.lit(0)).alias("n"),
    )


# --- correlations --------------------------------------------------------------------


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both are present; null if either is constant."""
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)


def label_correlations(
    df: DataFrame, cols: list[str] | None = None, label: str = V.LABEL_COLUMN
) -> DataFrame:
    """Absolute correlation of each numeric column with the 0/1 label; null where it is undefined."""
    cols = cols or [c for c in numeric_columns(df) if c != label]
    target = _label(df, label).cast("double")
    measures = {c: {"abs_corr": C.nan_to_null(F.abs(correlation(_number(c), target)))} for c in cols}
    return per_column(df, measures)


def top_correlations(
    df: DataFrame, cols: list[str] | None = None, label: str = V.LABEL_COLUMN, n: int = V.TOP_CORRELATIONS
) -> DataFrame:
    return label_correlations(df, cols, label).orderBy(F.desc_nulls_last("abs_corr"), "column").limit(n)


def correlation_pairs(
    df: DataFrame, cols: list[str] | None = None, above: float | None = None, max_columns: int = 600
) -> DataFrame:
    """Absolute correlation of each pair of numeric columns, each pair once, at most 1.

    A pair counts the rows where both values are finite; it is null where either is constant
    there. ``above`` keeps only stronger pairs. The sums are computed when this is called, in
    two passes over ``df`` for up to ``max_columns`` columns, whose matrix of three times their number
    the driver holds. More columns are cut into blocks, and each pair of blocks has passes and a
    matrix of its own, so that the matrix stays bounded.
    """
    cols = cols or numeric_columns(df)
    if len(cols) < 2:
        report = df.sparkSession.createDataFrame([], "column_a string, column_b string, abs_corr double")
    elif len(cols) <= max_columns:
        report = _pairs_by_cross_products(df, cols)
    else:
        size = max(1, max_columns // 2)
        blocks = [cols[i : i + size] for i in range(0, len(cols), size)]
        report = None
        for (i, left), (j, right) in combinations(enumerate(blocks), 2):
            pairs = _pairs_by_cross_products(df, left + right)
            # Pairs inside a block are taken once: with its successor, those of the last one beside them.
            inside = [F.col("column_a").isin(left) & F.col("column_b").isin(right)]
            inside += [F.col("column_a").isin(left) & F.col("column_b").isin(left)] if j == i + 1 else []
            inside += [F.col("column_a").isin(right) & F.col("column_b").isin(right)] if i + 2 == j + 1 == len(blocks) else []
            part = pairs.where(reduce(or_, inside))
            report = part if report is None else report.unionByName(part)
    return report if above is None else report.where(F.col("abs_corr") > F.lit(float(above)))


def _pairs_by_cross_products(df: DataFrame, cols: list[str]) -> DataFrame:
    """Centred values, their squares and their presence form one vector per row.

    The cross products of that vector hold every sum that any pair needs: a
    matrix of three times the number of columns, whatever the number of rows.
    """
    measures = (F.avg, F.min, F.max)
    found = df.agg(*[f(C.finite(c)).alias(f"m{i}_{k}") for i, c in enumerate(cols) for k, f in enumerate(measures)]).first()
    values, present, squares = [], [], []
    for i, c in enumerate(cols):
        mean, low, high = found[3 * i : 3 * i + 3]
        # A constant column is exactly zero once centred, whatever the rounding of its mean.
        x = C.finite(c) - F.lit(float((low if low == high else mean) or 0.0))
        values.append(F.coalesce(x, F.lit(0.0)))
        present.append(x.isNotNull().cast("double"))
        squares.append(F.coalesce(x * x, F.lit(0.0)))
    parts = values + present + squares
    names = [f"p{i}" for i in range(len(parts))]
    rows = df.select(*[p.alias(n) for p, n in zip(parts, names)])
    vectors = VectorAssembler(inputCols=names, outputCol="v").transform(rows).select("v")
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v")).computeGramianMatrix().toArray()
    k = len(cols)
    x, m, q = slice(0, k), slice(k, 2 * k), slice(2 * k, 3 * k)
    products, sums, square_sums, counts = gram[x, x], gram[x, m], gram[q, m], gram[m, m]
    with np.errstate(all="ignore"):
        mean = sums / counts
        power = square_sums / counts
        variance = power - mean**2
        variance[variance <= 1e-12 * power] = np.nan  # constant among the shared rows
        strength = np.minimum(1.0, np.abs(products / counts - mean * mean.T) / np.sqrt(variance * variance.T))
    found = [
        (cols[i], cols[j], None if np.isnan(strength[i, j]) else float(strength[i, j]))
        for i, j in combinations(range(k), 2)
    ]
    return df.sparkSession.createDataFrame(found, "column_a string, column_b string, abs_corr double")


# --- combined reports ----------------------------------------------------------------


def feature_stats(df: DataFrame, original: int = len(V.NUMERIC_COLUMNS + V.CATEGORICAL_COLUMNS) + 1) -> DataFrame:
    """Numbers of numeric, text, all and engineered columns, as one row from the schema."""
    row = [(len(numeric_columns(df)), len(text_columns(df)), len(df.columns), len(df.columns) - original)]
    return df.sparkSession.createDataFrame(
        row,
        "numeric_features bigint, categorical_features bigint, total_features bigint, engineered_features bigint",
    )


def validation_report(df: DataFrame, high: float = V.HIGH_CORRELATION) -> DataFrame:
    """All quality findings as rows ``check, subject, value``."""
    numbers = numeric_columns(df)
    measures = {f"missing_values\t{c}": {"value": F.count_if(_is_missing(df, c)).cast("double")} for c in df.columns}
    measures |= {f"constant_features\t{c}": {"value": _is_constant(df, c).cast("double")} for c in df.columns}
    measures |= {f"infinite_values\t{c}": {"value": F.count_if(_is_infinite(c)).cast("double")} for c in numbers}
    names = F.split("column", "\t")
    counts = per_column(df, measures).where("value > 0")
    counts = counts.select(names[0].alias("check"), names[1].alias("subject"), "value")
    pairs = correlation_pairs(df, numbers, above=high).select(
        F.lit("high_correlations").alias("check"),
        F.concat_ws(",", "column_a", "column_b").alias("subject"),
        F.col("abs_corr").alias("value"),
    )
    return counts.unionByName(pairs)


def report_json(report: DataFrame, subject: str = "subject", value: str = "value") -> DataFrame:
    """Findings of each check as one JSON text, subjects in order."""
    entries = F.array_sort(F.collect_list(F.struct(subject, value)))
    return report.groupBy("check").agg(F.to_json(F.map_from_entries(entries)).alias("findings"))


CHECKS = ["missing_values", "infinite_values", "constant_features", "high_correlations"]


def quality_checks(report: DataFrame) -> DataFrame:
    """One row per check: passed when the validation report has no finding of it."""
    found = report.groupBy("check").agg(F.count("*").alias("issues"))
    checks = report.sparkSession.createDataFrame([(c,) for c in CHECKS], "check string")
    return checks.join(found, "check", "left").select(
        "check",
        F.coalesce("issues", F.lit(0)).alias("issues"),
        F.col("issues").isNull().alias("passed"),
    )


def quality_score(checks: DataFrame) -> DataFrame:
    """Share of passed checks."""
    return checks.agg(F.avg(F.col("passed").cast("double")).alias("quality_score"))


def data_summary(raw: DataFrame, features: DataFrame, split: DataFrame, checks: DataFrame) -> DataFrame:
    """Size, rate, split and issue counts as rows ``metric, value``."""
    base = raw.agg(F.count("*").alias("n"), F.avg(_label(raw, V.LABEL_COLUMN)).alias("rate"))
    sides = split.agg(
        F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "test").alias("test")
    )
    created = len(set(features.columns) - set(raw.columns))

    def metric(name, value):
        return F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))

    parts = [
        base.select(
            F.explode(
                F.array(
                    metric("total_records", F.col("n")),
                    metric("original_features", F.lit(len(raw.columns))),
                    metric("engineered_features", F.lit(len(features.columns))),
                    metric("features_created", F.lit(created)),
                    metric("target_rate", F.col("rate")),
                )
            ).alias("m")
        ),
        sides.select(
            F.explode(F.array(metric("training_samples", F.col("train")), metric("test_samples", F.col("test")))).alias("m")
        ),
        checks.select(F.struct(F.col("check").alias("metric"), F.col("issues").cast("double").alias("value")).alias("m")),
    ]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.select("m.*")


# --- helpers ---------------------------------------------------------------------------


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def _is_missing(df: DataFrame, c: str) -> Column:
    col = F.col(f"`{c}`")
    return col.isNull() | F.isnan(col) if _is_float(df, c) else col.isNull()


def _is_infinite(c: str) -> Column:
    return F.abs(F.col(f"`{c}`").cast("double")) == F.lit(float("inf"))


def _is_constant(df: DataFrame, c: str) -> Column:
    col = C.nan_to_null(c) if _is_float(df, c) else F.col(f"`{c}`")
    return F.min(col).eqNullSafe(F.max(col))


def _number(c: str) -> Column:
    return C.nan_to_null(F.col(f"`{c}`").cast("double"))


def _label(df: DataFrame, label: str) -> Column:
    is_text = isinstance(df.schema[label].dataType, T.StringType)
    return C.encode_label(label) if is_text else F.col(f"`{label}`")
