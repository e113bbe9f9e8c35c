"""Feature tables and the joins that bring their columns back to rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecall import fixed_values as V
from tidecall.functions import columns as C
from tidecall.functions.ordered import number_rows


@dataclass(frozen=True)
class FeatureLookup:
    """Columns to fetch from a feature table by its key.

    ``digest`` names the table's column with the digest of the key (``surrogate_key``): rows are
    then joined on that one column. ``unique`` says that the table was published, which
    checks its key.
    """

    table: DataFrame
    key: list[str]
    features: list[str]
    digest: str | None = None
    unique: bool = False


def surrogate_key(df: DataFrame, cols: list[str], name: str, method: str = "md5") -> DataFrame:
    """Add an id that depends only on the key columns, not on partitioning or order.

    ``md5`` gives text without practical collisions; ``xxhash64`` a shorter
    number for moderate key counts.
    """
    if method == "md5":
        return df.withColumn(name, C.row_digest(cols))
    if method == "xxhash64":
        parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(C.NULL_MARK)) for c in cols]
        return df.withColumn(name, F.xxhash64(*parts))
    raise ValueError(f"unknown method {method!r}")


def arbitrary_id(df: DataFrame, name: str) -> DataFrame:
    """Unique, non-dense ids in one pass. They depend on the partitioning; never join on them."""
    return df.withColumn(name, F.monotonically_increasing_id())


def dense_id(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Ids 1..n in the given total order."""
    return number_rows(df, order, name)


def key_violations(df: DataFrame, key: list[str], nullable: bool = False) -> DataFrame:
    """Keys that occur more than once or, unless allowed, hold a null."""
    grouped = df.groupBy(*key).agg(F.count("*").alias("rows"))
    bad = F.col("rows") > 1
    if not nullable:
        for k in key:
            bad = bad | F.col(f"`{k}`").isNull()
    return grouped.where(bad)


def assert_key(df: DataFrame, key: list[str], nullable: bool = False) -> None:
    """Raise ``ValueError`` with a few examples if the key is not unique."""
    found = key_violations(df, key, nullable).limit(3).collect()
    if found:
        raise ValueError(f"{key} is not a primary key, for example {[r.asDict() for r in found]}")


def lookup(df: DataFrame, lookups: list[FeatureLookup], drop: tuple[str, ...] = ()) -> DataFrame:
    """Left-join the chosen feature columns, nulls matching nulls; the row count is kept.

    A feature table that holds a key twice would multiply rows: unless it was published, its
    key is checked here and a repeated one raises ``ValueError``. Rows are joined on one text, the
    digest of the key, by plain equality; a table stored in buckets of its digest column
    (``TableStore.publish_features``) is not shuffled. Small tables are broadcast by
    Spark's own size check; otherwise adaptive execution splits hot keys.
    """
    for i, item in enumerate(lookups):
        if not item.unique:
            assert_key(item.table, [item.digest] if item.digest else item.key, nullable=True)
        fresh = [c for c in item.features if c not in df.columns]
        at, asked = f"__at{i}", f"__asked{i}"
        own = F.col(f"`{item.digest}`") if item.digest else C.row_digest(item.key)
        side = item.table.select(own.alias(at), *[f"`{c}`" for c in fresh])
        # Keys are compared as the feature table has them.
        typed = df.select("*", *[F.col(f"`{k}`").cast(item.table.schema[k].dataType).alias(f"__k{i}_{j}") for j, k in enumerate(item.key)])
        names = [f"__k{i}_{j}" for j in range(len(item.key))]
        asking = typed.withColumn(asked, C.row_digest(names)).drop(*names)
        df = asking.join(side, F.col(asked) == F.col(at), "left").drop(asked, at)
    return df.drop(*drop)


def training_set(
    df: DataFrame, lookups: list[FeatureLookup], label: str = V.LABEL_COLUMN, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Inputs, encoded label and looked-up features of every row; a label that is a number already stays."""
    coded = C.encode_label(label) if df.schema[label].dataType == T.StringType() else F.col(label).cast("int")
    base = df.select(*keep, *V.NUMERIC_COLUMNS, *V.CATEGORICAL_COLUMNS, coded.alias(label))
    return lookup(base, lookups)


def scoring_set(df: DataFrame, lookups: list[FeatureLookup], keep: tuple[str, ...] = ()) -> DataFrame:
    """The same lookups at scoring time, without the label."""
    return lookup(df.select(*keep, *V.NUMERIC_COLUMNS, *V.CATEGORICAL_COLUMNS), lookups)


def standard_lookups(customers: DataFrame, campaigns: DataFrame, published: bool = False) -> list[FeatureLookup]:
    """Lookups in the two feature tables, by their digests ``customer_id`` and ``campaign_id`` if published."""
    digests = ("customer_id", "campaign_id") if published else (None, None)
    return [
        FeatureLookup(customers, V.CUSTOMER_KEY, V.CUSTOMER_FEATURES, digests[0], published),
        FeatureLookup(campaigns, V.CAMPAIGN_KEY, V.CAMPAIGN_LOOKUP, digests[1], published),
    ]


def combine(tables: list[DataFrame], on: str) -> DataFrame:
    """Left-join all tables to the first on one column; a repeated column keeps its first source.

    Write derived tables first: adaptive execution splits hot keys only between scans.
    """
    if not tables:
        raise ValueError("none of the source tables exists")
    combined = tables[0]
    for right in tables[1:]:
        fresh = [c for c in right.columns if c not in combined.columns]
        combined = combined.join(right.select(on, *fresh), on, "left")
    return combined
