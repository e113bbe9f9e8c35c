"""Reproducible splits and samples, ordered by a hash of the row key.

The same key falls on the same side whatever the partitioning, so a split survives retries
and reruns. Where a key repeats at the border of an exact split, the values of the whole row
decide; rows that agree in all of them are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecall import fixed_values as V
from tidecall.functions import columns as C
from tidecall.functions.ordered import number_rows
from tidecall.session import materialize

#: Hex digits of a hash that make a number, and bits of it below its counting bucket (2 ** 16 buckets).
_HASH_DIGITS, _BELOW_BUCKET = 15, 44
#: Bits of ``monotonically_increasing_id`` below the partition number.
_BELOW_PARTITION = 33


def split_threshold(
    df: DataFrame, key: str | list[str], fraction: float = V.TEST_FRACTION, seed: int = V.SEED
) -> DataFrame:
    """Add ``split``: ``test`` for about the given share, in one pass without a shuffle."""
    is_test = C.hash_below(C.hash_order(key, seed), fraction)
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def split_exact(
    df: DataFrame,
    key: str | list[str] | None = None,
    fraction: float = V.TEST_FRACTION,
    seed: int = V.SEED,
    strata: list[str] | None = None,
) -> DataFrame:
    """Add ``split`` with exactly ``ceil(fraction * n)`` test rows, the lowest in hash order.

    Without a key the order is drawn from all columns of a row. With ``strata`` the test rows
    are shared out in proportion to the size of each stratum, leftovers going to the largest
    remainders. The input is read once and written with its hashes; all steps read that table
    (``_first_rows`` says how the last test row is found without ranking the rows).
    """
    strata = strata or []
    stored = _with_order(df, C.hash_order(key or df.columns, seed))
    counts = _bucket_counts(stored, strata, "__h", _BELOW_BUCKET)
    quota = _quotas(counts.groupBy(*strata).agg(F.sum("__n").alias("__total")), strata, fraction)
    marked = _first_rows(stored, df.columns, strata, materialize(quota, "quota"), counts)
    return marked.withColumn("split", F.when(F.col("__first"), "test").otherwise("train")).select(*df.columns, "split")


def _with_order(df: DataFrame, order: Column) -> DataFrame:
    """The rows, written with their hash ``__h`` and a number of their own, ``__at``."""
    return materialize(
        df.withColumns({"__h": _number(order), "__at": F.monotonically_increasing_id()}), "ordered"
    )


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, _HASH_DIGITS), 16, 10).cast("bigint")


def _bucket_counts(rows: DataFrame, groups: list[str], key: str, below: int) -> DataFrame:
    """Rows per group and bucket of a number, written: at most 2 ** 16 per group, or one per partition."""
    bucket = F.shiftright(key, below).alias("__b")
    return materialize(rows.groupBy(*groups, bucket).agg(F.count("*").alias("__n")), "buckets")


def _cut(rows: DataFrame, groups: list[str], key: str, below: int, quota: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Per group the number ``__cut`` at which the ``__k`` lowest rows end.

    ``__need`` rows of those with this number are among them, of ``__n`` that have it. Counts
    per bucket show in which bucket it lies; there rows are counted per number. Only counts
    are ordered, of one bucket per group. A group without such rows has no cut.
    """
    counts = _bucket_counts(rows, groups, key, below) if counts is None else counts

    def passes(table: DataFrame, order: str, wanted: DataFrame) -> DataFrame:
        upto = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        ladder = _join(table.withColumn("__upto", F.sum("__n").over(upto)), wanted, groups)
        return ladder.where((F.col("__k") > F.col("__upto") - F.col("__n")) & (F.col("__k") <= F.col("__upto")))

    need = F.col("__k") - F.col("__upto") + F.col("__n")
    edge = materialize(passes(counts, "__b", quota).select(*groups, "__b", need.alias("__k")), "edge")
    # One row per group, written: the planner knows how small it is.
    inside = _join(rows.select(*groups, key), edge, groups).where(F.shiftright(key, below) == F.col("__b"))
    numbers = inside.groupBy(*groups, key).agg(F.count("*").alias("__n"))
    found = passes(numbers, key, edge.drop("__b"))
    return materialize(found.select(*groups, F.col(key).alias("__cut"), need.alias("__need"), "__n"), "cut")


def _first_rows(
    stored: DataFrame, values: list[str], groups: list[str], quota: DataFrame, counts: DataFrame | None = None
) -> DataFrame:
    """Mark with ``__first`` the ``__k`` lowest rows of each group, in the order of ``__h``.

    The last of them is found by counting, never by ranking rows: counts per bucket of the
    hash, then counts per hash inside one bucket. Rows with the hash of the last one that are too
    many, as where one key holds a third of all, are told apart by a hash of their ``values`` in
    the same way. Rows that agree in these too are interchangeable: as many as are wanted are taken
    partition by partition. What is joined to the rows has one row per group.
    """
    cut = _cut(stored, groups, "__h", _BELOW_BUCKET, quota, counts)
    names = {"__cut": "__c1", "__need": "__k1", "__n": "__n1"}
    cut = cut.withColumnsRenamed(names)
    at_cut, tied = F.col("__h") == F.col("__c1"), F.col("__k1") < F.col("__n1")
    first = F.col("__h") <= F.col("__c1")
    if not cut.where(tied).isEmpty():
        value = _number(F.md5(F.to_json(F.struct(*[f"`{c}`" for c in values]), {"ignoreNullFields": "false"})))
        rows = _join(stored, cut.where(tied), groups).where(at_cut).select(*groups, value.alias("__v"), "__at")
        rows = materialize(rows, "tied")
        by_value = _cut(rows, groups, "__v", _BELOW_BUCKET, cut.where(tied).select(*groups, F.col("__k1").alias("__k")))
        by_value = by_value.withColumnsRenamed({"__cut": "__c2", "__need": "__k2", "__n": "__n2"})
        alike = _join(rows, by_value, groups).where("__v = __c2").select(*groups, "__at")
        by_place = _cut(alike, groups, "__at", _BELOW_PARTITION, by_value.select(*groups, F.col("__k2").alias("__k")))
        by_place = by_place.select(*groups, F.col("__cut").alias("__c3"))
        cut = materialize(_join(_join(cut, by_value, groups, "left"), by_place, groups, "left"), "cuts")
        among = (value < F.col("__c2")) | ((value == F.col("__c2")) & (F.col("__at") <= F.col("__c3")))
        first = F.when(at_cut & tied, among).otherwise(first)
    return _join(stored, cut, groups, "left").withColumn("__first", F.coalesce(first, F.lit(False)))


def _quotas(sizes: DataFrame, strata: list[str], fraction: float) -> DataFrame:
    """Test rows per stratum (``__k``); ``sizes`` has one row per stratum."""
    total = sizes.agg(F.sum("__total").alias("n"))
    test = F.ceil(F.lit(float(fraction)) * F.col("__all"))
    shares = sizes.withColumn("__all", total.scalar()).withColumn("__share", test * F.col("__total") / F.col("__all"))
    if not strata:
        return shares.select(test.alias("__k"))
    # Exact ties in the remainder go to the larger stratum, then to the lower name.
    rest = F.round(F.col("__share") - F.floor("__share"), 9)
    floors = materialize(
        shares.select(*strata, test.alias("__test"), F.floor("__share").alias("__k"), (-rest).alias("__rest"), (-F.col("__total")).alias("__less")),
        "shares",
    )
    places = number_rows(floors, ["__rest", "__less", *strata], "__place")
    left = floors.agg((F.max("__test") - F.sum("__k")).alias("left"))
    bonus = (F.col("__place") <= left.scalar()).cast("bigint")
    return places.select(*strata, (F.col("__k") + bonus).alias("__k"))


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe join on shared columns; with no keys the right side is a single value row."""
    if keys:
        renamed = right.select([F.col(c).alias(f"__r_{c}" if c in keys else c) for c in right.columns])
        on = [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys]
        return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])
    return left.withColumns({c: right.select(c).scalar() for c in right.columns})


def sample_rows(
    df: DataFrame,
    key: str | list[str],
    rows: int = V.SAMPLE_ROWS,
    fraction: float = V.SAMPLE_FRACTION,
    seed: int = V.SEED,
) -> DataFrame:
    """``min(rows, floor(fraction * n))`` random rows: the lowest in hash order.

    Their last one is found as in an exact split, by counting, so that the sample never meets
    in one task, however large ``rows`` is.
    """
    stored = _with_order(df, C.hash_order(key, seed, "sample"))
    counts = _bucket_counts(stored, [], "__h", _BELOW_BUCKET)
    size = F.floor(F.sum("__n") * F.lit(float(fraction)))
    quota = counts.agg(F.least(F.lit(rows).cast("bigint"), size).alias("__k"))
    marked = _first_rows(stored, df.columns, [], materialize(quota, "quota"), counts)
    return marked.where("__first").select(*df.columns)


def sample_fraction(
    df: DataFrame, key: str | list[str], fraction: float = V.TRAIN_FRACTION, seed: int = V.SEED
) -> DataFrame:
    """About the given share of rows, by hash threshold."""
    return df.where(C.hash_below(C.hash_order(key, seed, "sample"), fraction))


def complement(df: DataFrame, part: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``part``."""
    keys = [key] if isinstance(key, str) else key
    return df.join(part.select(*keys), keys, "left_anti")


def split_report(whole: DataFrame, split: DataFrame) -> DataFrame:
    """Sizes of a split next to the input size, as one row."""
    n = whole.agg(F.count("*").alias("n"))
    return split.agg(
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
        F.count("*").alias("union_rows"),
    ).withColumn("input_rows", n.scalar())
