"""Row-level changes between two snapshots of a keyed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecall.session import materialize


def _digest(cols: list[str]) -> Column:
    return F.md5(F.to_json(F.struct(*[f"`{c}`" for c in cols]), {"ignoreNullFields": "false"}))


def changed_keys(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """``__k``: the keys of one snapshot only and those whose rows have different digests.

    Only keys and digests are shuffled.
    """
    cols = before.columns
    old = before.select(F.struct(*key).alias("__k_old"), _digest(cols).alias("__d_old"))
    new = after.select(F.struct(*key).alias("__k_new"), _digest(cols).alias("__d_new"))
    joined = old.join(new, F.col("__k_old").eqNullSafe(F.col("__k_new")), "full_outer")
    return joined.where(~F.col("__d_old").eqNullSafe(F.col("__d_new"))).select(
        F.coalesce("__k_old", "__k_new").alias("__k")
    )


def snapshot_diff(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Inserts, deletes and both images of updates, marked in ``_change_type``.

    Both snapshots have the same columns, in any order, else a ``ValueError`` names the
    difference; ``key`` identifies a row. Two steps: keys and digests of all rows are
    compared and the keys that changed are written, then whole rows of these keys alone are
    fetched and compared by value, so that what only looks different is no change. Unchanged
    rows are never shuffled whole. Rows count as equal if their MD5 is.
    """
    cols = before.columns
    if differing := sorted(set(cols) ^ set(after.columns)):
        raise ValueError(f"columns of one snapshot only: {', '.join(differing)}")
    after = after.select(*[f"`{c}`" for c in cols])
    # Written, so that the planner knows whether the changed keys are few enough to broadcast.
    keys = materialize(changed_keys(before, after, key), "changed")
    old, new = (
        side.select(F.struct(*key).alias(f"__k_{name}"), F.struct(*cols).alias(f"__{name}"))
        .join(keys, F.col(f"__k_{name}").eqNullSafe(F.col("__k")), "left_semi")
        for side, name in ((before, "old"), (after, "new"))
    )
    joined = old.join(new, F.col("__k_old").eqNullSafe(F.col("__k_new")), "full_outer")
    changed = joined.where(~F.col("__old").eqNullSafe(F.col("__new")))

    def image(kind: str, source: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(source).alias("row"))

    rows = (
        F.when(F.col("__k_old").isNull(), F.array(image("insert", "__new")))
        .when(F.col("__k_new").isNull(), F.array(image("delete", "__old")))
        .otherwise(F.array(image("update_preimage", "__old"), image("update_postimage", "__new")))
    )
    return changed.select(F.explode(rows).alias("c")).select("c._change_type", "c.row.*")
