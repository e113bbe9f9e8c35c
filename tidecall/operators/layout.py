"""File layout: compaction, and clustering by one or several columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cluster(df: DataFrame, cols: list[str], files: int | None = None) -> DataFrame:
    """Rows placed so that a file covers a narrow range of the clustering columns, in their order.

    The ranges are cut on whole values of the columns, whatever their type.
    """
    if not cols:
        return df.repartition(files) if files else df.hint("rebalance")
    by = [F.col(f"`{c}`") for c in cols]
    placed = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    return placed.sortWithinPartitions(*by)
