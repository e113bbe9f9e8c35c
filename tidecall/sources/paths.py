"""Directory layout of stored datasets and the split writer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecall import fixed_values as V
from tidecall.operators.cleaning import decode_label


@dataclass(frozen=True)
class DatasetPaths:
    """``root/kind`` or ``root/kind/subset``, such as ``root/processed/train``."""

    root: str

    def path(self, kind: str, subset: str | None = None) -> str:
        base = f"{self.root.rstrip('/')}/{kind}"
        return f"{base}/{subset}" if subset else base


def with_load_time(df: DataFrame) -> DataFrame:
    return df.withColumn(V.LOAD_TIME_COLUMN, F.current_timestamp())


def split_copies(labelled: DataFrame, label: str = V.LABEL_COLUMN) -> dict[tuple[str, str], DataFrame]:
    """The four stored copies of a split table, by (kind, subset).

    ``processed`` holds the numeric label; ``raw`` is the audit copy of the same
    cleaned rows with the label as a word. Both carry their load time.
    """
    copies = {}
    for subset in ("train", "test"):
        side = with_load_time(labelled.where(F.col("split") == subset).drop("split"))
        copies["raw", subset] = decode_label(side, label)
        copies["processed", subset] = side
    return copies


def save_split_paths(labelled: DataFrame, paths: DatasetPaths) -> None:
    """Write the four copies below ``paths``; an overwrite may change the schema."""
    for (kind, subset), df in split_copies(labelled).items():
        df.write.mode("overwrite").parquet(paths.path(kind, subset))
