"""Cleaning and feature derivation of new contact files as a stream.

Both steps are projections without state, so the batch functions apply as they
are; the checkpoint of the stream makes every file count exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidecall.operators import cleaning, features


def read_new_files(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """CSV files with a header that appear below ``path``."""
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
    )


def cleaned_features(stream: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return features.engineer_features(cleaning.clean(stream, keep=keep))


def append_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process all files present now, append to Parquet below ``path``, and stop."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
