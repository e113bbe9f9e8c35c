"""File scans, guarded scans and ordered fallbacks."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

log = logging.getLogger(__name__)

Reader = Callable[[], DataFrame]


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, mode: str = "PERMISSIVE"
) -> DataFrame:
    """CSV with a header. Without a schema Spark infers one, at the price of a pass over the text."""
    reader = spark.read.option("header", True).option("mode", mode)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header that reads back unchanged, blanks around text included."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_path(spark: SparkSession, path: str) -> DataFrame:
    """A columnar directory."""
    return spark.read.parquet(path)


def read_if_present(reader: Reader, what: str) -> DataFrame | None:
    """The scan, or ``None`` with a log line when its path does not exist."""
    try:
        return reader()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log.error("%s not found", what)
        return None


def first_available(readers: list[Reader]) -> DataFrame:
    """The first reader that yields a plan; ``RuntimeError`` when none does."""
    last: Exception | None = None
    for reader in readers:
        try:
            return reader()
        except (AnalysisException, ValueError) as e:
            log.warning("source not available: %s", str(e).splitlines()[0])
            last = e
    raise RuntimeError("none of the sources is available") from last
