"""Session set-up and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidecall", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library relies on; a cluster may override all of them."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def skew_splitting(spark: SparkSession) -> Iterator[None]:
    """Let adaptive execution split hot keys in every join of a chain on one key.

    By default it leaves a join alone when splitting would make the next join
    shuffle again, and a hot key then stays in one task all along the chain.
    """
    name = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scratch_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidecall-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`scratch_dir`."""
    return f"{scratch_dir(spark)}/tidecall/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "step", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back, so that several passes share one computation.

    Unlike a cache the written table survives lost executors, and unlike a raw
    checkpoint later passes read only the columns they use, and only the partitions
    (``partition_by``) that they ask for.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*partition_by or []).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
