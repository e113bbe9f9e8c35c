"""Catalog tables of one schema: save, load, describe, maintain, with a load log."""

from __future__ import annotations

import logging
import uuid
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidecall.operators import cleaning, layout, lookup
from tidecall.session import materialize, skew_splitting
from tidecall.sources.commits import CommitLog
from tidecall.sources.paths import split_copies

log = logging.getLogger(__name__)

LOG_FOLDER = "_load_log"


class TableStore:
    """Parquet tables in one schema of the session catalog."""

    def __init__(self, spark: SparkSession, schema: str, location: str | None = None) -> None:
        self.spark = spark
        self.schema = schema
        self.location = location

    # --- names and catalog -----------------------------------------------------------

    def full_name(self, name: str) -> str:
        """Every part quoted on its own, so that dots separate and never belong to a name."""
        return ".".join(f"`{p}`" for p in [*self.schema.split("."), name])

    def ensure_schema(self) -> None:
        parts = ".".join(f"`{p}`" for p in self.schema.split("."))
        where = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {parts}{where}")

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.full_name(name))

    def list(self) -> list[str]:
        """Table names; a schema that cannot be read has none."""
        try:
            found = self.spark.catalog.listTables(self.schema)
        except AnalysisException as e:
            log.warning("cannot list %s: %s", self.schema, str(e).splitlines()[0])
            return []
        return sorted(t.name for t in found if not t.isTemporary)

    def drop(self, name: str, if_exists: bool = True) -> None:
        """Drop a table; only a strict drop of an absent table raises."""
        guard = "IF EXISTS " if if_exists else ""
        kind = "VIEW" if self.exists(name) and self._is_view(name) else "TABLE"
        self.spark.sql(f"DROP {kind} {guard}{self.full_name(name)}")

    def _is_view(self, name: str) -> bool:
        return self.spark.catalog.getTable(self.full_name(name)).tableType == "VIEW"

    # --- load and save -----------------------------------------------------------------

    def load(self, name: str) -> DataFrame:
        if not self.exists(name):
            raise ValueError(f"no table {self.full_name(name)}; the schema has {self.list()}")
        return self.spark.table(self.full_name(name))

    def save(
        self,
        df: DataFrame,
        name: str,
        mode: str = "overwrite",
        partition_by: list[str] | None = None,
        bucket_by: tuple[int, list[str]] | None = None,
        operation: str = "WRITE",
    ) -> None:
        """Write a table and note version, time and row count in the load log.

        Rows are counted while they are written. An overwrite may change the
        schema. ``bucket_by`` (number, columns) stores tables that are joined
        again and again so that :meth:`combine` needs no shuffle; it suits
        columns without hot values.
        """
        if mode == "ignore" and self.exists(name):
            return
        self._note(name, operation, self._write(df, name, mode, partition_by, bucket_by))

    def _write(self, df: DataFrame, name: str, mode: str, partition_by=None, bucket_by=None) -> int:
        """Write and return the row count. A table may be overwritten with a plan that reads it."""
        try:
            return self._write_once(df, name, mode, partition_by, bucket_by)
        except AnalysisException as e:
            if not (e.getCondition() or "").startswith("UNSUPPORTED_OVERWRITE"):
                raise
            return self._write_once(materialize(df, "overwrite"), name, mode, partition_by, bucket_by)

    def _write_once(self, df: DataFrame, name: str, mode: str, partition_by, bucket_by) -> int:
        seen = Observation(f"save-{uuid.uuid4().hex}")
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = counted.write.mode(mode).format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket_by:
            writer = writer.bucketBy(bucket_by[0], *bucket_by[1])
        writer.saveAsTable(self.full_name(name))
        return seen.get["rows"]

    def save_split(self, labelled: DataFrame) -> None:
        """Tables ``train_raw``, ``test_raw``, ``train_processed`` and ``test_processed``."""
        for (kind, subset), df in split_copies(labelled).items():
            self.save(df, f"{subset}_{kind}")

    def load_pair(self) -> tuple[DataFrame, DataFrame, str]:
        """Training and test table with the version of the training data."""
        train, test = self.load("train_processed"), self.load("test_processed")
        return train, test, self.version("train_processed")

    # --- feature tables ------------------------------------------------------------------

    def publish_features(
        self, df: DataFrame, name: str, key: list[str], description: str = "", buckets: int | None = None
    ) -> None:
        """Save a feature table after checking its key; replaces an older one.

        With ``buckets`` the rows are stored by their key, so that lookups do not shuffle them.

        The table is written once, under another name. It takes its own name when the
        check has passed, so the rows that were checked are the rows that are published.
        """
        fresh = f"{name}__new"
        rows = self._write(df, fresh, "overwrite", bucket_by=(buckets, key) if buckets else None)
        try:
            lookup.assert_key(self.load(fresh), key)
        except Exception:
            self.drop(fresh)
            raise
        self._replace(name, fresh)
        self._note(name, "PUBLISH", rows)
        if description:
            self._comment(name, description)

    def ml_ready(self, base: str, suffix: str = "_processed") -> DataFrame:
        """Copy with numeric label and double-typed numbers, saved as ``base + suffix``."""
        self.save(cleaning.ml_ready(self.load(base)), f"{base}{suffix}")
        return self.load(f"{base}{suffix}")

    def combine(self, output: str, sources: list[str], join_on: str) -> DataFrame:
        """Left-join the tables that exist and have the column to the first of them; save the result.

        The sources are stored tables, so every join reads a plain scan: small
        ones are broadcast by their known size, and hot keys are split.
        """
        frames = []
        for name in sources:
            if not self.exists(name):
                log.warning("left out %s: no such table", name)
            elif join_on not in (source := self.load(name)).columns:
                log.warning("left out %s: it has no column %s", name, join_on)
            else:
                frames.append(source)
        combined = lookup.combine(frames, join_on)
        with skew_splitting(self.spark):
            self.save(combined, output)
        return self.load(output)

    # --- description and history -------------------------------------------------------------

    def metadata(self, name: str) -> DataFrame:
        """Rows, columns, files, bytes, format, location and schema of a table, as one row."""
        df = self.load(name)
        details = {
            r.col_name: r.data_type
            for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.full_name(name)}").collect()
            if r.col_name in ("Provider", "Location")
        }
        files = (
            df.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
            .agg(F.count("*").alias("rows"))
            .agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("num_rows"),
                F.count("*").alias("num_files"),
                F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_bytes"),
            )
        )
        return files.select(
            F.lit(f"{self.schema}.{name}").alias("table_name"),
            "num_rows",
            F.lit(len(df.columns)).cast("bigint").alias("num_columns"),
            "num_files",
            "size_bytes",
            F.lit(details.get("Provider", "unknown")).alias("format"),
            F.lit(details.get("Location")).cast("string").alias("location"),
            F.lit(df.columns).alias("columns"),
            F.lit(df.schema.simpleString()).alias("schema"),
        )

    def history(self, name: str, limit: int = 10) -> DataFrame:
        """Load log of a table, newest first."""
        if not self.exists(name):
            raise ValueError(f"no table {self.full_name(name)}")
        return self._log().read(name, limit).orderBy(F.desc("version"))

    def version(self, name: str) -> str:
        """Newest version of a table as text, ``"0"`` if none was noted."""
        return str(self._log().newest(name))

    def _log(self) -> CommitLog:
        """The load log lies in the folder of the schema, beside its tables."""
        folder = self.spark.catalog.getDatabase(self.schema).locationUri
        return CommitLog(self.spark, f"{folder.rstrip('/')}/{LOG_FOLDER}")

    def _note(self, name: str, operation: str, rows: int) -> None:
        """One entry in the load log; it takes the version after the newest one of the table."""
        self._log().append(name, operation, rows)

    # --- maintenance -------------------------------------------------------------------------

    def clone(self, source: str, target: str, shallow: bool = False) -> None:
        """Copy a table, or with ``shallow`` make a view on it. The target must not exist."""
        df = self.load(source)
        if shallow:
            self.spark.sql(
                f"CREATE VIEW {self.full_name(target)} AS SELECT * FROM {self.full_name(source)}"
            )
        else:
            self.save(df, target, mode="error", operation="CLONE")

    def optimize(self, name: str, cluster_by: list[str] | None = None, files: int | None = None) -> None:
        """Rewrite a table into fewer, clustered files. Failures are logged, never raised.

        Partitions, buckets and comment stay as they are; inside a partition the rows are
        clustered. The new copy is complete before it takes the old name, and the old table
        gets its name back if that fails. A view has no files and is left alone.
        """
        if not self.exists(name):
            log.warning("nothing to optimize: no table %s", name)
            return
        if self._is_view(name):
            log.warning("nothing to optimize: %s is a view", name)
            return
        fresh = f"{name}__new"
        try:
            df = self.load(name)
            known = [c for c in cluster_by or [] if c in df.columns]
            if cluster_by and not known:
                log.warning("%s has none of the columns %s", name, cluster_by)
            columns = self.spark.catalog.listColumns(self.full_name(name))
            parts = [c.name for c in columns if c.isPartition]
            order = parts + [c for c in known if c not in parts] if known else []
            rows = self._write(layout.cluster(df, order, files), fresh, "overwrite", parts, self._buckets(name))
            if comment := self.spark.catalog.getTable(self.full_name(name)).description:
                self._comment(fresh, comment)
            self._replace(name, fresh)
            self._note(name, "OPTIMIZE", rows)
        except Exception as e:  # maintenance must not break a job that only reads the table
            log.error("optimize of %s failed: %s", name, e)
            self.drop(fresh)

    def _buckets(self, name: str) -> tuple[int, list[str]] | None:
        found = {
            r.col_name: r.data_type
            for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.full_name(name)}").collect()
        }
        columns = [c.name for c in self.spark.catalog.listColumns(self.full_name(name)) if c.isBucket]
        return (int(found["Num Buckets"]), columns) if columns else None

    def _comment(self, name: str, text: str) -> None:
        quoted = text.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"COMMENT ON TABLE {self.full_name(name)} IS '{quoted}'")

    def _replace(self, name: str, fresh: str) -> None:
        """Give ``fresh`` the name of an older table, which keeps it if that fails."""
        old = f"{name}__old"
        self.drop(old)
        had = self.exists(name)
        if had:
            self._rename(name, old)
        try:
            self._rename(fresh, name)
        except Exception:
            if had:
                self._rename(old, name)
            raise
        self.drop(old)

    def _rename(self, name: str, to: str) -> None:
        """Rename a table; its partitions follow the folder, which the catalog leaves to the caller."""
        self.spark.sql(f"ALTER TABLE {self.full_name(name)} RENAME TO {self.full_name(to)}")
        columns = self.spark.catalog.listColumns(self.full_name(to))
        if not any(c.isPartition for c in columns):
            return
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.full_name(to)}").collect()
        folder = next(r.data_type for r in described if r.col_name == "Location").rstrip("/")
        for row in self.spark.sql(f"SHOW PARTITIONS {self.full_name(to)}").collect():
            parts = [p.split("=", 1) for p in row.partition.split("/")]
            spec = ", ".join(f"`{k}` = {_partition_value(v)}" for k, v in parts)
            path = f"{folder}/{row.partition}".replace("'", "\\'")
            self.spark.sql(f"ALTER TABLE {self.full_name(to)} PARTITION ({spec}) SET LOCATION '{path}'")
        self.spark.catalog.refreshTable(self.full_name(to))


def _partition_value(shown: str) -> str:
    """A value as SHOW PARTITIONS writes it, as a SQL literal."""
    if shown in ("__HIVE_DEFAULT_PARTITION__", "null"):
        return "null"
    return "'" + unquote(shown).replace("\\", "\\\\").replace("'", "\\'") + "'"
