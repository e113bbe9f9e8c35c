"""Run-log tables: append, search, series, nested runs, input records."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecall import fixed_values as V
from tidecall import schema as S
from tidecall.functions import columns as C
from tidecall.functions.ordered import ROWS_PER_RANGE, with_history

TABLES = {
    "runs": S.RUNS,
    "params": S.RUN_PARAMS,
    "tags": S.RUN_TAGS,
    "metrics": S.RUN_METRICS,
    "inputs": S.RUN_INPUTS,
}


@dataclass(frozen=True)
class RunLog:
    """Append-only run tables below one folder."""

    spark: SparkSession
    root: str

    def append(self, table: str, rows: DataFrame) -> None:
        cols = [F.col(f.name).cast(f.dataType) for f in TABLES[table].fields]
        rows.select(*cols).write.mode("append").parquet(f"{self.root}/{table}")

    def read(self, table: str) -> DataFrame:
        try:
            return self.spark.read.schema(TABLES[table]).parquet(f"{self.root}/{table}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], TABLES[table])

    def _append_few(self, table: str, rows: list[tuple], schema: str | T.StructType | None = None) -> None:
        """Rows that the driver holds, as one file."""
        few = self.spark.createDataFrame(rows, schema or TABLES[table]).coalesce(1)
        if "ts" in TABLES[table].fieldNames() and "ts" not in few.columns:
            few = few.withColumn("ts", F.current_timestamp())
        self.append(table, few)

    def start(self, run_id: str, name: str, start_ms: int, parent: str | None = None, status: str = "FINISHED") -> None:
        row = [(run_id, parent, name, status, start_ms)]
        self._append_few("runs", row)

    def log_params(self, run_id: str, params: dict) -> None:
        self._log_text("params", run_id, params)

    def log_tags(self, run_id: str, tags: dict) -> None:
        self._log_text("tags", run_id, tags)

    def log_metrics(self, run_id: str, metrics: dict[str, float], step: int = 0) -> None:
        rows = [(run_id, k, float(v), step) for k, v in metrics.items()]
        self._append_few("metrics", rows, "run_id string, key string, value double, step long")

    def log_input(self, run_id: str, record: dict[str, str]) -> None:
        row = [tuple(record.get(f.name) if f.name != "run_id" else run_id for f in S.RUN_INPUTS.fields)]
        self._append_few("inputs", row)

    def _log_text(self, table: str, run_id: str, values: dict) -> None:
        rows = [(run_id, k, str(v)) for k, v in values.items()]
        self._append_few(table, rows)


# --- reading back --------------------------------------------------------------------------


def last_values(metrics: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Newest value per run and key."""
    order = order or ["step", "ts"]
    return metrics.groupBy("run_id", "key").agg(F.max_by("value", F.struct(*order)).alias("value"))


def value_maps(values: DataFrame, name: str = "metrics", max_keys: int = 10_000) -> DataFrame:
    """One map of key to value per run; ``values`` has one row per run and key.

    A map is one value in one row: a run with more than ``max_keys`` keys raises an error
    rather than fill a task's memory; its values stay readable as rows.
    """
    sizes = values.groupBy("run_id").agg(F.count("*").alias("n")).where(F.col("n") > max_keys)
    if found := sizes.limit(3).collect():
        raise ValueError(f"more than {max_keys} keys for {[r.run_id for r in found]}; read them as rows")
    entries = F.map_from_entries(F.collect_list(F.struct("key", "value")))
    return values.groupBy("run_id").agg(entries.alias(name))


def spread(values: DataFrame, keys: list[str], prefix: str = "", existing_only: bool = True) -> DataFrame:
    """One row per run and one column per key; keys that never occur are left out."""
    if existing_only:
        seen = values.where(F.col("key").isin(keys)).select("key").distinct()
        found = {r.key for r in seen.collect()}  # at most len(keys) rows
        keys = [k for k in keys if k in found]
    wide = values.where(F.col("key").isin(keys)).groupBy("run_id").pivot("key", keys).agg(F.max("value"))
    return wide.withColumnsRenamed({k: f"{prefix}{k}" for k in keys})


def search_runs(
    runs: DataFrame,
    metrics: DataFrame,
    params: DataFrame | None = None,
    status: str = "FINISHED",
    after_ms: int | None = None,
    name_like: str | None = None,
    metric_keys: tuple[str, ...] = (),
    param_keys: tuple[str, ...] = (),
) -> DataFrame:
    """Matching runs newest first, with the requested metrics and params that exist as columns.

    ``metrics`` and ``params`` have one row per run and key.
    """
    found = runs.where(F.col("status") == status)
    if after_ms is not None:
        found = found.where(F.col("start_time") > after_ms)
    if name_like is not None:
        found = found.where(F.col("run_name").like(name_like))
    if metric_keys:
        found = found.join(spread(metrics, list(metric_keys), "metrics_"), "run_id", "left")
    if params is not None and param_keys:
        found = found.join(spread(params, list(param_keys), "params_"), "run_id", "left")
    return found.withColumn("start_time", C.epoch_millis("start_time")).orderBy(F.desc("start_time"), "run_id")


def largest(df: DataFrame, column: str, n: int, tie: str = "run_id") -> DataFrame:
    """The ``n`` rows with the largest values, nulls last."""
    return df.orderBy(F.desc_nulls_last(column), tie).limit(n)


def latest(runs: DataFrame) -> DataFrame:
    """The newest run."""
    return runs.orderBy(F.desc("start_time"), "run_id").limit(1)


def newest_version(versions: DataFrame, column: str = "version") -> DataFrame:
    """Largest version number; versions are text and compare as numbers."""
    return versions.agg(F.max(F.col(column).cast("int")).alias("version"))


def time_chunks(df: DataFrame, ts: str, row_id: str | None = None) -> list[Column]:
    """Day, hour, minute, second and instant of a timestamp, and parts of the id of 65,536 numbers, coarse to fine.

    A time without zone is taken as it stands, in whatever zone the session is.
    """
    if df.schema[ts].dataType == T.TimestampNTZType():
        within = F.hour(ts) * 3600 + F.minute(ts) * 60
        second = (F.date_part(F.lit("SECOND"), F.col(ts)) * 1_000_000).cast("bigint")
        micros = F.unix_date(F.to_date(ts)) * F.lit(86_400_000_000) + within * F.lit(1_000_000).cast("bigint") + second
    else:
        micros = F.unix_micros(ts)
    chunks = [F.floor(micros / (seconds * 1_000_000)) for seconds in (86_400, 3_600, 60, 1)]
    return chunks + [micros] + ([F.shiftright(F.col(row_id), 16)] if row_id else [])


def step_series(
    metrics: DataFrame, chunk: Column | list[Column], order: list[str], rows_per_chunk: int = ROWS_PER_RANGE
) -> DataFrame:
    """Number and change to the previous value for each metric of each run.

    ``chunk`` follows ``order`` (for example :func:`time_chunks`), so that a long series is
    spread over tasks, also where it is all of one day or of one minute.
    """
    steps = with_history(
        metrics, ["run_id", "key"], chunk, order, {"previous": "value"}, "__n", rows_per_chunk
    )
    return steps.withColumns(
        {"step": (F.col("__n") - 1).cast("bigint"), "delta": F.col("value") - F.col("previous")}
    ).drop("__n", "previous")


# --- nested runs ---------------------------------------------------------------------------


def parameter_grid(grid: dict[str, list] | None = None) -> list[dict]:
    """All parameter combinations, the last list varying fastest."""
    grid = grid or V.GRID
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def child_runs(parents: DataFrame, grid: list[dict], scores: list[Column]) -> DataFrame:
    """One child run per parent and combination; ``scores[i]`` is that of ``grid[i]``."""
    children = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"),
                *[F.lit(v).alias(k) for k, v in combination.items()],
                score.alias("score"),
            )
            for i, (combination, score) in enumerate(zip(grid, scores))
        ]
    )
    return parents.withColumn("c", F.explode(children)).select(
        F.concat_ws("-", "run_id", F.col("c.ordinal").cast("string")).alias("run_id"),
        F.col("run_id").alias("parent_run_id"),
        "c.*",
    )


def best_child(parents: DataFrame, children: DataFrame, params: list[str]) -> DataFrame:
    """Parents with their best child's score and parameters; the earliest wins a tie."""
    rank = F.struct(F.col("score"), -F.col("ordinal"))
    best = children.groupBy("parent_run_id").agg(
        F.max("score").alias("best_score"), F.max_by(F.struct(*params), rank).alias("__best")
    )
    joined = parents.join(best, parents["run_id"] == best["parent_run_id"], "left").drop("parent_run_id")
    return joined.select(*parents.columns, "best_score", *[F.col(f"__best.{p}").alias(f"best_{p}") for p in params])


# --- input records ---------------------------------------------------------------------------


def content_digest(df: DataFrame) -> DataFrame:
    """Digest of all rows that does not depend on their order, as one row of text.

    Rows are hashed one by one and the hashes summed, so equal tables have equal
    digests however they are partitioned.
    """
    part = F.conv(F.substring(C.row_digest(sorted(df.columns)), 1, 15), 16, 10).cast(T.DecimalType(38, 0))
    return df.agg(F.coalesce(F.sum(part), F.lit(0).cast(T.DecimalType(38, 0))).cast("string").alias("digest"))


def input_record(
    df: DataFrame, run_id: str, table_name: str, version: str, context: str, source_uri: str = ""
) -> DataFrame:
    """The record of a training input: table, version, digest and context."""
    return content_digest(df).select(
        F.lit(run_id).alias("run_id"),
        F.lit(table_name).alias("name"),
        "digest",
        F.lit("table").alias("source_type"),
        F.lit(source_uri or table_name).alias("source_uri"),
        F.lit(table_name).alias("source_name"),
        F.lit(table_name).alias("table_name"),
        F.lit(version).alias("version"),
        F.lit(context).alias("context"),
    )


def read_input(inputs: DataFrame, run_ids: DataFrame) -> DataFrame:
    """Input record of each requested run, or an ``error`` text where there is none."""
    found = run_ids.join(inputs, "run_id", "left")
    filled = {
        "source_uri": F.coalesce("source_uri", F.lit(V.UNKNOWN_URI)),
        "source_name": F.coalesce("source_name", F.lit(V.UNKNOWN_NAME)),
    }
    return found.withColumns({"error": F.when(F.col("name").isNull(), V.NO_INPUT)} | filled)
