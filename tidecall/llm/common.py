"""Helpers that several operators share: scratch tables, row keys, ASCII words."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecall.session import scratch_path

#: White space that separates words, as a character class for regular expressions.
WORD_BREAK = r"[\x20\x09-\x0D]"


class Scratch:
    """Intermediate Parquet tables below ``spark.checkpoint.dir``.

    Writing cuts the lineage, and a lost executor costs no more than the step that runs.
    ``drop`` removes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)
        self.count = 0

    def write(self, df: DataFrame, label: str) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{label}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        for table in tables:
            if table is not None:
                jvm = self.spark._jvm
                path = jvm.org.apache.hadoop.fs.Path(table._scratch)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def row_key(row_id: Column, text: Column) -> Column:
    """Text that is equal for rows with equal id and text only (up to MD5), nulls included."""
    id_part = F.coalesce(row_id.cast("string"), F.lit("-"))
    text_part = F.coalesce(F.md5(text.cast("binary")), F.lit("-"))
    return F.coalesce(F.md5(F.concat_ws(" ", id_part, text_part).cast("binary")), F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- batches of texts inside a task ------------------------------------------------------


def ascii_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, cut at ASCII white space, and the place of each text's first one (with the end)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten()
    filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(filled)])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    return words.filter(pa.array(filled)), offsets


def slices_of_bytes(batch: pa.RecordBatch, column: str, most: int, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``rows`` rows and about ``most`` bytes of a text column, of one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(sizes):
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))
        stop = min(max(stop, at + 1), at + rows)
        yield batch.slice(at, stop - at)
        at = stop
