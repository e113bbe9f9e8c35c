"""K-means on integer vectors, with an equal-average equal-variance search for the nearest centroid.

With sums ``S`` of components and ``W = D * |x|^2 - S^2`` (the variance, scaled), the squared
distance of vector ``x`` and centroid ``c`` in ``D`` dimensions is bounded from below:

    D * dist >= (Sx - Sc)^2 + (sqrt(Wx) - sqrt(Wc))^2

Centroids stand in the order of their means. From the place of a vector's mean the search goes
outward to both sides, the nearer mean first. The first term alone ends a side, both together
reject a centroid, and what is left is compared by its exact integer distance.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecall.llm.common import Scratch, unused

#: Integers below this size have squared distances that fit 64 bits, in up to 256 dimensions.
SMALL = 1 << 26
MAX_LONG = (1 << 63) - 1
#: Part of a float bound that may be rounding; a centroid is rejected only beyond it.
SLACK = 1e-9
ROWS_AT_ONCE = 4096
#: Partial sums of one cluster are added in so many tasks before they meet in one.
FAN_IN = 64


def to_integers(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``, exact; Python integers where 64 bits might not do."""
    values = values.astype(np.float64)
    limit = SMALL / scale
    if not len(values) or np.abs(values).max() < limit:
        return np.floor(values * scale).astype(np.int64)
    whole = [[math.floor(x * scale) if abs(x) < 2.0**52 else int(x) * scale for x in row] for row in values.tolist()]
    return np.array(whole, dtype=object)


class Centroids:
    """Centroids in the order of their means, ready for the search."""

    def __init__(self, vectors: list[list[int]]):
        self.dims = len(vectors[0]) if vectors else 0
        order = sorted(range(len(vectors)), key=lambda i: (sum(vectors[i]), i))
        self.number = np.array(order, dtype=np.int64)
        self.vectors = [vectors[i] for i in order]
        self.small = all(abs(x) < SMALL for v in self.vectors for x in v)
        self.sums = [sum(v) for v in self.vectors]
        self.spreads = [self.dims * sum(x * x for x in v) - s * s for v, s in zip(self.vectors, self.sums)]
        if self.small:
            self.matrix = np.array(self.vectors, dtype=np.int64).reshape(len(vectors), self.dims)
            self.means = np.array(self.sums, dtype=np.float64)
            self.deviations = np.sqrt(np.array(self.spreads, dtype=np.float64))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (ties: the smaller) and the squared distance of each row."""
        if vectors.dtype != object and self.small:
            return self._nearest_small(vectors)
        found = [self._nearest_exact([int(x) for x in v]) for v in vectors]
        return np.array([f[0] for f in found], dtype=np.int64), np.array([f[1] for f in found], dtype=object)

    def _nearest_small(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k, dims = len(x), len(self.number), self.dims
        sums = x.sum(axis=1)
        means = sums.astype(np.float64)
        centred = x - (means / dims)[:, None]
        deviations = np.sqrt(dims * np.einsum("ij,ij->i", centred, centred))
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, np.iinfo(np.int64).max)
        right = np.searchsorted(self.means, means)
        left = right - 1
        rows = np.arange(n)
        padded = np.concatenate([[-np.inf], self.means, [np.inf]])
        while len(rows):
            mean = means[rows]
            to_left, to_right = mean - padded[left[rows] + 1], padded[right[rows] + 1] - mean
            go_left = to_left <= to_right
            gap = np.where(go_left, to_left, to_right)
            at = np.where(go_left, left[rows], right[rows])
            # The nearer side is beyond the bound, so that both sides are.
            bound = best[rows].astype(np.float64) * dims
            slack = SLACK * (bound + (np.abs(mean) + deviations[rows]) ** 2 + 1)
            alive = (gap < np.inf) & (gap**2 <= bound + slack)
            rows, at, go_left, gap, bound, slack = (a[alive] for a in (rows, at, go_left, gap, bound, slack))
            left[rows] -= go_left
            right[rows] += ~go_left
            close = gap**2 + (deviations[rows] - self.deviations[at]) ** 2 <= bound + slack + SLACK * self.deviations[at] ** 2
            some, at = rows[close], at[close]
            apart = x[some] - self.matrix[at]
            distance = np.einsum("ij,ij->i", apart, apart)
            name = self.number[at]
            better = (distance < best[some]) | ((distance == best[some]) & (name < number[some]))
            best[some[better]] = distance[better]
            number[some[better]] = name[better]
        return number, best

    def _nearest_exact(self, x: list[int]) -> tuple[int, int]:
        """The same search for integers of any size."""
        total = sum(x)
        spread = math.isqrt(self.dims * sum(v * v for v in x) - total * total)
        order = sorted(range(len(self.sums)), key=lambda i: abs(total - self.sums[i]))
        best: tuple[int, int] | None = None
        for i in order:
            gap = (total - self.sums[i]) ** 2
            if best and gap > self.dims * best[0]:
                break
            # Roots are rounded down, so that their difference may be one too large.
            apart = max(0, abs(spread - math.isqrt(self.spreads[i])) - 1)
            if best and gap + apart * apart > self.dims * best[0]:
                continue
            here = (sum((a - b) ** 2 for a, b in zip(x, self.vectors[i])), int(self.number[i]))
            best = here if best is None else min(best, here)
        return best[1], best[0]


def _rows(batch: pa.RecordBatch, column: str, dims: int) -> np.ndarray:
    vectors = batch.column(column)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), dims)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _add(parts: DataFrame, by: list[str]) -> DataFrame:
    """Counts and component sums added up; sums travel as text since they may be of any size."""
    schema = ", ".join([f"{c} int" for c in by] + ["n bigint", "sums array<string>"])

    def add(keys: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            n += sum(batch.column("n").to_pylist())
            for row in batch.column("sums").to_pylist():
                sums = [a + int(b) for a, b in zip(sums, row)] if sums else [int(b) for b in row]
        out = [pa.array([k.as_py()], pa.int32()) for k in keys]
        out += [pa.array([n], pa.int64()), pa.array([[str(s) for s in sums]], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(out, [*by, "n", "sums"])

    return parts.groupBy(*by).applyInArrow(add, schema)


def _cluster_sums(kept: DataFrame, centroids: Centroids, scale: int) -> DataFrame:
    """``cluster, n, sums`` of the vectors nearest to each centroid, a row per cluster."""
    dims = centroids.dims

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for batch in _batches(batches):
            x = to_integers(_rows(batch, "vector", dims), scale)
            number, _ = centroids.nearest(x)
            for c in np.unique(number).tolist():
                part = [int(v) for v in x[number == c].sum(axis=0)]
                counts[c] = counts.get(c, 0) + int((number == c).sum())
                sums[c] = [a + b for a, b in zip(sums[c], part)] if c in sums else part
        if counts:
            names = sorted(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int32()),
                    pa.array([counts[c] for c in names], pa.int64()),
                    pa.array([[str(s) for s in sums[c]] for c in names], pa.list_(pa.string())),
                ],
                ["cluster", "n", "sums"],
            )

    # One row for each task and cluster.
    parts = kept.select("vector").mapInArrow(assign, "cluster int, n bigint, sums array<string>")
    dealt = parts.withColumn("lane", (F.spark_partition_id() % FAN_IN).cast("int"))
    return _add(_add(dealt, ["cluster", "lane"]).drop("lane"), ["cluster"])


def _assigned(kept: DataFrame, centroids: Centroids, scale: int) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector; a distance beyond 64 bits is null."""
    dims = centroids.dims

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            number, distance = centroids.nearest(to_integers(_rows(batch, "vector", dims), scale))
            fits = [int(d) if d <= MAX_LONG else None for d in distance.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(fits, pa.int64())],
                ["vec_id", "cluster", "distance"],
            )

    id_type = kept.schema["vec_id"].dataType.simpleString()
    return kept.select("vec_id", "vector").mapInArrow(assign, f"vec_id {id_type}, cluster int, distance bigint")


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Exact k-means of vectors turned into integers ``floor(scale * x)``.

    Vectors that are null, have another number of components than ``dims``, or hold a null or
    a non-finite component are left out. The first centroids are the vectors with the smallest
    SHA-256 of ``<seed>:<id>`` (a null id counts as an empty one; ids that repeat go by their
    components). Each round assigns every vector to its nearest centroid and moves every centroid
    that has vectors to the floor of their mean, component by component; after ``rounds`` of them the
    vectors are assigned once more. Ties go to the centroid with the smaller number. Fewer
    vectors than clusters give fewer centroids, no vectors no rows. Rows that repeat count
    each. Integers of any size are exact; a distance or an inertia that does not fit a long is null.

    A round reads the vectors once. It shuffles one row of sums for each task and cluster;
    the driver sees the centroids alone.

    Returns ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.
    """
    scratch = Scratch(vectors.sparkSession, "centroids")
    vector = vectors[vector_col].cast("array<double>") if _wide(vectors, vector_col) else vectors[vector_col]
    whole = (F.size(vector) == dims) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    kept = scratch.write(
        vectors.select(vectors[id_col].alias("vec_id"), vector.alias("vector")).where(F.coalesce(whole, F.lit(False))),
        "kept",
    )
    order = unused(kept, "order")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = kept.withColumn(order, F.sha2(named, 256)).orderBy(order, "vector").limit(clusters).collect()
    start = to_integers(np.array([r["vector"] for r in first], dtype=np.float64).reshape(-1, dims), scale)
    centroids = [[int(x) for x in row] for row in start]
    if not centroids:
        empty = F.lit(None)
        return kept.select(
            "vec_id",
            empty.cast("int").alias("cluster"),
            *[empty.cast("bigint").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            empty.cast("string").alias("centroid_sha256"),
        )
    for _ in range(rounds):
        before = [list(c) for c in centroids]
        for row in _cluster_sums(kept, Centroids(centroids), scale).collect():  # one row per cluster
            centroids[row["cluster"]] = [int(s) // row["n"] for s in row["sums"]]
        if centroids == before:  # all later rounds would be alike
            break
    found = scratch.write(_assigned(kept, Centroids(centroids), scale), "found")
    total = F.sum(F.col("distance").cast("decimal(20,0)")).alias("inertia")
    unknown = F.count_if(F.col("distance").isNull()).alias("unknown")
    sums = {r["cluster"]: r for r in found.groupBy("cluster").agg(total, unknown).collect()}  # one row per cluster

    def fits(rows: list) -> int | None:
        inertia = None if any(r["unknown"] for r in rows) else sum(int(r["inertia"]) for r in rows)
        return inertia if inertia is not None and inertia <= MAX_LONG else None

    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    by_number = [fits([sums[i]]) if i in sums else None for i in range(len(centroids))]
    inertias = F.array(*[F.lit(x).cast("bigint") for x in by_number])
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(inertias, F.col("cluster")).alias("cluster_inertia"),
        F.lit(fits(list(sums.values()))).cast("bigint").alias("inertia"),
        F.get(F.array(*map(F.lit, digests)), F.col("cluster")).alias("centroid_sha256"),
    )


def _wide(df: DataFrame, column: str) -> bool:
    """Vectors of another element type than float or double go as doubles."""
    return df.schema[column].dataType.simpleString() not in ("array<float>", "array<double>")
