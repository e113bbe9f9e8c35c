"""Exact ordered computations that never put one key or the whole table in one task.

A window over a hot key, or over the whole table, sorts all of its rows in a
single task. The functions here cut the order into bounded chunks, work inside
each chunk, and carry only one summary row per chunk across chunk borders. The
number of chunks follows the number of rows.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecall.session import materialize

#: Rows that one task orders.
ROWS_PER_RANGE = 200_000
#: Bits of ``monotonically_increasing_id`` that count the rows of a partition.
_ROW_BITS = 33


def _never_null(df: DataFrame, keys: list[str]) -> dict[str, Column]:
    """Two non-null columns per key that together tell null from every value.

    Windows, aggregates and joins on them agree about their partitioning, which a
    null-safe join condition on the keys themselves would not.
    """
    out = {}
    for i, k in enumerate(keys):
        kind, col = df.schema[k].dataType, F.col(f"`{k}`")
        if isinstance(kind, T.NumericType):
            value = F.coalesce(col, F.lit(0).cast(kind))
        else:
            value = F.coalesce(col.cast("string"), F.lit(""))
        out |= {f"__k{i}": value, f"__null{i}": col.isNull()}
    return out


def with_history(
    df: DataFrame,
    keys: list[str],
    chunk: Column | list[Column],
    order: list[str],
    lags: dict[str, str] | None = None,
    number: str | None = None,
    rows_per_chunk: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Row number and previous values per key, safe for keys with very many rows.

    ``chunk`` must not decrease along ``order`` (for example the day of a
    timestamp): one task then holds one key's rows of one chunk, and the rows
    per key that meet in a second window are one per chunk. A list of chunks, coarse to fine
    (day, hour, minute, part of an id), is used as far as it is needed: a chunk of
    more than ``rows_per_chunk`` rows is cut by the next column, the others stay whole. Rows are
    counted for that when this is called, and only over-full chunks are counted again.
    ``lags`` maps new columns to the column whose previous value they hold; ``number`` names
    a 1-based position.
    """
    lags = lags or {}
    levels = chunk if isinstance(chunk, list) else [chunk]
    carried = sorted(set(lags.values()))
    helpers = _never_null(df, keys)
    group = list(helpers)
    base = df.withColumns(helpers | {"__chunk0": levels[0]})
    chunks = ["__chunk0"]
    for i, level in enumerate(levels[1:], 1):
        sizes = base.groupBy(*group, *chunks).agg(F.count("*").alias("__rows"))
        over = materialize(sizes.where(F.col("__rows") > rows_per_chunk).drop("__rows").withColumn("__over", F.lit(True)), "overfull")
        if over.isEmpty():
            break
        finer = F.when(F.col("__over"), level.cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        base = base.join(over, [*group, *chunks], "left").withColumn(f"__chunk{i}", finer).drop("__over")
        base = materialize(base, "chunked")
        chunks.append(f"__chunk{i}")
    within = Window.partitionBy(*group, *chunks).orderBy(*order)
    local = base.withColumns(
        {"__pos": F.row_number().over(within)}
        | {f"__lag_{c}": F.lag(c).over(within) for c in carried}
    )

    summary = base.groupBy(*group, *chunks).agg(
        F.count("*").alias("__rows"),
        F.max_by(F.struct(*carried, F.lit(1).alias("__one")), F.struct(*order)).alias("__tail"),
    )
    across = Window.partitionBy(*group).orderBy(*chunks)
    before = F.sum("__rows").over(across.rowsBetween(Window.unboundedPreceding, -1))
    heads = summary.select(
        *group,
        *chunks,
        F.coalesce(before, F.lit(0)).alias("__before"),
        F.lag("__tail").over(across).alias("__prev"),
    )

    joined = local.join(heads, [*group, *chunks])
    out = {}
    if number:
        out[number] = F.col("__before") + F.col("__pos")
    first = F.col("__pos") == 1
    for name, source in lags.items():
        out[name] = F.when(first, F.col(f"__prev.{source}")).otherwise(F.col(f"__lag_{source}"))
    return joined.select(*df.columns, *[c.alias(n) for n, c in out.items()])


def _range_of(at: str) -> Column:
    """The partition in which a row got its ``monotonically_increasing_id``."""
    return F.shiftrightunsigned(at, _ROW_BITS)


def _offsets(ranged: DataFrame, sums: dict[str, Column], at: str = "__at") -> DataFrame:
    """Sums over all earlier ranges for each range, one row per range.

    Written, so that the planner knows its size and broadcasts it only if it is small.
    """
    per_range = ranged.groupBy(_range_of(at).alias("__range")).agg(*[c.alias(n) for n, c in sums.items()])
    # One row per range: a window without keys stays small here.
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    zero = {n: F.lit(0).cast(per_range.schema[n].dataType) for n in sums}
    return materialize(
        per_range.select("__range", *[F.coalesce(F.sum(n).over(earlier), zero[n]).alias(n) for n in sums]), "offsets"
    )


def _ranged(stored: DataFrame, order: list[str], rows_per_range: int) -> DataFrame:
    """Written rows in order, in as many ranges as their number needs, with their place as ``__at``."""
    ranges = max(1, math.ceil(stored.count() / rows_per_range))
    lined = stored.repartitionByRange(ranges, *order) if ranges > 1 else stored.coalesce(1)
    return materialize(
        lined.sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "ranged"
    )


def number_rows(df: DataFrame, order: list[str], name: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Dense 1-based numbers in a total order, with one shuffle and without a window over rows.

    Rows are range-partitioned, sorted inside their ranges and written with their places; a
    place is then shifted by the sizes of the ranges before it. ``order`` must be unique per row.
    """
    ranged = _ranged(materialize(df, "unordered"), order, rows_per_range)
    offsets = _offsets(ranged, {"__before": F.count("*")})
    place = F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ranged.withColumn("__range", _range_of("__at"))
        .join(offsets, "__range")
        .withColumn(name, (F.col("__before") + place + 1).cast("bigint"))
        .drop("__range", "__before", "__at")
    )


def counts_before(
    df: DataFrame, order: list[str], sums: list[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Add ``<column>_before``: the sum of each column of ``sums`` over all earlier rows.

    ``order`` must be unique per row. One task orders one range; across ranges only one row of
    sums for each range is carried.
    """
    stored = materialize(df, "unordered")
    if stored.count() <= rows_per_range:  # one range, nothing to carry
        earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return stored.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in sums})
    ranged = _ranged(stored, order, rows_per_range).withColumn("__range", _range_of("__at"))
    offsets = _offsets(ranged, {f"__{c}": F.sum(c) for c in sums})
    earlier = Window.partitionBy("__range").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    inside = {f"{c}_before": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in sums}
    shifted = {f"{c}_before": F.col(f"{c}_before") + F.col(f"__{c}") for c in sums}
    return (
        ranged.withColumns(inside)
        .join(offsets, "__range")
        .withColumns(shifted)
        .drop("__range", "__at", *[f"__{c}" for c in sums])
    )


# --- quantiles -------------------------------------------------------------------------


def quantile_bounds(x: Column, probabilities: list[float], accuracy: int) -> Column:
    """An aggregate: values surely at or below, and at or above, each probability's position.

    They come from one mergeable summary whose ranks are off by ``1 / accuracy`` of the rows at most.
    """
    slack = 2.0 / accuracy
    sides = [min(1.0, max(0.0, p + side)) for p in probabilities for side in (-slack, slack)]
    return F.percentile_approx(x, sides, accuracy)


def exact_quantiles(
    df: DataFrame,
    cols: list[str],
    probabilities: list[float],
    accuracy: int = 10_000,
    bounds: dict[str, tuple[int, list[float]]] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Interpolated quantiles per column: rows of ``column, probability, value``.

    A first pass bounds every wanted value by two others, a few thousandths of the rows apart.
    A second pass counts the rows below and at these bounds for all columns at once, and
    writes only values strictly between them, so that no value however frequent is written. The
    wanted positions are looked up among those.
    The driver holds a few numbers per column and probability. ``bounds`` are the row counts
    and bounds of a first pass that the caller has made together with other aggregates
    (:func:`quantile_bounds` at the same accuracy).
    """
    spark = df.sparkSession
    numbers = df.select(*[_number(c).alias(c) for c in cols])
    if bounds is None:
        first = numbers.agg(
            F.struct(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(cols)]).alias("n"),
            F.struct(
                *[quantile_bounds(F.col(f"`{c}`"), probabilities, accuracy).alias(f"b{i}") for i, c in enumerate(cols)]
            ).alias("b"),
        ).first()
        bounds = {c: (first["n"][i], first["b"][i]) for i, c in enumerate(cols)}
    edges = []  # column, probability, rows, low, high
    for c in cols:
        n, sides = bounds[c]
        for j, p in enumerate(probabilities if n else []):
            # Bounds of few rows may be one row off, so that there all values are between them.
            low, high = (float(x) for x in sides[2 * j : 2 * j + 2]) if n >= accuracy else (-math.inf, math.inf)
            edges.append((c, p, n, low, high))
    if not edges:
        return spark.createDataFrame([], "column string, probability double, value double")
    counts, inside = [], []
    for e, (c, _, _, low, high) in enumerate(edges):
        x = F.col(f"`{c}`")
        counts += [
            F.count_if(x < low).alias(f"below{e}"),
            F.count_if(x == low).alias(f"low{e}"),
            F.count_if((x > low) & (x < high)).alias(f"inside{e}"),
        ]
        if low < high:
            entry = F.struct(F.lit(e).alias("edge"), x.alias("value"))
            inside.append(F.when((x > low) & (x < high), entry))
    seen = Observation(f"quantiles-{uuid.uuid4().hex}")
    entries = F.array_compact(F.array(*inside)) if inside else F.array().cast("array<struct<edge:int,value:double>>")
    between = materialize(
        numbers.observe(seen, *counts).select(F.explode(entries).alias("e")).select("e.edge", "e.value"), "between"
    )
    counted = seen.get
    names = ["column", "probability", "side", "share", "at"]
    known, wanted = [], []
    start = 0
    for e, (c, p, n, low, high) in enumerate(edges):
        below, at_low, within = (counted[f"{k}{e}"] for k in ("below", "low", "inside"))
        exact = (n - 1) * p
        for side, at in enumerate((math.floor(exact), math.ceil(exact))):
            if at < below:
                raise RuntimeError(f"quantile {p} of {c} lies below its bound")
            if at < below + at_low or at >= below + at_low + within:
                known.append((c, p, side, exact - math.floor(exact), low if at < below + at_low else high))
            else:
                wanted.append((e, c, p, side, exact - math.floor(exact), start + at - below - at_low))
        start += within
    found = spark.createDataFrame(known, "column string, probability double, side int, share double, value double")
    if wanted:
        # Edges follow each other in one order, each with its rows between the bounds.
        distinct = between.groupBy("edge", "value").agg(F.count("*").alias("n"))
        ranked = counts_before(distinct, ["edge", "value"], ["n"], rows_per_range)
        by_edge: dict[int, list] = {}
        for e, *place in wanted:
            by_edge.setdefault(e, []).append(F.struct(*[F.lit(v).alias(k) for k, v in zip(names, place)]))
        places = F.create_map(*[x for e, some in by_edge.items() for x in (F.lit(e), F.array(*some))])
        here = F.filter(
            F.try_element_at(places, F.col("edge")),
            lambda w: (w["at"] >= F.col("n_before")) & (w["at"] < F.col("n_before") + F.col("n")),
        )
        hit = ranked.select(F.explode(here).alias("w"), "value").select("w.*", "value").drop("at")
        found = found.unionByName(hit)
    low, high = (F.max(F.when(F.col("side") == side, F.col("value"))) for side in (0, 1))
    return found.groupBy("column", "probability").agg(
        F.when(low == high, low).otherwise(low + (high - low) * F.max("share")).alias("value")
    )


def _number(c: str) -> Column:
    return F.nullif(F.col(f"`{c}`").cast("double"), F.lit(float("nan")))
