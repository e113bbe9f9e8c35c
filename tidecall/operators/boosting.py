"""Boosted trees by histograms of binned rows, for several parameter sets in the same passes.

What Spark's ``GBTClassifier`` fits: logistic loss, a first tree on the labels, each further
one on the negative gradient, splits of largest variance reduction among at most ``maxBins``
bins. It differs in how the rows are kept. A row is a byte per column (one-hot slots of one
column are one code), packed into blocks, and tasks send counts and sums per node and bin. One
job finds a level of the trees of all parameter sets.

Of two children only the one with fewer rows is counted; the other's counts and sums are what is
left of their parent's. Sums are whole numbers (units of ``2**-DIGITS``), so that this is exact and
the trees do not depend on how rows are dealt to blocks and tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, SparkContext, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecall.session import materialize

#: Rows that numpy works on at once, and the fewest (times fits) and most that a task holds in blocks (about 25 bytes each).
ROWS_PER_BLOCK, LEAST_PER_TASK, ROWS_PER_TASK = 1 << 16, 100_000, 2_000_000
#: Rows from which the borders of bins are taken, and bins of a number, as in Spark.
BORDER_ROWS = 10_000
#: Trees after which margins are found anew from the written rows, so that plans stay short without writing margins.
TREES_PER_WRITE = 50
#: Binary digits behind the point of what is summed; fewer beyond 2**26 rows, so that sums stay below 2**63.
DIGITS = 35
#: Several columns are counted as one while the counts of a level have at most so many entries.
ENTRIES = 1 << 13
#: Deepest nodes that are found with a byte per row, and the answer for rows that are in none of those asked for.
BYTE_LEVELS, NONE = 7, 255
#: Tasks whose histograms are added up on the driver at once.
TASKS_TO_DRIVER = 64
ONE_HOT = "__onehot_"
_BLOCK = "fitted boolean, n int, codes binary, labels binary"


@dataclass(frozen=True)
class Column_:
    """Slots of the feature vector that are one code: a number by its borders, or levels of a one-hot column."""

    slots: tuple[int, ...]
    borders: tuple[float, ...] | None = None

    @property
    def width(self) -> int:
        return len(self.slots if self.borders is None else self.borders) + 1


@dataclass(frozen=True)
class Plan:
    rate: float
    depth: int
    trees: int


class Tree:
    """Nodes in heap order: ``column`` is -1 at a leaf, ``cut`` the last code to the left or the level to the right."""

    def __init__(self, depth: int):
        nodes = 2 ** (depth + 1) - 1
        self.column = np.full(nodes, -1, np.int64)
        self.cut = np.zeros(nodes, np.int64)
        self.value, self.count, self.gain = np.zeros(nodes), np.zeros(nodes), np.zeros(nodes)
        self.levels = 0

    def node_of(self, codes: np.ndarray, levels: np.ndarray) -> np.ndarray:
        """The node that each row is in; ``levels`` tells columns of levels from numbers."""
        n = codes.shape[1]
        flat, row = codes.ravel(), np.arange(n)
        if not self.levels or self.column[0] < 0:
            return np.zeros(n, np.int64)
        column, cut = self.column[0], self.cut[0]
        node = 1 + (codes[column] == cut if levels[column] else codes[column] > cut).astype(np.int64)
        for _ in range(1, self.levels):
            column, cut = self.column[node], self.cut[node]
            code = flat[column * n + row]
            right = np.where(levels[column], code == cut, code > cut)
            node = np.where(column >= 0, 2 * node + 1 + right, node)
        return node

    def place_of(self, nodes: np.ndarray, codes: np.ndarray, levels: np.ndarray) -> np.ndarray:
        """The place in ``nodes`` of the node that each row is in, beyond all places (or ``NONE``) where it is another.

        Every split of a shallow tree is asked of all rows: bytes are compared much faster than looked up.
        """
        if self.levels > BYTE_LEVELS:
            places = np.full(len(self.column), len(nodes))
            places[nodes] = np.arange(len(nodes))
            return places[self.node_of(codes, levels)]
        places = {int(node): place for place, node in enumerate(nodes)}

        def find(node: int, level: int) -> int | np.ndarray:
            column, cut = int(self.column[node]), int(self.cut[node])
            if level == self.levels or column < 0:
                return places.get(node, NONE)
            left, right = find(2 * node + 1, level + 1), find(2 * node + 2, level + 1)
            if isinstance(left, int) and isinstance(right, int) and left == right:
                return left
            goes = codes[column] == cut if levels[column] else codes[column] > cut
            out = np.negative(goes.view(np.uint8))  # all bits where a row goes right
            out &= np.bitwise_xor(left, right, dtype=np.uint8)
            out ^= np.uint8(left) if isinstance(left, int) else left
            return out

        found = find(0, 0)
        return np.full(codes.shape[1], found, np.uint8) if isinstance(found, int) else found

    def counted(self) -> np.ndarray:
        """Nodes of the next level whose rows are counted: of two children the one with fewer."""
        if not self.levels:
            return np.zeros(1, np.int64)
        start = 2 ** (self.levels - 1) - 1
        parents = start + np.flatnonzero(self.column[start : 2 * start + 1] >= 0)
        left = 2 * parents + 1
        return left + (self.count[left] > self.count[left + 1])

    def ends(self) -> np.ndarray:
        """The leaves, among them all nodes of the last level."""
        out, level = [], [0]
        for depth in range(self.levels + 1):
            open_ = [i for i in level if depth < self.levels and self.column[i] >= 0]
            out += [i for i in level if depth == self.levels or self.column[i] < 0]
            level = [2 * i + side for i in open_ for side in (1, 2)]
        return np.array(out)


# --- binning -----------------------------------------------------------------------------


def borders_of(values: np.ndarray, bins: int) -> tuple[float, ...]:
    """At most ``bins - 1`` midpoints between neighbouring values, with about as many rows between them."""
    known, counts = np.unique(values, return_counts=True)
    middle = (known[:-1] + known[1:]) / 2
    if len(middle) < bins:
        return tuple(middle.tolist())
    stride = counts.sum() / bins
    out, target, seen = [], stride, np.cumsum(counts)
    for i in range(1, len(known)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            out.append(float(middle[i - 1]))
            target += stride
    return tuple(out)


def columns_of(rows: DataFrame, n: int, bins: int) -> list[Column_]:
    """Columns of the vector ``features``: levels by the names that the encoder gave, numbers by their borders."""
    field = rows.schema["features"]
    attrs = [a for g in field.metadata.get("ml_attr", {}).get("attrs", {}).values() for a in g]
    named = {a["idx"]: a.get("name", "").split(ONE_HOT)[0] for a in attrs if ONE_HOT in a.get("name", "")}
    wanted = max(bins * bins, BORDER_ROWS)
    draw = F.pmod(F.xxhash64("features"), F.lit(1 << 30)) / float(1 << 30)
    some = rows.where(draw < wanted / n) if n > wanted else rows
    sample = some.select(vector_to_array("features").alias("x")).toArrow().column("x").combine_chunks()
    matrix = sample.flatten().to_numpy(zero_copy_only=False).reshape(len(sample), -1)
    size = matrix.shape[1] if len(sample) else len(rows.first()["features"])
    groups: dict[object, list[int]] = {}
    for i in range(size):
        groups.setdefault(named.get(i, i), []).append(i)
    return [
        Column_(tuple(slots)) if isinstance(name, str) else Column_(tuple(slots), borders_of(matrix[:, slots[0]], bins))
        for name, slots in groups.items()
    ]


def _pack(rows: DataFrame, label: str, fitted: Column, columns: list[Column_]) -> DataFrame:
    """Blocks of binned rows; rows to fit on and others are in blocks of their own."""
    kind = np.min_scalar_type(max(c.width for c in columns) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            if not np.isin(labels, (0.0, 1.0)).all():
                raise ValueError("labels must be 0 or 1")
            codes = np.empty((len(columns), len(matrix)), kind)
            for i, c in enumerate(columns):
                if c.borders is None:
                    hot = matrix[:, c.slots] > 0.5
                    codes[i] = np.where(hot.any(axis=1), hot.argmax(axis=1), c.width - 1)
                else:
                    codes[i] = np.searchsorted(np.array(c.borders), matrix[:, c.slots[0]])
            side = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            out = []
            for which in (True, False):
                here = np.flatnonzero(side == which)
                if len(here):
                    out.append((which, len(here), codes[:, here].tobytes(), labels[here].astype(np.int8).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), (pa.bool_(), pa.int32(), *[pa.binary()] * 2))],
                    ["fitted", "n", "codes", "labels"],
                )

    read = rows.select(
        vector_to_array("features").alias("features"),
        F.col(f"`{label}`").cast("double").alias("label"),
        F.coalesce(fitted, F.lit(False)).alias("fitted"),
    )
    return read.mapInArrow(run, _BLOCK)


#: Codes by column, labels (-1 or 1) and margins by model.
Block = tuple[np.ndarray, np.ndarray, np.ndarray]


def _kind(columns: list[Column_]) -> np.dtype:
    return np.min_scalar_type(max(c.width for c in columns) - 1)


def _unpacked(codes: bytes, labels: bytes, columns: list[Column_]) -> tuple[np.ndarray, np.ndarray]:
    known = np.frombuffer(labels, np.int8)
    return np.frombuffer(codes, _kind(columns)).reshape(len(columns), len(known)), known * np.int8(2) - np.int8(1)


def _joined(rows: Iterator[tuple[bytes, bytes]], columns: list[Column_]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes and labels of ``ROWS_PER_BLOCK`` rows each; the last ones have fewer."""
    parts, n = [], 0
    for row in rows:
        codes, labels = _unpacked(*row, columns)
        at = 0
        while at < len(labels):
            end = at + min(len(labels) - at, ROWS_PER_BLOCK - n)
            parts.append((codes[:, at:end], labels[at:end]))
            n += end - at
            at = end
            if n == ROWS_PER_BLOCK:
                yield tuple(np.concatenate(x, axis=-1) for x in zip(*parts))
                parts, n = [], 0
    if parts:
        yield tuple(np.concatenate(x, axis=-1) for x in zip(*parts))


def _blocks(packed: DataFrame, columns: list[Column_], models: int, tasks: int) -> RDD[Block]:
    """Blocks with margins of 0."""

    def run(rows) -> Iterator[Block]:
        for codes, labels in _joined(rows, columns):
            yield codes, labels, np.zeros((models, len(labels)))

    return packed.select("codes", "labels").repartition(tasks).rdd.mapPartitions(run)


# --- boosting ----------------------------------------------------------------------------


def _groups(widths: list[int], most: int) -> list[list[int]]:
    """Columns that are counted as one: their combinations are at most ``most``."""
    out: list[tuple[int, list[int]]] = []
    for c in sorted(range(len(widths)), key=lambda c: -widths[c]):
        for i, (size, group) in enumerate(out):
            if size * widths[c] <= most:
                out[i] = (size * widths[c], [*group, c])
                break
        else:
            out.append((widths[c], [c]))
    return [group for _, group in out]


class _Counts:
    """Per model: rows and sum of what is fitted, of each counted node and code, from all blocks of a task."""

    def __init__(self, trees: dict[int, tuple[Tree, np.ndarray]], first: bool, digits: int, widths: list[int], levels: np.ndarray):
        self.trees, self.first, self.digits, self.widths, self.levels = trees, first, digits, widths, levels
        most = max(len(nodes) for _, nodes in trees.values())
        self.groups = _groups(widths, ENTRIES // most)
        self.sizes = [math.prod(widths[c] for c in g) for g in self.groups]
        self.kind = np.min_scalar_type(max(self.sizes) * most)
        self.found: dict[int, list[np.ndarray]] = {
            m: [np.zeros((2, len(nodes) * size), np.int64) for size in self.sizes] for m, (_, nodes) in trees.items()
        }

    def add(self, block: Block) -> None:
        codes, labels, margins = block
        joint = []
        for group in self.groups:
            code = codes[group[0]].astype(self.kind)
            for c in group[1:]:
                code *= self.kind.type(self.widths[c])
                code += codes[c]
            joint.append(code)
        at_root, counts = None, None
        for m, (tree, nodes) in self.trees.items():
            sums, known, margin = self.found[m], labels, margins[m]
            if tree.levels:
                place = tree.place_of(nodes, codes, self.levels)
                here = np.flatnonzero(place < len(nodes))
                place, known, margin = place.take(here).astype(self.kind), known.take(here), margin.take(here)
                at = []
                for code, size in zip(joint, self.sizes):
                    code = code.take(here)
                    if len(nodes) > 1:
                        code += place * self.kind.type(size)
                    at.append(code.astype(np.intp))
                counts = None
            else:
                at = at_root = at_root or [code.astype(np.intp) for code in joint]
            if self.first:
                target = known * 2.0**self.digits
            else:
                target = (known * np.int8(2)) * margin
                np.exp(target, out=target)
                target += 1
                np.divide(known * (4 * 2.0**self.digits), target, out=target)
                np.rint(target, out=target)
            # All rows are at the root, whatever the model.
            counts = counts or [np.bincount(x, minlength=s.shape[1]) for x, s in zip(at, sums)]
            for x, n, s in zip(at, counts, sums):
                s[0] += n
                s[1] += np.bincount(x, target, s.shape[1]).astype(np.int64)

    def by_column(self) -> list[np.ndarray]:
        out = []
        for m, (_, nodes) in self.trees.items():
            parts: dict[int, np.ndarray] = {}
            for group, found in zip(self.groups, self.found[m]):
                found = found.reshape(2, len(nodes), *(self.widths[c] for c in group))
                for i, c in enumerate(group):
                    parts[c] = found.sum(axis=tuple(j + 2 for j in range(len(group)) if j != i))
            out.append(np.concatenate([parts[c] for c in range(len(self.widths))], axis=2))
        return out


def _of_all_nodes(tree: Tree, found: np.ndarray, parents: np.ndarray | None) -> np.ndarray:
    """Counts and sums of all nodes of a level from those of the counted ones and of the level above."""
    if parents is None:
        return found
    out = np.zeros((2, 2**tree.levels, found.shape[2]), np.int64)
    at = tree.counted() - (2**tree.levels - 1)
    out[:, at] = found
    out[:, at ^ 1] = parents[:, at >> 1] - found
    return out


def _grow(tree: Tree, found: np.ndarray, columns: list[Column_], unit: float) -> None:
    """Splits the open nodes where the variance falls most; ties go to the first slot and the lowest border."""
    start, nodes = 2**tree.levels - 1, 2**tree.levels
    whole_rows, whole_total = found[:, :, : columns[0].width].sum(axis=2)
    rows, total = whole_rows.astype(float), whole_total * unit
    here = slice(start, start + nodes)
    tree.count[here] = rows
    tree.value[here] = np.divide(total, rows, out=np.zeros(nodes), where=rows > 0)
    places, right = [], []
    at = 0
    for c, column in enumerate(columns):
        part = found[:, :, at : at + column.width]
        at += column.width
        after = part[:, :, :-1] if column.borders is None else part.sum(axis=2, keepdims=True) - np.cumsum(part, axis=2)[:, :, :-1]
        right.append(after)
        places += [(s, c, i) for i, s in enumerate(column.slots)] if column.borders is None else [(column.slots[0], c, i) for i in range(column.width - 1)]
    if not places:
        tree.levels += 1
        return
    n_right, s_right = np.concatenate(right, axis=2)
    n_left, s_left = (whole_rows[:, None] - n_right).astype(float), (whole_total[:, None] - s_right) * unit
    n_right, s_right = n_right.astype(float), s_right * unit
    good = (n_left > 0.5) & (n_right > 0.5)
    with np.errstate(divide="ignore", invalid="ignore"):
        whole = total * total / rows
        gains = np.where(good, (s_left**2 / n_left + s_right**2 / n_right - whole[:, None]) / rows[:, None], -np.inf)
    order = np.argsort([p[0] for p in places], kind="stable")
    best = order[np.argmax(gains[:, order], axis=1)]
    for k in np.flatnonzero(rows > 0.5):
        b, node = best[k], start + k
        gain = gains[k, b]
        # What rounding alone makes of equal values is no gain.
        if not gain > 1e-13 * max(1.0, tree.value[node] ** 2):
            continue
        _, tree.column[node], tree.cut[node] = places[b]
        tree.gain[node] = gain
        for child, n, s in ((2 * node + 1, n_left[k, b], s_left[k, b]), (2 * node + 2, n_right[k, b], s_right[k, b])):
            tree.count[child], tree.value[child] = n, s / n
    tree.levels += 1


def boost(
    rows: DataFrame,
    label: str,
    plans: list[Plan],
    bins: int = 32,
    fitted: Column | None = None,
    stages: list[int] | None = None,
) -> tuple[list[list[Tree]], list[Column_], dict[int, DataFrame]]:
    """Trees of each plan, the columns that their cuts speak of, and scores of the rows not ``fitted``.

    ``rows`` has the vector ``features``. For each number of trees in ``stages`` the margins of
    the other rows are a table of ``label`` and ``m0, m1, ...``, one per plan. Each level of the
    trees of all plans is one job over all blocks; the driver holds the counts and sums of two levels.
    """
    spark = rows.sparkSession
    fitted = F.lit(True) if fitted is None else fitted
    n_fitted, n = rows.agg(F.count_if(fitted), F.count("*")).first()
    if not n_fitted:
        raise ValueError("no rows to fit on")
    columns = columns_of(rows.where(fitted), n_fitted, bins)
    widths, levels = [c.width for c in columns], np.array([c.borders is None for c in columns])
    cores = spark.sparkContext.defaultParallelism
    tasks = min(cores * math.ceil(n / cores / ROWS_PER_TASK), math.ceil(n * len(plans) / LEAST_PER_TASK))
    packed = materialize(_pack(rows, label, fitted, columns), "blocks")
    state = _blocks(packed.where("fitted"), columns, len(plans), tasks).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    before: RDD | None = None
    done: list[list[Tree]] = [[] for _ in plans]
    # A target is 4 at most.
    digits = min(DIGITS, 61 - int(n_fitted).bit_length())

    def add(one: list, other: list) -> list:
        return [x + y for x, y in zip(one, other)]

    def sums(trees: dict[int, Tree], first: bool) -> list[np.ndarray]:
        asked = {m: (tree, tree.counted()) for m, tree in trees.items()}

        def run(blocks: Iterator[Block]) -> Iterator[list[np.ndarray]]:
            counts = _Counts(asked, first, digits, widths, levels)
            for block in blocks:
                counts.add(block)
            yield counts.by_column()

        found = state.mapPartitions(run)
        return found.reduce(add) if tasks <= TASKS_TO_DRIVER else found.treeReduce(add)

    for number in range(max(p.trees for p in plans)):
        trees = [Tree(p.depth) for p in plans]
        above: dict[int, np.ndarray] = {}
        for level in range(max(p.depth for p in plans)):
            models = [m for m, p in enumerate(plans) if number < p.trees and level < p.depth and (not level or (trees[m].column[2 ** (level - 1) - 1 : 2**level - 1] >= 0).any())]
            if not models:
                break
            for m, found in zip(models, sums({m: trees[m] for m in models}, number == 0)):
                above[m] = _of_all_nodes(trees[m], found, above.get(m))
                _grow(trees[m], above[m], columns, 2.0**-digits)
            if before is not None:
                before.unpersist()
                before = None
        for m, p in enumerate(plans):
            if number < p.trees:
                done[m].append(trees[m])
        if number + 1 == max(p.trees for p in plans):
            break

        anew = (number + 1) % TREES_PER_WRITE == 0
        steps = [_steps(p, d)[0 if anew else number :] for p, d in zip(plans, done)]

        def further(block: Block, steps=steps) -> Block:
            codes, labels, margins = block
            return codes, labels, np.stack([_moved(x, s, codes, levels) for x, s in zip(margins, steps)])

        before = state
        state = (_blocks(packed.where("fitted"), columns, len(plans), tasks) if anew else before).map(further)
        state.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    for held in (before, state):
        if held is not None:
            held.unpersist()
    staged: dict[int, DataFrame] = {}
    if stages:
        scores = materialize(_scores(packed.where("not fitted").repartition(tasks), label, plans, done, columns, levels, stages), "scores")
        staged = {n: scores.select(label, *(F.col(f"m{m}_{n}").alias(f"m{m}") for m in range(len(plans)))) for n in stages}
    return done, columns, staged


def _steps(plan: Plan, trees: list[Tree]) -> list[tuple[Tree, float]]:
    return [(tree, plan.rate if number else 1.0) for number, tree in enumerate(trees)]


def _moved(margins: np.ndarray, steps: list[tuple[Tree, float]], codes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Margins after further trees."""
    for tree, step in steps:
        ends = tree.ends()
        margins = margins + (tree.value[ends] * step)[tree.place_of(ends, codes, levels)]
    return margins


def _scores(packed: DataFrame, label: str, plans: list[Plan], trees: list[list[Tree]], columns: list[Column_], levels: np.ndarray, stages: list[int]) -> DataFrame:
    """The label and, as ``m{model}_{stage}``, the margins after so many trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(2))))
        for codes, labels in _joined(rows, columns):
            found = {}
            for m, plan in enumerate(plans):
                margins, steps = np.zeros(len(labels)), _steps(plan, trees[m])
                for last, n in zip([0, *sorted(stages)], sorted(stages)):
                    found[m, n] = margins = _moved(margins, steps[last:n], codes, levels)
            known = (labels + 1) / 2
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (known, *(found[at] for at in places))], [label, *names])

    places = [(m, n) for m in range(len(plans)) for n in stages]
    names = [f"m{m}_{n}" for m, n in places]
    return packed.select("codes", "labels").mapInArrow(run, f"`{label}` double, " + ", ".join(f"{x} double" for x in names))


# --- models ------------------------------------------------------------------------------


def as_model(estimator: GBTClassifier, trees: list[Tree], columns: list[Column_]) -> GBTClassificationModel:
    """The trees as Spark's model, with the parameters of ``estimator``."""
    context = SparkContext._active_spark_context
    jvm, gateway = context._jvm, context._gateway
    spark_ml = jvm.org.apache.spark.ml
    leaf, inner, split_at = spark_ml.tree.LeafNode, spark_ml.tree.InternalNode, spark_ml.tree.ContinuousSplit
    variance = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    regression, part_of = spark_ml.regression.DecisionTreeRegressionModel, jvm.java.util.Arrays.copyOfRange
    size = sum(len(c.slots) for c in columns)
    kept = gateway.new_array(regression, len(trees))
    weights = gateway.new_array(jvm.double, len(trees))

    def node_of(tree: Tree, stats, i: int):
        calculator = variance(part_of(stats, 3 * i, 3 * i + 3), int(tree.count[i]))
        value = float(tree.value[i])
        if tree.column[i] < 0:
            return leaf(value, 0.0, calculator)
        column, cut = columns[tree.column[i]], int(tree.cut[i])
        slot, border = (column.slots[cut], 0.5) if column.borders is None else (column.slots[0], column.borders[cut])
        left, right = node_of(tree, stats, 2 * i + 1), node_of(tree, stats, 2 * i + 2)
        split = split_at(int(slot), float(border))
        return inner(value, 0.0, float(tree.gain[i]), left, right, split, calculator)

    for t, tree in enumerate(trees):
        # Rows, sum and the square sum of equal values: what nodes hold besides a prediction counts rows.
        flat = np.stack([tree.count, tree.count * tree.value, tree.count * tree.value**2], axis=1).astype(">f8").ravel()
        stats = gateway.new_array(jvm.double, len(flat))
        jvm.java.nio.ByteBuffer.wrap(flat.tobytes()).asDoubleBuffer().get(stats)
        kept[t] = regression(f"{estimator.uid}_{t}", node_of(tree, stats, 0), size)
        weights[t] = float(estimator.getStepSize()) if t else 1.0
    java = spark_ml.classification.GBTClassificationModel(f"{estimator.uid}_{len(trees)}", kept, weights, size, 2)
    return estimator._copyValues(GBTClassificationModel(java))


class BoostedTrees(GBTClassifier):
    """``GBTClassifier`` that is fitted by :func:`boost`."""

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        plan = Plan(self.getStepSize(), self.getMaxDepth(), self.getMaxIter())
        rows = materialize(dataset.select(F.col(self.getFeaturesCol()).alias("features"), self.getLabelCol()), "encoded")
        (trees,), columns, _ = boost(rows, self.getLabelCol(), [plan], self.getMaxBins())
        return as_model(self, trees, columns)
