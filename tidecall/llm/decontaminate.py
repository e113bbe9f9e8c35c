"""Passages of benchmark items in documents: SimHash windows, Hamming blocks, exact check."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecall.llm.common import Scratch

WORDS = re.compile(r"\w+")
SHINGLE_WORDS = 5
BITS = 64
CACHE_WORDS = 200_000
ROWS_AT_ONCE = 64
#: Shingles that several items hold, if the items are more than one block: sent with each.
MAX_COMMON = 1_000_000


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


class Hashes(dict):
    """64-bit hash per word, kept until there are too many."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """A hash per run of ``size`` words."""
    out = np.full(max(0, len(words) - size + 1), size, np.uint64)
    for i in range(size if len(out) else 0):
        out = (out ^ words[i : len(out) + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def signs(hashes: np.ndarray) -> np.ndarray:
    """A row of +1 and -1 per hash."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def fingerprints(totals: np.ndarray) -> np.ndarray:
    """SimHash of each row of summed signs."""
    return np.packbits(totals > 0, axis=1, bitorder="little").view(np.uint64).ravel()


@dataclass
class Items:
    """A block of benchmark items, indexed for windows of their sizes.

    ``radius + 1`` blocks of bits: two fingerprints within ``radius`` agree in one of them.
    """

    ids: list
    texts: list[list[str]]
    weights: dict[tuple, float]
    most: float
    radius: int
    copies: list[int]
    prints: np.ndarray = field(init=False)
    sizes: np.ndarray = field(init=False)
    shingles: dict[int, tuple[np.ndarray, dict[int, list[int]]]] = field(init=False)
    blocks: list[tuple[int, int]] = field(init=False)
    index: dict[tuple[int, int, int], list[int]] = field(init=False)

    def __post_init__(self) -> None:
        hashes = Hashes()
        coded = [hashes.of(t) for t in self.texts]
        self.sizes = np.array([len(t) for t in self.texts])
        self.prints = np.array([fingerprints(signs(c).sum(0, keepdims=True))[0] for c in coded], np.uint64)
        # By words in a shingle: hashes in order, and the sizes of the items that have each.
        found: dict[int, dict[int, set[int]]] = {}
        for c in coded:
            width = min(SHINGLE_WORDS, len(c))
            for h in shingle_hashes(c, width).tolist():
                found.setdefault(width, {}).setdefault(h, set()).add(len(c))
        self.shingles = {
            width: (np.array(sorted(of), np.uint64), {h: sorted(s) for h, s in of.items()})
            for width, of in found.items()
        }
        edges = [round(i * BITS / (self.radius + 1)) for i in range(self.radius + 2)]
        self.blocks = list(zip(edges, edges[1:]))
        self.index = {}
        for i, (n, p) in enumerate(zip(self.sizes.tolist(), self.prints.tolist())):
            for b, (lo, hi) in enumerate(self.blocks):
                self.index.setdefault((n, b, p >> lo & (1 << (hi - lo)) - 1), []).append(i)

    def near(self, size: int, windows: np.ndarray) -> Iterator[tuple[int, int]]:
        """Pairs (window, item) of one size within the radius."""
        found: set[tuple[int, int]] = set()
        for b, (lo, hi) in enumerate(self.blocks):
            values = (windows >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
            for value in np.unique(values).tolist():
                items = self.index.get((size, b, value))
                if items:
                    at = np.flatnonzero(values == np.uint64(value))
                    apart = np.bitwise_count(windows[at][:, None] ^ self.prints[items][None, :])
                    for w, i in np.argwhere(apart <= self.radius).tolist():
                        found.add((int(at[w]), items[i]))
        return iter(sorted(found))

    def similarity(self, a: list[str], b: list[str]) -> float:
        """Weighted Jaccard of two bags of shingles; a shingle of no item weighs as the rarest."""
        x, y = bag(a), bag(b)
        most = self.most
        # Rounded once, so that the order of a set does not count.
        both = math.fsum(min(n, y[s]) * self.weights.get(s, most) for s, n in x.items() if s in y)
        either = math.fsum(max(x.get(s, 0), y.get(s, 0)) * self.weights.get(s, most) for s in x.keys() | y.keys())
        return both / either if either else 0.0


def bag(words: list[str]) -> Counter:
    size = min(SHINGLE_WORDS, len(words))
    return Counter(zip(*[words[i:] for i in range(size)])) if size else Counter()


def scan(words: list[str], coded: np.ndarray, items: Items, threshold: float) -> list[tuple]:
    """Best window ``(item, start, size, similarity)`` of each item that the text holds."""
    # Windows that hold no shingle of an item of their size are not like it at all.
    starts: dict[int, list[tuple[int, int]]] = {}
    for width, (known, sizes) in items.shingles.items():
        hashes = shingle_hashes(coded, width)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        for p in np.flatnonzero(known[at] == hashes).tolist():
            for size in sizes[int(hashes[p])]:
                lo, hi = max(0, p + width - size), min(p, len(words) - size)
                if lo <= hi:
                    starts.setdefault(size, []).append((lo, hi))
    if not starts:
        return []
    low = min(lo for spans in starts.values() for lo, _ in spans)
    high = max(hi + size for size, spans in starts.items() for _, hi in spans)
    best: dict[int, tuple] = {}
    sums = np.zeros((high - low + 1, BITS), np.int32)
    np.cumsum(signs(coded[low:high]), axis=0, out=sums[1:])
    for size, spans in starts.items():
        first = np.unique(np.concatenate([np.arange(lo, hi + 1) for lo, hi in spans]))
        for part in np.array_split(first, len(first) // 4096 + 1):
            windows = fingerprints(sums[part + size - low] - sums[part - low])
            for w, i in items.near(size, windows):
                start = int(part[w])
                alike = items.similarity(words[start : start + size], items.texts[i])
                if alike >= threshold and (i not in best or alike > best[i][3]):
                    best[i] = (i, start, size, alike)
    return [best[i] for i in sorted(best)]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.8,
    radius: int = 20,
    items_at_once: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Documents that hold a passage like a benchmark item.

    Windows of an item's number of words slide over the documents word by word. Their SimHash
    of words is compared with those of the items of that size: the fingerprint is cut into
    ``radius + 1`` blocks of bits, and all fingerprints within ``radius`` bits agree in one
    block. Each candidate is verified exactly: the weighted Jaccard similarity of the bags of
    five-word shingles has to reach ``threshold``, where a shingle weighs
    ``log(1 + items / items with it)``. Windows without any shingle of an item of their size
    have similarity 0 and are passed over. Words are compared in lower case without
    punctuation.

    The items are a stated query set: they are sent to the tasks in blocks of
    at most ``items_at_once``, one pass over the documents for each block. Items count once
    for the weights if id and text are equal; weights are those of the whole set whatever the
    blocks. More than ``MAX_COMMON`` shingles that several items hold raise an error if there
    is more than one block.

    Null and empty texts hold nothing, items without words are held by nothing, items shorter
    than a shingle have to be there as a whole. Rows that repeat are found one by one; an
    empty table gives no rows; other columns are not read.

    Returns one row per document and item: ``doc_id, item_id, start_word, n_words,
    similarity``, the best window, the first of equals.
    """
    doc_type, item_type = docs.schema[id_col].dataType, benchmark.schema[item_id].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", doc_type),
            T.StructField("item_id", item_type),
            T.StructField("start_word", T.LongType(), False),
            T.StructField("n_words", T.LongType(), False),
            T.StructField("similarity", T.DoubleType(), False),
        ]
    )
    found = None
    for block in _item_blocks(benchmark, item_id, item_text, radius, items_at_once):
        part = _scan_block(docs, id_col, text_col, block, threshold, schema)
        found = part if found is None else found.unionByName(part)
    return found


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.8,
    radius: int = 20,
    items_at_once: int = 20_000,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which ``find_leaks`` finds nothing."""
    for block in _item_blocks(benchmark, item_id, item_text, radius, items_at_once):
        docs = _clean_rows(docs, text_col, block, threshold)
    return docs


def _item_blocks(benchmark: DataFrame, item_id: str, item_text: str, radius: int, at_once: int) -> Iterator[Items | None]:
    """Distinct items in blocks of at most ``at_once``, dealt by hash; weights are those of all items."""
    items = benchmark.select(benchmark[item_id].alias("id"), benchmark[item_text].alias("text")).where("text is not null")
    items = items.groupBy("id", "text").agg(F.count("*").alias("copies"))
    total = items.count()
    if total <= at_once:
        yield _index(items.orderBy("id", "text").collect(), radius)
        return
    items = Scratch(benchmark.sparkSession, "items").write(items, "distinct")
    weighing = _weights(items)
    blocks = math.ceil(1.05 * total / at_once)
    numbered = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    for b in range(blocks):
        rows = numbered.where(F.col("block") == b).orderBy("id", "text").collect()
        for at in range(0, len(rows), at_once):
            yield _index(rows[at : at + at_once], radius, weighing)


def _weights(items: DataFrame) -> tuple[dict[tuple, float], float]:
    """Weights of the shingles that more items hold than the rarest, and the weight of all others."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                out: list[str | None] = []
                for text in batch.column(0).slice(at, ROWS_AT_ONCE).to_pylist():
                    found = set(bag(words_of(text)))
                    out += [None] * bool(found) + [" ".join(s) for s in found]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["shingle"])

    held = items.select("text").mapInArrow(shingles, "shingle string").groupBy("shingle").agg(F.count("*").alias("n"))
    held = Scratch(items.sparkSession, "items").write(held, "shingles")
    # Each item with words has a null beside its shingles.
    total = held.where("shingle is null").agg(F.sum("n")).first()[0]
    least = held.where("shingle is not null").agg(F.min("n")).first()[0]
    common = held.where("shingle is not null").where(F.col("n") > F.lit(least)).limit(MAX_COMMON + 1).collect()
    if len(common) > MAX_COMMON:
        raise ValueError(f"more than {MAX_COMMON} shingles are common to several benchmark items")
    weights = {tuple(r["shingle"].split(" ")): math.log(1 + total / r["n"]) for r in common}
    return weights, math.log(1 + total / least) if total else 0.0


def _clean_rows(docs: DataFrame, text_col: str, block: Items | None, threshold: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, hashes = sent.value, Hashes()

        def clean(text: str | None) -> bool:
            words = words_of(text or "")
            return not items or not scan(words, hashes.of(words), items, threshold)

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                yield some.filter(pa.array(list(map(clean, some.column(place).to_pylist())), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _index(rows: list, radius: int, weighing: tuple[dict[tuple, float], float] | None = None) -> Items | None:
    """Without ``weighing`` the rows are all items there are."""
    texts = [(r["id"], words_of(r["text"]), r["copies"] if "copies" in r else 1) for r in rows]
    texts = [x for x in texts if x[1]]
    if not texts:
        return None
    if weighing is None:
        held = Counter(s for _, t, _ in texts for s in set(bag(t)))
        weights = {s: math.log(1 + len(texts) / n) for s, n in held.items()}
        weighing = weights, max(weights.values())
    ids, words, copies = map(list, zip(*texts))
    return Items(ids, words, *weighing, radius, copies)


def _scan_block(docs, id_col, text_col, block, threshold, schema) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, hashes = sent.value, Hashes()
        for batch in batches:
            for at in range(0, batch.num_rows if items else 0, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                out = []
                for n, text in enumerate(some.column(1).to_pylist()):
                    words = words_of(text or "")
                    for hit in scan(words, hashes.of(words), items, threshold):
                        out += [(n, *hit)] * items.copies[hit[0]]
                if out:
                    row, item, start, size, alike = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column(0).take(pa.array(row)),
                            pa.array([items.ids[i] for i in item]),
                            pa.array(start, pa.int64()),
                            pa.array(size, pa.int64()),
                            pa.array(alike, pa.float64()),
                        ],
                        schema.names,
                    )

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)
