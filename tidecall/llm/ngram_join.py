"""Exact Jaccard self-join over word shingles by universe partition and pigeonhole.

Layouts. Sizes of shingle sets are cut into bands. A pair is looked for in the band of its
smaller set. If the larger size of the band is ``s``, two sets that reach the similarity ``t``
differ in at most ``H = (1 - t) / t * s`` shingles. The universe of shingles is hashed into
``m = H + 1`` segments, so a pair agrees on the whole part of one segment at least.

Allocation. Parts that many sets share (above all empty ones) are costly to look up. Each band
therefore has ``d`` larger segments whose parts are indexed together with their one-deletion
neighbourhoods: these tolerate one difference, so the allowances sum up to ``H + 1 + d`` and
a set may leave out up to ``d`` costly parts without losing a pair. ``d`` follows from the
number of empty parts to be expected. Costly parts are those whose list proves long; a set
with more than ``d`` of them leaves out none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecall.llm.common import Scratch, ascii_words, row_key, slices_of_bytes
from tidecall.llm.components import connected_components

BAND_RATIO = 1.25
#: A segment with deletions is so many times as large as another.
DELETION_WEIGHT = 3
#: Lists up to this length give all their pairs at once; longer ones go a way of their own.
SHORT_LIST = 8
CACHE_WORDS = 300_000
#: Texts whose shingles are hashed at once.
BATCH_BYTES, BATCH_ROWS = 2 << 20, 1000
#: Entries gathered before they are dealt out, and wanted in one bucket of the shuffle.
FLUSH_ENTRIES = 1_000_000
BUCKET_ENTRIES = 400_000
#: Flags of an entry.
DELETED, PLAIN, MORE, EMPTY = 1, 2, 4, 8
#: Longs of a parity sketch: two sets differ in as many shingles at least as their sketches in bits.
SKETCH_LONGS = 16
#: Steps of set sizes, from the lower border of a band on; with the last step for all larger ones they take 5 bits.
SIZE_STEP, LAST_STEP = 1.025, 31
#: Bits of a key beside its bucket. An entry goes through the shuffle as 5 bytes of key, 8 of set and 2 of tag.
KEY_BITS, MOST_BUCKETS = 40, 1 << 23


# --- shingles ----------------------------------------------------------------------------


class WordHashes(dict):
    """64-bit hash per word, kept until there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    """A-Z lowered, cut at ASCII white space: what ``bytes`` does by itself."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], size: int) -> set[tuple]:
    if not words:
        return set()
    return set(zip(*[words[i:] for i in range(size)])) if len(words) >= size else {tuple(words)}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = x + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    high = x >> np.uint64(30)
    x ^= high
    x *= np.uint64(0xBF58476D1CE4E5B9)
    np.right_shift(x, np.uint64(27), out=high)
    x ^= high
    x *= np.uint64(0x94D049BB133111EB)
    np.right_shift(x, np.uint64(31), out=high)
    x ^= high
    return x


@dataclass
class HashedSets:
    """Distinct 64-bit shingle hashes of several texts, behind each other; ``text`` is the owner of each."""

    hashes: np.ndarray
    text: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, size: int, cache: WordHashes) -> HashedSets:
        words, ends = ascii_words(pc.ascii_lower(texts))
        coded = words.dictionary_encode()
        known = coded.dictionary.cast(pa.binary()).to_pylist()
        values = np.fromiter(map(cache.__getitem__, known), np.uint64, len(known))
        values = values[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = np.diff(ends)
        hashes, owners = [], []
        for width in range(1, size + 1):
            # Texts of fewer words than a shingle are one shingle of all their words.
            if width == size:
                left = np.repeat(ends[1:], sizes) - np.arange(len(values))
                start = np.flatnonzero(left >= size)
                owner = np.repeat(np.arange(len(sizes)), sizes)[start]
            else:
                owner = np.flatnonzero(sizes == width)
                start = ends[owner]
            out = np.full(len(start), width, np.uint64)
            for i in range(width):
                out ^= values[start + i]
                out = mix(out)
            hashes.append(out)
            owners.append(owner)
        hashes, owners = np.concatenate(hashes), np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        hashes, owners = hashes[order], owners[order]
        borders = np.searchsorted(owners, np.arange(len(sizes) + 1))
        for low, high in zip(borders[:-1], borders[1:]):
            hashes[low:high].sort()
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
        hashes, owners = hashes[fresh], owners[fresh]
        return cls(hashes, owners, np.searchsorted(owners, np.arange(len(sizes) + 1)))

    def __getitem__(self, i: int) -> np.ndarray:
        return self.hashes[self.offsets[i] : self.offsets[i + 1]]

    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def digests(self) -> np.ndarray:
        """Two independent 64-bit sums per text, equal for equal sets; zeros without shingles."""
        out = np.zeros((len(self.offsets) - 1, 2), np.uint64)
        for k, seed in enumerate((5, 6)):
            np.add.at(out[:, k], self.text, mix(self.hashes, seed))
        return out.view(np.int64)

    def sketches(self) -> np.ndarray:
        """Per text a row of bits that each shingle flips one of."""
        texts, bits = len(self.offsets) - 1, 64 * SKETCH_LONGS
        at = self.text * bits + (mix(self.hashes, 7) % np.uint64(bits)).astype(np.int64)
        counts = np.bincount(at, minlength=texts * bits).reshape(texts, bits)
        return np.packbits((counts & 1).astype(np.uint8), axis=1).view(np.int64)


# --- layouts -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    band: int
    segments: int
    deletions: int
    weight: int  # of all segments together


@lru_cache(maxsize=None)
def bands() -> np.ndarray:
    """Lower borders of the size bands."""
    out = [1]
    while out[-1] < 1 << 31:
        out.append(max(out[-1] + 1, math.ceil(out[-1] * BAND_RATIO)))
    return np.array(out)


@lru_cache(maxsize=None)
def layout(band: int, percent: int) -> Layout | None:
    """None where only equal sets are similar enough."""
    low, high = int(bands()[band]), int(bands()[band + 1]) - 1
    differing = (100 - percent) * high // percent
    if not differing:
        return None
    segments = differing + 1
    d = 1
    while d < segments:
        weight = segments - d + DELETION_WEIGHT * d
        enough = 1 + math.ceil(1.5 * (segments - d) * math.exp(-low / weight))
        if d >= enough:
            break
        d = min(segments, enough)
    return Layout(band, segments, d, segments - d + DELETION_WEIGHT * d)


def layouts_of(n: int, percent: int) -> list[Layout]:
    """Of the bands in which a set of ``n`` shingles can be the smaller or the larger one."""
    first, last = np.searchsorted(bands(), [-(-n * percent // 100), n], side="right") - 1
    return [x for b in range(first, last + 1) if (x := layout(int(b), percent))]


def entries_of(shingles: np.ndarray, owner: np.ndarray, sets: int, plan: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, flags and owners of the entries of several sets in one layout."""
    values, place = mix(shingles, 1), (mix(shingles, 2) % np.uint64(plan.weight)).astype(np.int64)
    plain = plan.segments - plan.deletions
    segment = np.where(place < plain, place, plain + (place - plain) // DELETION_WEIGHT)
    at = owner * plan.segments + segment
    sums = np.zeros(sets * plan.segments, np.uint64)
    np.add.at(sums, at, values)
    filled = np.zeros(sets * plan.segments, bool)
    filled[at] = True
    salt = mix(np.arange(plan.segments, dtype=np.uint64) + np.uint64(plan.band << 40), 3)
    flags = np.tile(np.where(np.arange(plan.segments) < plain, PLAIN, 0), sets) | np.where(filled, 0, EMPTY)
    shorter = segment >= plain
    less = (sums[at[shorter]] - values[shorter]) ^ salt[segment[shorter]]
    keys = np.concatenate([mix(sums ^ np.tile(salt, sets)), mix(less)])
    owners = np.concatenate([np.repeat(np.arange(sets), plan.segments), owner[shorter]])
    return keys, np.concatenate([flags, np.full(len(less), DELETED)]).astype(np.int32), owners


def size_step(n: int, band: int) -> int:
    return min(int(math.log(n / int(bands()[band])) / math.log(SIZE_STEP)), LAST_STEP)


def short_keys(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each key in front of its lowest 40 bits.

    Buckets keep their size as the input grows, so that few keys of a bucket agree by chance;
    these give candidates more, never less.
    """
    bucket = mix(keys, 4) % np.uint64(buckets)
    return (bucket << np.uint64(KEY_BITS) | keys & np.uint64((1 << KEY_BITS) - 1)).view(np.int64)


# --- candidate lists ---------------------------------------------------------------------


def _tags(flags: np.ndarray, band: int, steps: np.ndarray) -> np.ndarray:
    """16 bits: four of flags, seven of the band, five of the size in it."""
    return (flags | band << 4 | steps << 11).astype(np.int32)


def _alike_in_size(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return np.abs((a >> 11) - (b >> 11)) <= math.log(100 / percent) / math.log(SIZE_STEP) + 1


@dataclass
class Lists:
    """Entries sorted by key and set, without repeats; ``start`` and ``length`` of each list."""

    keys: np.ndarray
    ids: np.ndarray
    tags: np.ndarray
    start: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, ids: np.ndarray, tags: np.ndarray) -> Lists:
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        # Only keys that repeat need an order of their entries.
        shared = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(keys) else same
        some = order[shared]
        order[shared] = some[np.lexsort((tags[some] & DELETED, ids[some], keys[some]))]
        keys, ids, tags = keys[order], ids[order], tags[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
        keys, ids, tags = keys[fresh], ids[fresh], tags[fresh]
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return cls(keys, ids, tags, start, np.diff(np.append(start, len(keys))))

    def long(self) -> np.ndarray:
        """Which entries stand in long lists: many sets, or parts of a list dealt with before."""
        more = np.logical_or.reduceat((self.tags & MORE) > 0, self.start) if len(self.start) else np.zeros(0, bool)
        return np.repeat((self.length > SHORT_LIST) | more, self.length)

    def short_pairs(self, long: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of the short lists, but for two sets that both had a shingle taken out."""
        a, b = [], []
        for step in range(1, SHORT_LIST):
            same = (self.keys[step:] == self.keys[:-step]) & ~long[step:]
            x, y = self.tags[:-step][same], self.tags[step:][same]
            good = (((x & y) & DELETED) == 0) & _alike_in_size(x, y, percent)
            a.append(self.ids[:-step][same][good])
            b.append(self.ids[step:][same][good])
        return np.concatenate(a), np.concatenate(b)

    def star(self, long: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each set of a long list with the first whole one, and the places of these first ones.

        Lists of empty parts say nothing and give no pairs here.
        """
        at = np.arange(len(self.keys))
        whole = np.where((self.tags & DELETED) == 0, at, len(at))
        first = np.minimum.reduceat(whole, self.start) if len(self.start) else whole[:0]
        first = np.where(first < len(at), first, self.start)
        center = np.repeat(first, self.length)
        good = long & (at != center) & ((self.tags & EMPTY) == 0) & ((self.tags[center] & DELETED) == 0)
        good &= _alike_in_size(self.tags, self.tags[center], percent)
        return self.ids[good], self.ids[center[good]], first


def _sorted_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, the smaller first."""
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pairs[:, 0], pairs[:, 1]


ENTRY, PAIR, LONG, NODE = 0, 1, 2, 3
DEALT = ["kind", "bucket", "a", "b", "tag", "id", "key", "sketch", "low", "high", "short"]


def _bucket_of(by: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(by.view(np.uint64), 4) % np.uint64(buckets)).astype(np.int32)


def _by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """An order by bucket, the buckets that get something, and where each of them starts (with the end)."""
    order = np.argsort(bucket, kind="stable")
    used, start = np.unique(bucket[order], return_index=True)
    return order, used, pa.array(np.append(start, len(order)).astype(np.int32))


def _deal(
    kind: int,
    a: np.ndarray,
    b: np.ndarray,
    tag: np.ndarray,
    bucket: np.ndarray,
    rows: pa.RecordBatch,
    sketches: np.ndarray | None = None,
) -> pa.RecordBatch:
    """Arrays by bucket, a row for each bucket that gets something; ``rows`` adds ids and keys."""
    order, used, offsets = _by_bucket(bucket)
    lists = [
        pa.ListArray.from_arrays(offsets, pa.array(x[order].astype(t)))
        for x, t in ((a, np.int64), (b, np.int64), (tag, np.int32))
    ]
    kinds = pa.array(np.full(len(used), kind, np.int32))
    if rows.num_rows:
        more = [pa.ListArray.from_arrays(offsets, c.take(pa.array(order))) for c in rows.columns]
        flat = pa.array(sketches[order].ravel())
        more.append(pa.ListArray.from_arrays(pc.multiply(offsets, pa.scalar(SKETCH_LONGS, pa.int32())), flat))
    else:
        more = [pa.nulls(len(used), pa.list_(t)) for t in (*rows.schema.types, pa.int64())]
    more += [pa.nulls(len(used), pa.list_(t)) for t in (pa.int32(), pa.int8(), pa.int16())]
    return pa.RecordBatch.from_arrays([kinds, pa.array(used), *lists, *more], DEALT)


def _deal_entries(keys: np.ndarray, ids: np.ndarray, tags: np.ndarray, rows: pa.RecordBatch) -> pa.RecordBatch:
    """Entries by the bucket in front of their keys: the key's other bits as ``low, high``, sets ``b`` and short tags."""
    order, used, offsets = _by_bucket((keys >> KEY_BITS).astype(np.int32))
    keys = keys[order]
    b, low, high, short = (
        pa.ListArray.from_arrays(offsets, pa.array(x.astype(t)))
        for x, t in ((ids[order], np.int64), (keys, np.int32), (keys >> 32, np.int8), (tags[order], np.int16))
    )
    none = [pa.nulls(len(used), pa.list_(t)) for t in (pa.int64(), pa.int32(), *rows.schema.types, pa.int64())]
    kinds = pa.array(np.full(len(used), ENTRY, np.int32))
    return pa.RecordBatch.from_arrays([kinds, pa.array(used), none[0], b, *none[1:], low, high, short], DEALT)


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(column).combine_chunks().to_numpy(zero_copy_only=False)


def _entries_in(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, sets and tags of the dealt entries of one bucket."""
    low, high = _flat(table.column("low")), _flat(table.column("high"))
    keys = low.view(np.uint32) | high.view(np.uint8).astype(np.int64) << 32
    if len(keys):
        keys |= table.column("bucket")[0].as_py() << KEY_BITS
    return keys, _flat(table.column("b")), _flat(table.column("short")).view(np.uint16).astype(np.int32)


def _dealt(docs: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    """Lists by bucket and ``kind`` of what each task finds in its texts (see ``_candidates``)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    lists = (
        f"kind int, bucket int, a array<bigint>, b array<bigint>, tag array<int>, id array<{id_type}>, key array<string>, "
        "sketch array<bigint>, low array<int>, high array<tinyint>, short array<smallint>"
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0
        none = None

        def nodes(rows, digests: np.ndarray, sizes: np.ndarray, sketches: np.ndarray) -> pa.RecordBatch:
            # Dealt by place, so that equal texts do not meet in one bucket.
            place = np.arange(len(sizes), dtype=np.int64) * 7919 + len(seen)
            return _deal(NODE, digests[:, 0], digests[:, 1], sizes, _bucket_of(place, buckets), rows, sketches)

        def flush() -> Iterator[pa.RecordBatch]:
            keys, ids, tags = (np.concatenate(x) for x in zip(*parts))
            lists = Lists.of(keys, ids, tags)
            long = lists.long()
            # Long lists end here: the pairs with their first set and their entries go out, and
            # the first set alone stands for the list in the shuffle.
            a, b, first = lists.star(long, percent)
            a, b = _sorted_pairs(a, b)
            if len(a):
                yield _deal(PAIR, a, b, np.zeros(len(a)), _bucket_of(a, buckets), none)
            if long.any():
                ids = lists.ids[long]
                yield _deal(LONG, lists.keys[long], ids, lists.tags[long], _bucket_of(ids, buckets), none)
            stands = ~long
            heads = first[long[first]]
            stands[heads] = True
            lists.tags[heads] |= MORE
            yield _deal_entries(lists.keys[stands], lists.ids[stands], lists.tags[stands], none)

        for batch in batches:
            none = batch.select(["doc_id", "key"]).slice(0, 0)
            for part in slices_of_bytes(batch, "text", BATCH_BYTES, BATCH_ROWS):
                sets = HashedSets.of(part.column("text"), size, hashes)
                digests, sizes = sets.digests(), sets.sizes()
                by_plan: dict[Layout, list[int]] = {}
                for i, (own, n) in enumerate(zip(digests[:, 0].tolist(), sizes.tolist())):
                    if not n or own in seen:  # an equal set was dealt with in this task
                        continue
                    if len(seen) > CACHE_WORDS:
                        seen.clear()
                    seen.add(own)
                    for plan in layouts_of(n, percent):
                        by_plan.setdefault(plan, []).append(i)
                for plan, some in by_plan.items():
                    some = np.array(some)
                    shingles = np.concatenate([sets[i] for i in some])
                    owner = np.repeat(np.arange(len(some)), sizes[some])
                    keys, flags, owners = entries_of(shingles, owner, len(some), plan)
                    steps = np.array([size_step(int(n), plan.band) for n in sizes[some]], np.int64)
                    parts.append((short_keys(keys, buckets), digests[some, 0][owners], _tags(flags, plan.band, steps[owners])))
                    held += len(keys)
                if held >= FLUSH_ENTRIES:
                    yield from flush()
                    parts.clear()
                    held = 0
                yield nodes(part.select(["doc_id", "key"]), digests, sizes, sets.sketches())
        if parts:
            yield from flush()

    return docs.select("doc_id", "key", "text").mapInArrow(deal, lists)


def _candidates(docs: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    """Everything that one pass over the texts tells, in one table with a ``kind``.

    ``NODE``: a row of ``docs`` (``id, key``) with the digests ``a, b`` of its set, its size
    ``tag`` and its parity sketch. ``PAIR``: sets ``a, b`` to verify. ``LONG``: entry of a long list, key ``a`` and
    set ``b`` (sets go by their first digest).
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = f"kind int, a bigint, b bigint, tag int, id {id_type}, key string, sketch array<bigint>"

    def gather(table: pa.Table) -> pa.Table:
        node = table.filter(pc.equal(table.column("kind"), NODE))
        entries = _entries_in(table.filter(pc.equal(table.column("kind"), ENTRY)))
        table = table.filter(pc.is_in(table.column("kind"), pa.array([PAIR, LONG], pa.int32())))
        kind = np.repeat(
            table.column("kind").to_numpy(), pc.list_value_length(table.column("a")).to_numpy()
        )
        a, b, tag = (_flat(table.column(c)) for c in ("a", "b", "tag"))
        lists = Lists.of(*entries)
        long = lists.long()
        star_a, star_b, _ = lists.star(long, percent)
        short_a, short_b = lists.short_pairs(long, percent)
        pair_a, pair_b = _sorted_pairs(
            np.concatenate([a[kind == PAIR], star_a, short_a]), np.concatenate([b[kind == PAIR], star_b, short_b])
        )
        # Entries that already went out as parts of a long list are in the table as such.
        out = long & ((lists.tags & MORE) == 0)
        was = kind == LONG
        kinds = np.repeat(np.array([PAIR, LONG], np.int32), [len(pair_a), int(out.sum() + was.sum())])
        columns = [
            pa.array(kinds),
            pa.array(np.concatenate([pair_a, lists.keys[out], a[was]]).astype(np.int64)),
            pa.array(np.concatenate([pair_b, lists.ids[out], b[was]]).astype(np.int64)),
            pa.array(np.concatenate([np.zeros(len(pair_a)), lists.tags[out], tag[was]]).astype(np.int32)),
        ]
        values = [pc.list_flatten(node.column(c)).combine_chunks() for c in ("a", "b", "tag", "id", "key")]
        flat = pc.list_flatten(node.column("sketch")).combine_chunks()
        ends = pa.array(np.arange(0, len(flat) + 1, SKETCH_LONGS, dtype=np.int32))
        values.append(pa.ListArray.from_arrays(ends, flat))
        columns += [pa.nulls(len(kinds), v.type) for v in values[3:]]
        told = [pa.array(np.full(len(values[0]), NODE, np.int32)), *values]
        names = ["kind", "a", "b", "tag", "id", "key", "sketch"]
        return pa.concat_tables([pa.table(columns, names), pa.table(told, names)])

    return _dealt(docs, size, percent, buckets).groupBy("bucket").applyInArrow(gather, found)


def _may_be_similar(percent: int) -> str:
    """SQL condition on ``n, sketch`` and ``n2, sketch2``: too many differing bits exclude a pair."""
    apart = " + ".join(f"bit_count(sketch[{i}] ^ sketch2[{i}])" for i in range(SKETCH_LONGS))
    return f"({apart}) * {100 + percent} <= {100 - percent} * (n + n2)"


# --- the join ----------------------------------------------------------------------------


def _verify(
    pairs: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, percent: int, scratch: Scratch
) -> DataFrame:
    """The pairs of sets ``a, b`` (first digests) that reach the similarity, as whole digests.

    Only texts of sets in a pair are kept, one for each set.
    """
    needed = pairs.select(F.col("a").alias("d1")).unionByName(pairs.select(F.col("b").alias("d1"))).distinct()
    chosen = nodes.join(needed, "d1", "left_semi").groupBy("d1", "d2").agg(F.min("key").alias("key"))
    # Rows with one key agree in their text, so any of them will do; a set has one key, so that
    # they are grouped where they meet, and texts are not shuffled again for it.
    texts = scratch.write(
        docs.select("key", "text")
        .join(scratch.write(chosen, "chosen"), "key")
        .groupBy("key", "d1", "d2")
        .agg(F.min("text").alias("text"))
        .drop("key"),
        "texts",
    )
    left = texts.select(F.col("d1").alias("a"), F.struct("d1", "d2").alias("left"), F.col("text").alias("left_text"))
    right = texts.select(F.col("d1").alias("b"), F.struct("d1", "d2").alias("right"), F.col("text").alias("right_text"))
    both = pairs.join(left, "a").join(right, "b").select("left", "right", "left_text", "right_text")
    digest = "struct<d1:bigint,d2:bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for part in slices_of_bytes(batch, "right_text", BATCH_BYTES, BATCH_ROWS):
                # A text that stands in several pairs is cut once.
                texts = pa.concat_arrays([part.column("left_text"), part.column("right_text")]).dictionary_encode()
                hashed = HashedSets.of(texts.dictionary, size, cache)
                sizes = hashed.sizes()
                x, y = texts.indices.to_numpy().reshape(2, -1)
                whole: dict[int, set] = {}

                def words_in(i: int) -> set:
                    if i not in whole:
                        whole[i] = shingle_set(words_of(texts.dictionary[i].as_py()), size)
                    return whole[i]

                keep = []
                for i, j in zip(x.tolist(), y.tolist()):
                    # Sorted hashes tell most pairs apart; the words themselves decide on the others.
                    common = len(np.intersect1d(hashed[i], hashed[j], assume_unique=True))
                    good = 100 * common >= percent * (sizes[i] + sizes[j] - common)
                    if good:
                        common = len(words_in(i) & words_in(j))
                        good = 100 * common >= percent * (len(words_in(i)) + len(words_in(j)) - common)
                    keep.append(bool(good))
                yield pa.RecordBatch.from_arrays(part.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, f"a {digest}, b {digest}")


def _rest_of_long_lists(
    long: DataFrame, labels: DataFrame, sketches: DataFrame, percent: int, scratch: Scratch
) -> DataFrame:
    """Pairs of long lists whose sets are not yet in one component.

    Sets that have no more costly parts than their layout allows for leave these out. Of the
    rest, lists inside one component are done; the others give their pairs across components.
    """
    entries = scratch.write(
        long.select(
            F.col("a").alias("key"),
            F.col("b").alias("id"),
            F.col("tag").bitwiseAND(DELETED + PLAIN).alias("flags"),
            F.shiftright("tag", 4).bitwiseAND(127).alias("band"),
        ).distinct(),
        "entries",
    )
    seen = [r["band"] for r in entries.select("band").distinct().collect()]  # a hundred bands at most
    if not seen:
        return entries.select(F.col("id").alias("a"), F.col("id").alias("b"))
    allowance = F.create_map(*[F.lit(v) for b in seen for v in (b, layout(b, percent).deletions)])
    costly = entries.where(F.col("flags") == PLAIN).groupBy("id", "band").agg(F.count("*").alias("n"))
    spared = costly.where(F.col("n") <= allowance[F.col("band")]).select("id", "band", F.lit(PLAIN).alias("flags"))
    kept = entries.join(spared, ["id", "band", "flags"], "left_anti")
    # A first digest that two sets share belongs to both their components; the least will do.
    label = labels.groupBy(F.col("node.d1").alias("id")).agg(F.min("label.d1").alias("label"))
    placed = scratch.write(
        kept.join(label, "id", "left").withColumn("label", F.coalesce("label", "id")), "placed"
    )
    # A list of nothing but deletions gives no pairs: one side of a pair is always a whole part.
    deleted = F.col("flags").bitwiseAND(DELETED)
    mixed = placed.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.min(deleted).alias("deleted"))
    open_lists = scratch.write(placed.join(mixed.where("x != y and deleted = 0").select("key"), "key", "left_semi"), "open")
    open_lists = open_lists.join(sketches, "id")
    whole = open_lists.where(F.col("flags").bitwiseAND(DELETED) == 0)
    other = open_lists.select("key", *[F.col(c).alias(f"{c}2") for c in ("id", "flags", "label", "n", "sketch")])
    return (
        whole.join(other, "key")
        .where((F.col("label") != F.col("label2")) & F.expr(_may_be_similar(percent)))
        .where((F.col("flags2").bitwiseAND(DELETED) != 0) | (F.col("id") < F.col("id2")))
        .select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"))
        .distinct()
    )


def similar_documents(
    docs: DataFrame,
    shingle_words: int = 4,
    percent: int = 85,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Components of documents whose shingle sets have Jaccard ``percent`` / 100 or more.

    Equal sets are one node from the start. Lists of sets that share a part (see the module)
    are gathered by buckets of their key; a list that is long already in one task is closed
    there: only its first set goes on, its pairs with that set are candidates, and its entries
    are kept aside. Candidates whose parity sketches differ in more bits than similar sets may
    differ in shingles are excluded, which is exact; the others are verified on whole texts. Once components are
    known, the long lists that still hold several give their pairs across components, until
    then nothing is paired twice inside a group of near copies. No link between components is
    lost: each pair that reaches the similarity shares a list, and is verified there or lies
    in one component already.

    Words are cut at ASCII white space after A-Z became lower case. A text of fewer words than
    a shingle is one shingle. Null texts and texts without words have no shingles and are
    linked with nothing, their component is their own id. Rows that repeat are in one
    component. Null ids count as rows but name a component only if it has no other. An empty
    table gives no rows; other columns are not read.

    Returns ``doc_id, n_shingles, component_id`` (the smallest id of the component).
    """
    scratch = Scratch(docs.sparkSession, "ngrams")
    own = docs.select(
        docs[id_col].alias("doc_id"), row_key(docs[id_col], docs[text_col]).alias("key"), docs[text_col].alias("text")
    )
    # About six bytes a word; a set is in one layout or two, with a key for a sixth of its shingles.
    size = docs.agg(F.sum(F.octet_length(docs[text_col]))).first()[0] or 0
    buckets = min(max(8, math.ceil(size / 6 * 0.4 / BUCKET_ENTRIES)), MOST_BUCKETS)
    found = scratch.write(_candidates(own, shingle_words, percent, buckets), "found")
    nodes = found.where(F.col("kind") == NODE).select(
        F.col("id").alias("doc_id"),
        "key",
        F.col("tag").cast("bigint").alias("n_shingles"),
        F.col("a").alias("d1"),
        F.col("b").alias("d2"),
    )
    sketches = scratch.write(
        found.where((F.col("kind") == NODE) & (F.col("tag") > 0))
        .groupBy(F.col("a").alias("id"), F.col("b").alias("d2"))
        .agg(F.min("tag").alias("n"), F.min("sketch").alias("sketch"))
        .drop("d2"),
        "sketches",
    )
    other = sketches.select(*[F.col(c).alias(f"{c}2") for c in sketches.columns])
    pairs = scratch.write(
        found.where(F.col("kind") == PAIR)
        .select("a", "b")
        .distinct()
        .join(sketches, F.col("a") == F.col("id"))
        .join(other, F.col("b") == F.col("id2"))
        .where(_may_be_similar(percent))
        .select("a", "b")
        .distinct(),
        "pairs",
    )
    links = scratch.write(_verify(pairs, own, nodes, shingle_words, percent, scratch), "links")
    labels = connected_components(links, scratch)
    rest = _rest_of_long_lists(found.where(F.col("kind") == LONG), labels, sketches, percent, scratch)
    rest = scratch.write(rest.join(pairs, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = scratch.write(_verify(rest, own, nodes, shingle_words, percent, scratch), "more")
        labels = connected_components(links.unionByName(more), scratch)
    node = F.struct("d1", "d2")
    classes = nodes.where("n_shingles > 0").groupBy(node.alias("node")).agg(F.min("doc_id").alias("least"))
    placed = scratch.write(
        classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "classes"
    )
    smallest = placed.groupBy("label").agg(F.min("least").alias("component_id"))
    by_node = placed.join(smallest, "label").select("node", "component_id")
    joined = nodes.withColumn("node", F.when(F.col("n_shingles") > 0, node)).join(by_node, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"))
