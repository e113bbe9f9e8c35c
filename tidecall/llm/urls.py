"""Allow and block rules for URLs, held in cascades of Bloom filters."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecall.llm.common import Scratch, lower_ascii

#: A level that needs more bits than this is not broadcast; its keys are joined instead.
MAX_LEVEL_BITS = 1 << 29
FALSE_POSITIVES = 0.02


# --- one level ---------------------------------------------------------------------------


@dataclass
class Level:
    """A Bloom filter: ``words`` holds its bits."""

    number: int
    bits: int
    hashes: int
    words: np.ndarray

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = positions(h1, h2, self.number, self.bits, self.hashes)
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=0)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x.view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """Bit positions per hash function; each level draws its own."""
    a, b = _mix(h1, 2 * level + 1), _mix(h2, 2 * level + 2) | np.uint64(1)
    return np.stack([((a + np.uint64(i) * b) % np.uint64(bits)).astype(np.int64) for i in range(hashes)])


def build_level(keys: DataFrame, n: int, number: int) -> Level:
    """The bits of ``n`` keys ``(h1, h2)``: words are combined by a distributed aggregate."""
    bits = max(64, 1 << math.ceil(math.log2(max(n, 1) * -math.log(FALSE_POSITIVES) / math.log(2) ** 2)))
    hashes = max(1, min(12, round(bits / max(n, 1) * math.log(2))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(positions(_longs(batch.column(0)), _longs(batch.column(1)), number, bits, hashes))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(at & 63)], ["word", "bit"])

    found = (
        keys.select("h1", "h2")
        .mapInArrow(run, "word long, bit long")
        .groupBy("word")
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit as int)))").alias("value"))
        .toArrow()  # at most bits / 64 rows, and bits are bounded
    )
    words = np.zeros(bits // 64, np.int64)
    words[_longs(found.column("word").combine_chunks())] = _longs(found.column("value").combine_chunks())
    return Level(number, bits, hashes, words.view(np.uint64))


def _longs(column: pa.Array) -> np.ndarray:
    return np.ascontiguousarray(column.to_numpy(zero_copy_only=False), dtype=np.int64)


# --- the cascade -------------------------------------------------------------------------


class Cascade:
    """Exact membership for all keys of one universe, without a join.

    Level 0 holds the listed keys of the universe, level 1 the unlisted keys that pass level
    0, level 2 the listed keys that pass level 1, and so on until nothing passes wrongly. A
    key is listed if the first level that refuses it has an odd number, or if it passes all
    levels and the last has an even one.
    """

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @classmethod
    def build(cls, universe: DataFrame, scratch: Scratch) -> Cascade | None:
        """From distinct ``(h1, h2, listed)``; None if a level would be too large to send out."""
        inside = universe.where("listed").select("h1", "h2")
        outside = universe.where("not listed").select("h1", "h2")
        levels: list[Level] = []
        n = inside.count()
        while n:
            if n * 16 > MAX_LEVEL_BITS:
                return None
            levels.append(level := build_level(inside, n, len(levels)))
            passing = scratch.write(_passing(outside, level), f"passing-{level.number}")
            n, inside, outside = passing.count(), passing, inside
        return cls(levels)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        answer = np.zeros(len(h1), bool)
        at = np.arange(len(h1))
        for level in self.levels:
            at = at[level.contains(h1[at], h2[at])]
            answer[at] = level.number % 2 == 0
        return answer


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passes = level.contains(_longs(batch.column(0)), _longs(batch.column(1)))
            yield batch.filter(pa.array(passes))

    return keys.mapInArrow(run, keys.schema)


# --- rules over URLs ---------------------------------------------------------------------


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty without a ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def _keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Host suffixes of these numbers of labels, each with path prefixes of these lengths."""
    count = F.size(F.split(host, r"\."))
    suffixes = [F.when(count >= n, F.substring_index(host, ".", -n)) for n in labels]
    prefixes = [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]
    keys = F.array(*[F.concat(s, p) for s in suffixes for p in prefixes])
    return F.filter(keys, lambda k: k.isNotNull())


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Verdict per URL by the longest rule that fits its host, a parent domain, and its path.

    ``rules`` has ``host, path, action`` (``allow`` or ``block``) and ``listed`` (boolean): a
    listed row is a domain of the block list, which counts only where no rule proper fits.
    Every candidate key of a URL (host suffix and path prefix, of the sizes that occur among
    the rules) belongs to the universe; three cascades answer for it: is it a rule, is that
    rule a block, is it a listed domain. The keys themselves stay where they are: pages are
    never joined or shuffled. Filters are broadcast up to a bound of bits per level, checked
    before; a longer list is joined on the keys' hashes instead.

    Null URLs and URLs without ``://`` have empty host and path and get ``default``. Rows that
    repeat are judged one by one, an empty table gives no rows, other columns are not read.
    Without rules everything gets ``default``.

    Returns ``page_id, host, path, rule, verdict, listed``.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    sizes = rules.agg(
        F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
        F.collect_set(F.length("path")).alias("lengths"),
    ).first()  # distinct sizes, bounded by the longest URL
    labels, lengths = sorted(sizes["labels"]) or [1], sorted(sizes["lengths"]) or [0]
    host, path = split_url(pages[url_col])
    parts = pages.select(pages[id_col].alias("page_id"), host.alias("host"), path.alias("path"))
    keyed = parts.withColumn(
        "keys",
        F.transform(
            _keys(F.col("host"), F.col("path"), labels, lengths),
            lambda k: F.struct(k.alias("key"), F.xxhash64(k).alias("h1"), F.xxhash64(k, F.lit(1)).alias("h2")),
        ),
    )
    key = F.concat(F.lower("host"), "path")
    listed_keys = rules.select(
        F.xxhash64(key).alias("h1"),
        F.xxhash64(key, F.lit(1)).alias("h2"),
        (~F.col("listed")).alias("rule"),
        (~F.col("listed") & (F.col("action") == "block")).alias("block"),
        F.col("listed").alias("domain"),
    )
    seen = keyed.select(F.explode("keys").alias("k")).select("k.h1", "k.h2").distinct()
    kinds = ("rule", "block", "domain")
    none = [F.lit(False).alias(k) for k in kinds]
    universe = scratch.write(
        seen.select("h1", "h2", *none, F.lit(True).alias("seen"))
        .unionByName(listed_keys.withColumn("seen", F.lit(False)))
        .groupBy("h1", "h2")
        .agg(*[F.max(c).alias(c) for c in (*kinds, "seen")])
        .where("seen"),
        "universe",
    )
    cascades = {k: Cascade.build(universe.select("h1", "h2", F.col(k).alias("listed")), scratch) for k in kinds}
    if all(cascades.values()):
        judged = _ask(keyed, cascades)
    else:
        judged = _join(keyed, universe.where("rule or block or domain"), kinds)
    # A hit is (length, key, rule, block, domain); the longest rule wins.
    hits = F.filter("hits", lambda h: h["rule"])
    best = F.array_max(F.transform(hits, lambda h: F.struct(F.length(h["key"]).alias("n"), h["key"].alias("key"), h["block"].alias("block"))))
    domain = F.exists("hits", lambda h: h["domain"])
    return judged.select("page_id", "host", "path", best.alias("best"), domain.alias("listed")).select(
        "page_id",
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.when(F.col("best").isNotNull(), F.when(F.col("best.block"), "block").otherwise("allow"))
        .when(F.col("listed"), "block")
        .otherwise(default)
        .alias("verdict"),
        "listed",
    )


def _ask(keyed: DataFrame, cascades: dict[str, Cascade]) -> DataFrame:
    sent = keyed.sparkSession.sparkContext.broadcast(cascades)
    hit = "struct<key:string,rule:boolean,block:boolean,domain:boolean>"
    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema.fields[:3])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(3)
            flat = keys.flatten()
            h1, h2 = _longs(flat.field("h1")), _longs(flat.field("h2"))
            answers = [pa.array(c.contains(h1, h2)) for c in sent.value.values()]
            values = pa.StructArray.from_arrays([flat.field("key"), *answers], ["key", *sent.value])
            counts = keys.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            hits = pa.ListArray.from_arrays(offsets, values)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], hits], ["page_id", "host", "path", "hits"])

    return keyed.mapInArrow(run, f"{head}, hits array<{hit}>")


def _join(keyed: DataFrame, listed: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """The same answers by a join on the keys' hashes, for lists that are too long to send out."""
    rows = keyed.withColumn("row", F.monotonically_increasing_id())
    flat = rows.select("page_id", "host", "path", "row", F.explode_outer("keys").alias("k"))
    joined = flat.join(
        listed.select(F.col("h1").alias("l1"), F.col("h2").alias("l2"), *kinds),
        (F.col("k.h1") == F.col("l1")) & (F.col("k.h2") == F.col("l2")),
        "left",
    )
    flags = [F.coalesce(F.col(k), F.lit(False)).alias(k) for k in kinds]
    hit = F.when(F.col("l1").isNotNull(), F.struct(F.col("k.key").alias("key"), *flags))
    return joined.groupBy("row").agg(
        *[F.first(c).alias(c) for c in ("page_id", "host", "path")], F.collect_list(hit).alias("hits")
    )
