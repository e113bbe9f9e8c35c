"""Periodic runs of words by internal pattern matching.

A run is a longest stretch of words with a smallest period ``q`` and at least four periods. Texts
of a batch stand behind each other, each with word codes of its own, and are sorted by prefix
doubling. After the step for ``m`` words all places with equal ``m`` words are one interval of
the suffix array. For every block of ``m`` words at a multiple of ``m`` (dyadic blocks) a
wavelet tree over the suffix array finds the block's occurrences in a window behind it: how many
there are, the first and the last (range successor queries). Windows are shorter than blocks, so
occurrences are in arithmetic progression and these three tell all of them.

Which windows. A run of period ``q`` and length ``4 q`` holds an aligned block together with its
copy ``q`` further on if ``2 m - 1 <= 3 q``. Blocks of ``m`` words therefore serve the periods
from ``(2 m - 1) / 3`` up to where blocks of ``2 m`` begin.

Which candidates. One or two occurrences give one candidate period each. Three or more have a
common difference ``p`` and lie in one stretch of period ``p``; a run of the larger period ``q``
repeats the block's own stretch of period ``p``, so ``q`` is the distance of the ends of
these two stretches. Candidates of neighbouring blocks join; their ends are extended word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidecall.llm.common import ascii_words, slices_of_bytes

#: Text that is sorted at once, unless a single text is longer.
BATCH_BYTES = 4 << 20
#: Cells of a table of word comparisons.
CELLS = 1 << 21


# --- wavelet tree ------------------------------------------------------------------------


class WaveletTree:
    """Counts and order statistics of the values in any stretch of an array of small integers."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = max(1, int(self.n - 1).bit_length() if self.n else 1)
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        for bit in range(self.bits - 1, -1, -1):
            zero = ((values >> bit) & 1) == 0
            packed = np.zeros(self.n // 64 + 1, np.uint64)
            raw = np.packbits(zero, bitorder="little")
            packed.view(np.uint8)[: len(raw)] = raw
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed[:-1]), dtype=np.int64)])
            self.levels.append((packed, before, int(zero.sum())))
            values = np.concatenate([values[zero], values[~zero]])

    @staticmethod
    def _zeros(level: tuple[np.ndarray, np.ndarray, int], at: np.ndarray) -> np.ndarray:
        """Zero bits before each place."""
        packed, before, _ = level
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(packed[word] & mask)

    def count_below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Values less than ``bound`` among those at ``low <= place < high``."""
        total = np.where(bound >= 1 << self.bits, high - low, 0)
        low, high = low.copy(), high.copy()
        high[bound >= 1 << self.bits] = low[bound >= 1 << self.bits]
        for i, level in enumerate(self.levels):
            zeros_low, zeros_high = self._zeros(level, low), self._zeros(level, high)
            one = ((bound >> (self.bits - 1 - i)) & 1) == 1
            total += np.where(one, zeros_high - zeros_low, 0)
            low = np.where(one, level[2] + low - zeros_low, zeros_low)
            high = np.where(one, level[2] + high - zeros_high, zeros_high)
        return total

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value with ``k`` smaller ones among those at ``low <= place < high``."""
        value = np.zeros(len(low), np.int64)
        k = k.copy()
        for i, level in enumerate(self.levels):
            zeros_low, zeros_high = self._zeros(level, low), self._zeros(level, high)
            inside = zeros_high - zeros_low
            one = k >= inside
            value |= one.astype(np.int64) << (self.bits - 1 - i)
            k = np.where(one, k - inside, k)
            low = np.where(one, level[2] + low - zeros_low, zeros_low)
            high = np.where(one, level[2] + high - zeros_high, zeros_high)
        return value


# --- blocks and their intervals ----------------------------------------------------------


def _first_period(m: int) -> int:
    """The smallest period that blocks of ``m`` words serve."""
    return 1 if m == 2 else -(-(2 * m - 1) // 3)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: where the group of each entry begins, and its size."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    return np.repeat(starts, sizes), np.repeat(sizes, sizes)


def _sorted_blocks(codes: np.ndarray, longest: int) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """Aligned blocks that occur more than once, by length: ``(m, start, low, high)``.

    ``low`` and ``high`` bound the block's places in the suffix array. Returns them with the
    array and with the part of it that any block of two words or more needs.
    """
    n = len(codes)
    suffixes = np.argsort(codes, kind="stable")
    head, size = _groups(codes[suffixes])
    rank = np.empty(n, np.int64)
    rank[suffixes] = head
    places = np.flatnonzero(size > 1)
    blocks, needed = [], np.zeros(n, bool)
    m = 1
    while len(places) and 4 * _first_period(2 * m) <= longest:
        at = suffixes[places]
        behind = np.where(at + m < n, rank[np.minimum(at + m, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        suffixes[places] = at
        head, size = _groups(key)
        rank[at] = places[head]
        places, at, size = places[size > 1], at[size > 1], size[size > 1]
        m *= 2
        if m == 2:
            needed[places] = True
        aligned = (at & (m - 1)) == 0
        low = rank[at[aligned]]
        blocks.append((m, at[aligned], low, low + size[aligned]))
    return blocks, suffixes, needed


# --- candidates and runs -----------------------------------------------------------------


def _first_mismatch(codes: np.ndarray, start: np.ndarray, shift: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """How many words from ``start`` on (backwards if ``step`` is -1) equal those ``shift`` further; up to ``width``."""
    n = len(codes)
    out = np.empty(len(start), np.int64)
    for low in range(0, len(start), max(1, CELLS // width)):
        part = slice(low, low + max(1, CELLS // width))
        x = start[part, None] + step * np.arange(width)
        y = x + shift[part, None]
        differ = (x < 0) | (y >= n)
        differ |= codes[np.clip(x, 0, n - 1)] != codes[np.clip(y, 0, n - 1)]
        out[part] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return out


def _candidates(codes: np.ndarray, m: int, start: np.ndarray, count: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Blocks with the periods that their occurrences (a progression) allow for."""
    few = count <= 2
    starts = [start[few], start[count == 2]]
    periods = [(first - start)[few], (last - start)[count == 2]]
    many = ~few
    s, f, e = start[many], first[many], last[many]
    if len(s):
        p = (e - f) // (count[many] - 1)
        own = _first_mismatch(codes, s, p, 2 * m)
        q = e + _first_mismatch(codes, e, p, 3 * m) - s - own
        fits = (own < 2 * m) & (q >= f - s) & (q <= e - s) & ((q - f + s) % p == 0)
        starts.append(s[fits])
        periods.append(q[fits])
    return np.concatenate(starts), np.concatenate(periods)


def _extended(codes: np.ndarray, m: int, start: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Maximal stretches ``start, end, period`` around blocks that equal their copies ``q`` further."""
    order = np.lexsort((start, q))
    start, q = start[order], q[order]
    joined = np.concatenate([[False], (q[1:] == q[:-1]) & (start[1:] == start[:-1] + m)]) if len(q) else np.zeros(0, bool)
    heads = np.flatnonzero(~joined)
    low, q = start[heads], q[heads]
    high = start[np.append(heads[1:], len(start)) - 1] + m if len(heads) else low
    for side in (1, -1):
        open_ = np.arange(len(low))
        while len(open_):
            at = high[open_] if side == 1 else low[open_] - 1
            more = _first_mismatch(codes, at, q[open_], m, side)
            if side == 1:
                high[open_] += more
            else:
                low[open_] -= more
            open_ = open_[more == m]
    return np.stack([low, high + q, q], axis=1)


def find_runs(codes: np.ndarray, longest: int, min_length: int = 6, exponent: int = 4) -> np.ndarray:
    """All runs ``start, end, period`` of an array of codes, by start and period.

    ``longest`` is the length of the longest text in it; texts share no code.
    """
    found = [np.zeros((0, 3), np.int64)]
    blocks, suffixes, needed = _sorted_blocks(codes, longest) if len(codes) else ([], codes, codes)
    blocks = [b for b in blocks if len(b[1])]
    if blocks:
        # The tree holds only places that a block asks for, numbered in the order of the text.
        values = np.sort(suffixes[needed])
        number = np.zeros(len(codes), np.int64)
        number[values] = np.arange(len(values))
        tree = WaveletTree(number[suffixes[needed]])
        place = np.concatenate([[0], np.cumsum(needed)])
        upto = np.zeros(len(codes) + 1, np.int64)
        upto[values + 1] = 1
        upto = np.cumsum(upto)
        for m, start, low, high in blocks:
            low, high = place[low], place[high]
            least, most = _first_period(m), _first_period(2 * m) - 1
            window = np.minimum(start + least, len(codes)), np.minimum(start + most + 1, len(codes))
            before = tree.count_below(low, high, upto[window[0]])
            count = tree.count_below(low, high, upto[window[1]]) - before
            hit = count > 0
            start, low, high, before, count = (a[hit] for a in (start, low, high, before, count))
            first = values[tree.smallest(low, high, before)]
            last = values[tree.smallest(low, high, before + count - 1)]
            found.append(_extended(codes, m, *_candidates(codes, m, start, count, first, last)))
    runs = np.concatenate(found)
    length = runs[:, 1] - runs[:, 0]
    runs = runs[(length >= min_length) & (length >= exponent * runs[:, 2])]
    # A stretch that is found with several periods has the smallest; the others are its multiples.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[fresh]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


# --- over tables -------------------------------------------------------------------------


def _collapse(texts: pa.Array, min_length: int, exponent: int) -> list[pa.Array]:
    """Number of words, runs and collapsed text of each text."""
    words, offsets = ascii_words(texts)
    sizes = np.diff(offsets)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    coded = words.dictionary_encode()
    mixed = text_of * np.int64(max(1, len(coded.dictionary))) + coded.indices.to_numpy(zero_copy_only=False)
    runs = find_runs(mixed, int(sizes.max(initial=0)), min_length, exponent)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 1], -1)
    kept = np.cumsum(edges[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(kept)])[offsets]
    lists = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), words.filter(pa.array(kept)))
    owner = text_of[runs[:, 0]]
    told = pa.StructArray.from_arrays(
        [pa.array(x) for x in (runs[:, 0] - offsets[owner], runs[:, 1] - runs[:, 0], runs[:, 2])],
        ["start", "length", "period"],
    )
    borders = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    return [pa.array(sizes), pa.ListArray.from_arrays(pa.array(borders), told), pc.binary_join(lists, " ")]


def collapse_runs(
    docs: DataFrame, min_length: int = 6, exponent: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The periodic runs of every text, and the text with one period left of each.

    Words are cut at ASCII white space. A run is a stretch of words with smallest period ``q``
    and a length of at least ``min_length`` and ``exponent * q`` that cannot grow and keep its
    period. A word goes if any run holds it behind that run's first ``q`` words; the others
    are joined by single spaces. Stretches of fewer than four periods are not looked for, so
    ``exponent`` must be 4 or more.

    Texts never meet: this is one pass without a shuffle, whole texts, however long. Memory is
    about 100 bytes a word of one text, or of 4 MB of shorter ones. A null text and one without
    words have no runs and the empty text. Rows that repeat and null ids are rows like others,
    an empty table gives none; other columns are not read.

    Returns ``doc_id, n_words, runs, collapsed``; ``runs`` holds ``start`` (words from 0),
    ``length`` and ``period``, by start and period.
    """
    if exponent < 4:
        raise ValueError("runs of fewer than four periods are not looked for")
    own = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_of_bytes(batch, "text", BATCH_BYTES):
                columns = [part.column("doc_id"), *_collapse(part.column("text"), min_length, exponent)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    id_type = own.schema["doc_id"].dataType.simpleString()
    runs = "array<struct<start:bigint,length:bigint,period:bigint>>"
    return own.mapInArrow(run, f"doc_id {id_type}, n_words bigint, runs {runs}, collapsed string")
