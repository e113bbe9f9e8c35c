"""Quality verdicts from compression ratios, beside counts of words, symbols and repeats."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SYMBOLS = re.compile(r"[#*$%&|<>]")
ROWS_AT_ONCE = 64
BREAKS = " \t\n\x0b\x0c\r"


#: Lowest and highest ratio (original bytes per compressed byte) of a text of so many bytes, with
#: straight lines over the logarithm of the size between them. Repetition lies above, encoded or
#: random data below. Around each size, the 0.5th and 99.5th percentile of the documents of sf0.1
#: with label quality = 1 whose ``crc32(doc_id)`` is even (1,696 that pass the base rule), and
#: 0.04 to 0.1 beyond. The last size has no labelled documents and is wide.
LIMITS = (
    (64, 0.64, 1.14),
    (96, 0.8, 1.3),
    (128, 0.93, 1.41),
    (192, 1.11, 1.57),
    (256, 1.25, 1.67),
    (384, 1.36, 1.71),
    (512, 1.4, 1.82),
    (768, 1.55, 1.93),
    (1_024, 1.67, 2.01),
    (1_536, 1.78, 2.09),
    (2_048, 1.84, 2.17),
    (3_072, 1.94, 2.24),
    (4_096, 2.03, 2.31),
    (6_144, 2.1, 2.38),
    (8_192, 2.13, 2.42),
    (12_288, 2.19, 2.46),
    (16_384, 2.19, 2.53),
    (32_768, 2.28, 2.62),
    (131_072, 1.8, 3.2),
)
#: A text is judged by chunks of the first size that it reaches.
CHUNK_SIZES = (1024, 256)
#: A text is rejected if more than this part of its chunks lies outside the limits of their size.
BAD_CHUNKS = 0.1


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of one text."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only
    chars = len(text) - sum(map(text.count, BREAKS))
    lines = [line for line in text.split("\n") if line.strip(BREAKS)]
    return (
        len(words),
        chars,
        len(SYMBOLS.findall(text)),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def repeat_words(words: list[bytes], size: int = 5) -> int:
    """Words that lie in a window of ``size`` words which occurs twice or more."""
    windows = list(zip(*[words[i:] for i in range(size)]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    edge = np.zeros(len(words) + 1, np.int64)
    for i, w in enumerate(windows):
        if counts[w] > 1:
            edge[i] += 1
            edge[i + size] -= 1
    return int((np.cumsum(edge)[:-1] > 0).sum())


def ratios(data: bytes, compress) -> tuple[float, int, list[float]]:
    """Of the whole text and of each chunk, whose size comes between; the last chunk ends with the text."""
    whole = len(data) / len(compress(data))
    size = next((s for s in CHUNK_SIZES if s <= len(data)), 0)
    if not size:
        return whole, 0, []
    starts = [*range(0, len(data) - size, size), len(data) - size]
    return whole, size, [size / len(compress(data[i : i + size])) for i in starts]


def within(size: int, ratio: float, limits: tuple = LIMITS) -> bool:
    sizes, lowest, highest = zip(*limits)
    at = np.log(size)
    return bool(np.interp(at, np.log(sizes), lowest) <= ratio <= np.interp(at, np.log(sizes), highest))


def bad_chunks(size: int, chunks: list[float], limits: tuple = LIMITS) -> int:
    return sum(not within(size, r, limits) for r in chunks)


def fit_limits(
    good: DataFrame,
    sizes: tuple[int, ...] = tuple(x[0] for x in LIMITS),
    tail: float = 0.005,
    margin: float = 0.05,
    least_rows: int = 20,
    wide: float = 0.5,
    max_rows: int = 20_000,
    level: int = 3,
    text_col: str = "text",
) -> tuple[tuple[int, float, float], ...]:
    """Limits as ``LIMITS`` from texts known to be good, for another corpus.

    The ratio of whole texts follows the logarithm of their size. Around each of ``sizes`` (as far as
    half way to its neighbours) a straight line is taken through the ratios; the limits are the ``tail`` and
    ``1 - tail`` quantiles of the distances from it, ``margin`` beyond. Where fewer than
    ``least_rows`` texts are near, the limits are ``wide`` apart from those of the next size that has them.
    Texts that fail the base rule should be left out before. About ``max_rows`` texts at most are
    used, drawn by their hash; empty and null ones are not. Without any text the result is ``LIMITS``.
    """
    rows = good.select(good[text_col].alias("text")).where("text is not null and octet_length(text) > 0")
    n = rows.count()
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=level, write_content_size=False).compress
        for batch in batches:
            data = [t.encode("utf-8", "surrogatepass") for t in batch.column(0).to_pylist()]
            columns = [[len(d) for d in data], [len(d) / len(compress(d)) for d in data]]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.float64())], ["size", "ratio"])

    # At most about max_rows pairs of numbers.
    sample = rows.where(draw < min(1.0, max_rows / max(n, 1))).mapInArrow(measure, "size bigint, ratio double").toArrow()
    at, ratio = np.log(np.maximum(1, sample.column("size").to_numpy())), sample.column("ratio").to_numpy()
    marks = np.log(sizes)
    edges = np.concatenate([[-np.inf], (marks[1:] + marks[:-1]) / 2, [np.inf]])
    out: list[tuple[int, float, float] | None] = []
    for size, mark, low, high in zip(sizes, marks, edges[:-1], edges[1:]):
        near = (at >= low) & (at < high)
        if near.sum() < least_rows:
            out.append(None)
            continue
        slope, middle = np.polyfit(at[near] - mark, ratio[near], 1) if np.ptp(at[near]) > 1e-9 else (0.0, ratio[near].mean())
        apart = ratio[near] - slope * (at[near] - mark) - middle
        ends = np.quantile(apart, [tail, 1 - tail]) + middle
        out.append((size, round(float(ends[0] - margin), 2), round(float(ends[1] + margin), 2)))
    known = [i for i, x in enumerate(out) if x]
    if not known:
        return LIMITS
    for i, x in enumerate(out):
        if x is None:
            _, low, high = out[min(known, key=lambda k: abs(k - i))]
            out[i] = (sizes[i], round(low - wide, 2), round(high + wide, 2))
    return tuple(out)


def judge_quality(
    docs: DataFrame,
    min_words: int = 10,
    max_repeat_percent: int = 20,
    level: int = 3,
    limits: tuple = LIMITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Counts per document and whether it is kept.

    A document fails the base rule with fewer than ``min_words`` words, or if more than
    ``max_repeat_percent`` of its words lie in windows of five words that repeat. The others
    are compressed with zstandard, whole and in chunks (``CHUNK_SIZES``; the last one ends with
    the text). They are kept if the ratio of the whole lies within the limits for its length
    (``limits``, see :func:`fit_limits`) and at most ``BAD_CHUNKS`` of the chunks lie outside those for theirs: too
    high a ratio is repetition, too low a ratio is noise, such as encoded data.

    One pass, no shuffle, memory bounded by a few rows of text. Null and empty texts have no
    words and are not kept; their ratio is null. Repeated rows are judged one by one, an
    empty table gives no rows, other columns are not read.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, ratio, n_bad_chunks``.
    """
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType)]
        + [T.StructField(c, T.LongType(), False) for c in longs]
        + [T.StructField(c, T.BooleanType(), False) for c in ("base_failed", "kept")]
        + [T.StructField("ratio", T.DoubleType()), T.StructField("n_bad_chunks", T.LongType())]
    )

    def judge(text: str, compress) -> tuple:
        counts = base_counts(text)
        failed = counts[0] < min_words or 100 * counts[4] > max_repeat_percent * counts[0]
        if not counts[0]:
            return (*counts, failed, False, None, None)
        data = text.encode("utf-8", "surrogatepass")
        whole, size, chunks = ratios(data, compress)
        bad = bad_chunks(size, chunks, limits)
        kept = not failed and within(len(data), whole, limits) and bad <= BAD_CHUNKS * len(chunks)
        return (*counts, failed, kept, whole, bad)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=level, write_content_size=False).compress
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                rows = [judge(t or "", compress) for t in some.column(1).to_pylist()]
                types = [f.dataType for f in schema.fields[1:]]
                arrow = {T.LongType(): pa.int64(), T.BooleanType(): pa.bool_(), T.DoubleType(): pa.float64()}
                columns = [pa.array(c, arrow[t]) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([some.column(0), *columns], schema.names)

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)
