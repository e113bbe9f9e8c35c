"""Language of a text: the language whose sample lets it be compressed best."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_AT_ONCE = 64
#: Bytes of a piece of training text, and of a dictionary.
PIECE_BYTES = 400
DICTIONARY_BYTES = 64 * 1024
#: A text is compressed in chunks of this size, so that the dictionary counts all along.
CHUNK_BYTES = 2048
PIECES_PER_ROW = 4
MAX_LANGUAGES = 1000
UNKNOWN = "und"


def learn(train: DataFrame, rows_per_language: int = 2000, text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """A dictionary of raw text per language.

    Reads all rows of ``train`` to count languages, then about ``rows_per_language`` rows of
    each, drawn by the hash of their text, cuts some pieces from places all over each text and
    takes pieces in hash order until the dictionary is full. Rows without language or without
    a letter teach nothing. What reaches the driver is one dictionary per language, at most
    ``MAX_LANGUAGES``.
    """
    rows = train.select(train[lang_col].alias("lang"), train[text_col].alias("text")).where(
        "lang is not null and text rlike '\\\\p{L}'"
    )
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    found = counts.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not found:
        return {}
    share = F.create_map(*[x for r in found for x in (F.lit(r["lang"]), F.lit(rows_per_language / r["n"]))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.lower().encode()
                places = range(0, len(data), PIECE_BYTES)
                step = max(1, len(places) // PIECES_PER_ROW)
                for at in places[::step]:
                    piece = data[at : at + PIECE_BYTES]
                    out.append((lang, hashlib.blake2b(piece, digest_size=8).digest(), piece))
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())],
                ["lang", "draw", "piece"],
            )

    in_order = Window.partitionBy("lang").orderBy("draw", "piece")
    chosen = (
        rows.where(draw < share[F.col("lang")])
        .mapInArrow(pieces, "lang string, draw binary, piece binary")
        .distinct()
        .withColumn("number", F.row_number().over(in_order))  # over a bounded sample
        .where(F.col("number") <= 2 * DICTIONARY_BYTES // PIECE_BYTES)
        .orderBy("lang", "number")
        .collect()
    )
    out: dict[str, bytes] = {}
    for row in chosen:
        out[row["lang"]] = (out.get(row["lang"], b"") + bytes(row["piece"]))[:DICTIONARY_BYTES]
    return out


class Classifier:
    """Compressed sizes by language."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 3):
        self.compress = {}
        for lang, data in sorted(dictionaries.items()):
            prepared = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            prepared.precompute_compress(level=level)
            self.compress[lang] = zstandard.ZstdCompressor(
                level=level, dict_data=prepared, write_content_size=False, write_dict_id=False
            ).compress

    def sizes(self, text: str) -> dict[str, int]:
        data = text.lower().encode()
        chunks = [data[i : i + CHUNK_BYTES] for i in range(0, len(data), CHUNK_BYTES)]
        return {lang: sum(map(len, map(compress, chunks))) for lang, compress in self.compress.items()}

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin; ``und`` without a letter."""
        if not self.compress or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(text)
        best = min(sizes, key=lambda lang: (sizes[lang], lang))
        second = min((n for lang, n in sizes.items() if lang != best), default=2 * sizes[best])
        margin = (second - sizes[best]) / second
        return best, 1 / (1 + math.exp(-MARGIN_SCALE * margin)), margin


#: Scores grow with the margin: none gives one half, a tenth about 0.95.
MARGIN_SCALE = 30.0


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    min_margin: float = 0.01,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Language per document by compression with each language's dictionary.

    The whole text, in lower case, is compressed in chunks with every dictionary; the
    language with the smallest total wins, the first by name on a tie. A margin over the
    second below ``min_margin`` is too narrow: ``rejected`` is true and ``lang`` is null,
    while ``lang_pred`` still names the smallest. Null texts, texts without a letter and
    everything when no dictionary was learned are ``und`` with score 0, and rejected.

    One pass without a shuffle. Rows that repeat are judged alike, an empty table gives no
    rows, other columns are not read.

    Returns ``doc_id, lang_pred, score, margin, lang, rejected``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)  # MAX_LANGUAGES dictionaries at most
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("lang_pred", T.StringType(), False),
            T.StructField("score", T.DoubleType(), False),
            T.StructField("margin", T.DoubleType(), False),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(sent.value).classify
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                langs, scores, margins = zip(*map(classify, some.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(langs), pa.array(scores), pa.array(margins)], schema.names
                )

    narrow = (F.col("margin") < min_margin) | (F.col("lang_pred") == UNKNOWN)
    return (
        docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
        .mapInArrow(run, schema)
        .select("*", F.when(~narrow, F.col("lang_pred")).alias("lang"), narrow.alias("rejected"))
    )
