"""Documents with everything that may go wrong in a table."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside or return.
        *[
            T.StructField(c, T.StringType())
            for c in ("row", "spans", "words", "key", "node", "label", "score", "n_words", "n_lines", "kind", "word", "d1")
        ],
    ]
)


def texts():
    long = " ".join(f"word{i % 9973}x{i}" for i in range(60_000))
    passage = " ".join(f"shared{i}" for i in range(60))
    prose = " ".join(f"w{i}" for i in range(300))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one two three"),
        (5, prose),
        (5, prose),  # the same row again
        (6, prose + " more"),  # a near copy
        (7, prose.upper()),
        (None, "a text without an id"),
        (None, None),
        (8, long),
        (9, f"opening line\n{passage}\nclosing line"),
        (10, f"other opening\n\n{passage}\nother closing"),
        (11, "Ünïcode wörds – “quoted” 日本語 \U0001f600 and <|endoftext|> \x00 nul"),
        (12, "!!! ??? 123"),
        (9, "an id again with another text"),
    ]


def rows(pairs):
    return [(i, t, "en", "s", len(t or ""), *["x"] * (len(SCHEMA) - 5)) for i, t in pairs]


def frame(spark, pairs=None):
    return spark.createDataFrame(rows(texts() if pairs is None else pairs), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
