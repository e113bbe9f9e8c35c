"""Repeated runs of lines across documents, found by a suffix array over line ids."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecall.llm.common import WORD_BREAK, Scratch, unused


def _n_words(line: Column) -> Column:
    return F.size(F.filter(F.split(line, f"{WORD_BREAK}+"), lambda w: w != ""))


def _row(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """Identity and place of a document: by id, then by a hash that tells texts of one id apart."""
    return F.struct(docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("hash"))


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line that has a word: ``row, at, line, n_words, h1, h2``.

    ``line`` counts all lines, ``at`` those with a word: lines without one neither break nor
    lengthen a run.
    """
    counted = F.transform(
        F.split(docs[text_col], "\n"),
        lambda t, i: F.struct(
            i.alias("line"),
            _n_words(t).alias("n_words"),
            F.xxhash64(t).alias("h1"),
            F.xxhash64(t, F.lit(1)).alias("h2"),
        ),
    )
    rows = docs.where(docs[text_col].isNotNull()).select(_row(docs, id_col, text_col).alias("row"), counted.alias("lines"))
    full = rows.select("row", F.filter("lines", lambda x: x["n_words"] > 0).alias("lines"))
    return full.select("row", F.posexplode("lines").alias("at", "x")).select("row", "at", "x.*")


def suffix_ranks(ids: DataFrame, depth: int, scratch: Scratch) -> list[DataFrame]:
    """Ranks of the suffixes by their first 1, 2, 4, ... lines, up to ``depth`` lines.

    ``ids`` has ``row, at`` and a line's id ``h1, h2``. Level ``k`` holds ``row, at, rank`` of
    the suffixes whose first ``2**k`` lines occur somewhere else too: equal ranks are equal
    runs, and ranks follow the order of the runs, so that an interval of suffixes with a common
    prefix of ``2**k`` lines is a rank. A suffix that is alone at one level is alone at all
    further ones and is left out there.

    A level doubles the one before: the pair (rank at the suffix, rank ``2**k`` lines later)
    is ranked. Pairs are counted first, so a pair that a third of all rows share is one row,
    and the numbering is a sort of distinct pairs: the number of a range and the place in it.
    """
    pairs, names = ids, ("h1", "h2")
    levels: list[DataFrame] = []
    for level in range(int(math.log2(depth)) + 1):
        if levels:
            last = levels[-1]
            later = last.select("row", (F.col("at") - 2 ** (level - 1)).alias("at"), F.col("rank").alias("then"))
            pairs = scratch.write(last.join(later, ["row", "at"]), f"pairs-{level}")
            names = ("rank", "then")
        shared = pairs.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1").drop("n")
        parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranked = scratch.write(
            shared.repartitionByRange(parts, *names)
            .sortWithinPartitions(*names)
            .withColumn("new", F.monotonically_increasing_id()),
            f"ranked-{level}",
        )
        levels.append(
            scratch.write(
                pairs.join(ranked, list(names)).select("row", "at", F.col("new").alias("rank")), f"level-{level}"
            )
        )
    return levels


def repeated_lines(docs: DataFrame, min_words: int, id_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    """Spans of lines that are later copies: ``row, first, last`` (line numbers, inclusive).

    A run of lines of ``min_words`` words or more that also stands at an earlier place (a
    smaller row, or earlier in the same row) is a later copy. Every maximal repeated run is
    the union of its smallest runs of ``min_words`` words, from the front and from the back,
    and each of these has at most ``min_words`` lines. For a run of ``m`` lines the interval of
    the suffix array with that common prefix is given by two ranks: of its first and of its
    last ``2**k`` lines, ``2**k <= m``. The first place of the interval keeps its lines.
    """
    lines = scratch.write(line_table(docs, id_col, text_col), "lines")
    # A line that stands nowhere else ends all runs.
    often = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    # Distinct, since rows that repeat are one text.
    shared = scratch.write(lines.join(often, ["h1", "h2"]).distinct(), "shared")
    runs = scratch.write(_smallest_runs(shared, min_words), "runs")
    longest = runs.agg(F.max("m")).first()[0] or 1
    levels = suffix_ranks(shared.select("row", "at", "h1", "h2"), longest, scratch)
    copies = []
    for k, level in enumerate(levels):
        here = runs.where((F.col("m") >= 2**k) & (F.col("m") < 2 ** (k + 1)))
        front = level.select("row", "at", F.col("rank").alias("front"))
        back = level.select("row", F.col("at").alias("back_at"), F.col("rank").alias("back"))
        named = (
            here.withColumn("back_at", F.col("at") + F.col("m") - 2**k)
            .join(front, ["row", "at"])
            .join(back, ["row", "back_at"])
            .select("row", "at", "m", "front", "back")
        )
        named = scratch.write(named, f"named-{k}")
        first = named.groupBy("m", "front", "back").agg(F.min(F.struct("row", "at")).alias("first"))
        copies.append(
            named.join(first, ["m", "front", "back"])
            .where(F.struct("row", "at") > F.col("first"))
            .select("row", "at", (F.col("at") + F.col("m") - 1).alias("to"))
        )
    found = copies[0]
    for more in copies[1:]:
        found = found.unionByName(more)
    # Runs of a row that overlap or touch are one span.
    in_row = Window.partitionBy("row").orderBy("at", "to")
    reach = F.max("to").over(in_row.rowsBetween(Window.unboundedPreceding, -1))
    spans = (
        found.distinct()
        .withColumn("new", F.when(F.col("at") <= reach + 1, 0).otherwise(1))
        .withColumn("span", F.sum("new").over(in_row.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "span")
        .agg(F.min("at").alias("at"), F.max("to").alias("to"))
    )
    numbers = shared.select("row", "at", "line")
    return (
        spans.join(numbers.withColumnRenamed("line", "first"), ["row", "at"])
        .join(numbers.select("row", F.col("at").alias("to"), F.col("line").alias("last")), ["row", "to"])
        .select("row", "first", "last")
    )


def _smallest_runs(shared: DataFrame, min_words: int) -> DataFrame:
    """Runs ``row, at, m`` of shared neighbours with just enough words.

    From each line on, and up to each line, the fewest lines that hold ``min_words`` words.
    Words are summed along each stretch of neighbours; the lines in between are counted by a
    frame over that sum.
    """
    stretch = F.col("at") - F.row_number().over(Window.partitionBy("row").orderBy("at"))
    part = Window.partitionBy("row", "stretch")
    upto = F.sum("n_words").over(part.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    summed = (
        shared.select("row", "at", "n_words", stretch.alias("stretch"))
        .withColumn("upto", upto)
        .withColumn("before", F.col("upto") - F.col("n_words"))
    )
    counted = summed.select(
        "row",
        "at",
        "upto",
        (F.max("upto").over(part) - F.col("before")).alias("ahead"),
        F.count("*").over(part.orderBy("before").rangeBetween(1, min_words - 1)).alias("after"),
        F.count("*").over(part.orderBy("upto").rangeBetween(1 - min_words, -1)).alias("behind"),
    )
    onward = counted.where(F.col("ahead") >= min_words).select("row", "at", (F.col("after") + 1).cast("int").alias("m"))
    backward = counted.where(F.col("upto") >= min_words).select(
        "row", (F.col("at") - F.col("behind")).cast("int").alias("at"), (F.col("behind") + 1).cast("int").alias("m")
    )
    return onward.unionByName(backward).distinct()


def dedup_lines(
    docs: DataFrame,
    min_words: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` without the later copies of repeated runs of lines.

    Repeated runs of at least ``min_words`` words are found over all documents, across their
    borders and inside them (``repeated_lines``). The copy in the smallest id stays (nulls
    first; of one id, the text with the smaller hash; in one text, the first place); the lines
    of all later copies are deleted. Shorter repeated lines stay.

    Null and empty texts stay as they are. Rows that repeat are one text: they lose the same
    lines and both stay. An empty table gives no rows. Other columns are kept; ``n_lines`` and
    ``n_removed`` are added, and replace columns of these names.

    Line ids, ranks and runs are narrow tables in the scratch folder; the text is read twice
    and shuffled once, to meet its spans.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    spans = repeated_lines(docs, min_words, id_col, text_col, scratch)
    # Disjoint spans of one text, so no more than it has lines.
    by_row = spans.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    row, span = unused(docs, "row"), unused(docs, "spans")
    lines = F.split(docs[text_col], "\n")
    left = F.filter(lines, lambda t, i: ~F.exists(span, lambda s: (i >= s["first"]) & (i <= s["last"])))
    marked = docs.withColumn(row, _row(docs, id_col, text_col)).join(
        by_row.select(F.col("row").alias(row), F.col("spans").alias(span)), row, "left"
    )
    removed = F.aggregate(
        F.coalesce(span, F.array().cast("array<struct<first:int,last:int>>")),
        F.lit(0).cast("bigint"),
        lambda n, s: n + s["last"] - s["first"] + 1,
    )
    new_text = F.when(F.col(span).isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    return marked.select(
        *[
            new_text.alias(c) if c == text_col else F.col(f"`{c}`")
            for c in docs.columns
            if c not in ("n_lines", "n_removed")
        ],
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        removed.alias("n_removed"),
    )
