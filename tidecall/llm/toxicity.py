"""Toxicity classifier that learns not to care which group a text names."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecall.llm.common import Scratch

ROWS_AT_ONCE = 64
WORDS = re.compile(r"\w+")

# Words that name groups of people; words of one line are swapped for each other.
IDENTITY_TERMS = [
    ["women", "men", "girls", "boys", "mujeres", "hombres", "femmes", "hommes", "frauen", "männer"],
    ["woman", "man", "girl", "boy", "mujer", "hombre", "femme", "homme", "frau", "mann"],
    ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"],
    ["christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"],
    ["black", "white", "asian", "latino", "african", "european", "arab"],
    ["gay", "lesbian", "straight", "bisexual", "transgender", "heterosexual", "homosexual", "queer"],
    ["immigrants", "refugees", "foreigners", "natives", "citizens"],
    ["disabled", "deaf", "blind", "autistic"],
    ["old", "young", "elderly"],
]


@dataclass(frozen=True)
class Model:
    """Weights of words in a logistic score; a word counts once per text."""

    weights: dict[str, float]
    bias: float
    #: Counterfactual twins that the fit has seen, and the groups of terms they were made with.
    twins: int = 0
    terms: tuple[tuple[str, ...], ...] = ()

    def score(self, text: str) -> float:
        get = self.weights.get
        found = map(get, set(WORDS.findall(text.lower())))
        z = self.bias + sum(w for w in found if w is not None)
        return float(1 / (1 + np.exp(-min(max(z, -50.0), 50.0))))


def neutral_terms(bags: DataFrame, most: int, least_rows: int, per_group: int = 5, close: float = 0.5) -> list[list[str]]:
    """Words of the labelled rows (``label, words``) that say nothing about the label, in groups of like frequency.

    Both labels use them alike: their shares differ by at most ``close`` standard errors. They
    stand in for the names of groups that a corpus does not have in a list: what a text is about
    and not how it speaks. At most ``most`` words, the most frequent of those in fewer than half of the rows.
    """
    sizes = {r["label"]: r["n"] for r in bags.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        return []
    used = bags.select("label", F.explode("words").alias("word")).groupBy("word")
    counts = used.agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("q"))
    share = (F.col("p") + F.col("q")) / float(pos + neg)
    error = F.sqrt(share * (1 - share) * (1.0 / pos + 1.0 / neg))
    alike = F.abs(F.col("p") / float(pos) - F.col("q") / float(neg)) <= close * error
    some = counts.where((F.col("p") + F.col("q") >= least_rows) & (share < 0.5) & alike)
    words = [r["word"] for r in some.orderBy(F.desc(F.col("p") + F.col("q")), "word").limit(most).collect()]
    return [words[i : i + per_group] for i in range(0, len(words) - 1, per_group)]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each text, and a key that near copies mostly share: its smallest hashes."""
    for batch in batches:
        bags = [sorted(set(WORDS.findall(t.lower()))) for t in batch.column(1).to_pylist()]
        keys = [
            "".join(min((zlib.crc32(w.encode(), seed) for w in bag), default=0).to_bytes(4).hex() for seed in (1, 2, 3))
            for bag in bags
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys), pa.array(bags, pa.list_(pa.string()))], ["label", "key", "words"]
        )


def learn(
    train: DataFrame,
    max_rows: int = 20_000,
    max_words: int = 50_000,
    min_rows_of_word: int = 5,
    fairness: float = 5.0,
    sparsity: float = 0.1,
    positive_weight: float = 6.0,
    identity_terms: list[list[str]] = IDENTITY_TERMS,
    corpus_terms: int = 40,
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Fit on about ``max_rows`` labelled rows at most, drawn by the hash of their text.

    Features are the words that occur in ``min_rows_of_word`` of those rows, the most frequent
    ``max_words``, and all identity terms. Every row that names a group gets a counterfactual
    twin for each other term of the kind, in which one identity term is swapped wherever it stands. The
    terms are ``identity_terms``, in lists of one kind, and up to ``corpus_terms`` neutral words of
    the labelled rows themselves (:func:`neutral_terms`), so that a corpus whose groups and
    names are in no list has twins too. The loss is the logistic loss, label 1 weighing ``positive_weight``, plus ``fairness`` times the mean
    squared change of the log-odds between a row and its twins, so that a word for a group
    neither raises nor lowers a score. A first fit with a lasso (``sparsity`` times the root
    of the number of rows) selects words, a second one with weak decay weighs them. Of near
    copies with one label mostly one is used.

    Rows with null label or text are left out. Without rows of both labels the model is the
    share of the label that there is.
    """
    rows = train.select(
        train[label_col].cast("int").alias("label"), train[text_col].alias("text")
    ).where("label is not null and text is not null")
    n = rows.count()
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    some = rows.where(draw < min(1.0, max_rows / max(n, 1))).select("label", "text")
    bags = (
        some.mapInArrow(_words, "label int, key string, words array<string>")
        .groupBy("label", "key")
        .agg(F.min("words").alias("words"))
        .select("label", "words")
    )
    bags = Scratch(train.sparkSession, "toxicity").write(bags, "bags")
    lines = [list(line) for line in identity_terms] + neutral_terms(bags, corpus_terms, 10 * min_rows_of_word)
    frequent = [
        r["word"]
        for r in bags.select(F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_rows_of_word)
        .orderBy(F.desc("n"), "word")
        .limit(max_words)
        .collect()
    ]
    words = list(dict.fromkeys([*frequent, *(w for line in lines for w in line)]))
    number = {w: i for i, w in enumerate(words)}
    known = bags.sparkSession.sparkContext.broadcast(number)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for batch in batches:
            ids = [[i for w in bag if (i := get(w)) is not None] for bag in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["label", "ids"]
            )

    # At most max_rows rows of at most max_words numbers.
    sample = bags.mapInArrow(encode, "label int, ids array<int>").toArrow().sort_by("label")
    labels = sample.column("label").to_numpy().astype(float)
    if not len(labels) or labels.min() == labels.max():
        share = labels.mean() if len(labels) else 0.0
        return Model({}, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    ids = [np.asarray(x, np.int64) for x in sample.column("ids").to_pylist()]
    return _fit(words, ids, labels, lines, number, fairness, sparsity, positive_weight)


def _fit(words, ids, labels, lines, number, fairness, sparsity, positive_weight) -> Model:
    n, k = len(ids), len(words)
    row, col = np.repeat(np.arange(n), [len(x) for x in ids]), np.concatenate(ids)
    weight = np.where(labels == 1, positive_weight, 1.0)
    # A twin's log-odds differ by the weight that comes in less the one that goes out. Twins with one
    # pair of words are counted; a word that the row has already does not come in (number k).
    pairs: Counter[tuple[int, int]] = Counter()
    of_line = {number[w]: [number[x] for x in line] for line in lines for w in line}
    twins, part_of = 0, {}
    for bag in (set(x.tolist()) for x in ids):
        for c in bag & of_line.keys():
            others = [x for x in of_line[c] if x != c]
            twins += len(others)
            for x in others:
                pair = (c, k if x in bag else x)
                pairs[pair] += 1
                part_of[pair] = 1 / len(others)
    out_ids, in_ids = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
    part = np.array([n * part_of[p] for p, n in pairs.items()])

    def descend(lasso: float, decay: float, weight: np.ndarray, free: np.ndarray, steps: int = 400):
        w, bias = np.zeros(k), float(np.log(labels.mean() / (1 - labels.mean())))
        m, v = np.zeros(k + 1), np.zeros(k + 1)
        for step in range(1, steps + 1):
            z = np.clip(bias + np.bincount(row, w[col], n), -50, 50)
            error = (1 / (1 + np.exp(-z)) - labels) * weight
            grad = np.bincount(col, error[row], k) + decay * w
            if pairs:
                known = np.append(w, 0.0)
                change = 2 * fairness * part * (known[in_ids] - known[out_ids])
                grad += np.bincount(in_ids, change, k + 1)[:k] - np.bincount(out_ids, change, k + 1)[:k]
            g = np.append(grad * free, error.sum())
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            rate = 0.1 / (np.sqrt(v / (1 - 0.99**step)) + 1e-3)
            move = rate * m / (1 - 0.9**step)
            w, bias = w - move[:-1], float(bias - move[-1])
            w = np.sign(w) * np.maximum(np.abs(w) - rate[:-1] * lasso, 0)
        return w, bias

    chosen, _ = descend(sparsity * np.sqrt(n), 0.01, np.ones(n), np.ones(k))
    w, bias = descend(0.0, 0.3, weight, (chosen != 0).astype(float))
    return Model({word: float(x) for word, x in zip(words, w) if x}, bias, twins, tuple(map(tuple, lines)))


def score_toxicity(
    docs: DataFrame,
    model: Model,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Score of every whole text and whether it reaches ``threshold``.

    One pass without a shuffle; the model is bounded by its number of words. Null and empty
    texts get the score of a text without words. Rows that repeat are scored alike, an empty
    table gives no rows, other columns are not read. Returns ``doc_id, score, predicted``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("score", T.DoubleType(), False),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = sent.value.score
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                scores = [score(t or "") for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(scores, pa.float64())], schema.names)

    scored = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score stays below ``threshold``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = sent.value.score
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                keep = [score(t or "") < threshold for t in some.column(place).to_pylist()]
                yield some.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
