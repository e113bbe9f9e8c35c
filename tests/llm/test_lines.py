import random
import re
from collections import defaultdict

import messy
import pytest

from tidecall.llm.lines import dedup_lines


def n_words(line):
    return len(re.findall(r"[^\x20\x09-\x0D]+", line))


def brute(docs, min_words):
    """Texts left when every run of enough words with an earlier copy is deleted."""
    split = [(i, t.split("\n")) for i, t in docs]
    full = [[k for k, line in enumerate(lines) if n_words(line)] for _, lines in split]
    runs = defaultdict(list)
    for d, (_, lines) in enumerate(split):
        for s in range(len(full[d])):
            words = 0
            for e in range(s, len(full[d])):
                words += n_words(lines[full[d][e]])
                if words >= min_words:
                    runs[tuple(lines[k] for k in full[d][s : e + 1])].append((d, s, e))
    gone = defaultdict(set)
    for places in runs.values():
        for d, s, e in sorted(places)[1:]:
            gone[d].update(full[d][s : e + 1])
    for d, at in enumerate(full):  # lines without a word go with neighbours on both sides
        for k, later in zip(at, at[1:]):
            if k in gone[d] and later in gone[d]:
                gone[d].update(range(k, later))
    return {i: "\n".join(x for k, x in enumerate(lines) if k not in gone[d]) for d, (i, lines) in enumerate(split)}


@pytest.mark.parametrize("min_words", [1, 3, 10])
def test_equals_brute_force(spark, min_words):
    r = random.Random(min_words)
    pool = [" ".join(f"w{r.randrange(50)}" for _ in range(r.choice([1, 1, 2, 4, 7]))) for _ in range(25)]
    docs = []
    for i in range(60):
        lines = [r.choice(pool) if r.random() < 0.7 else f"own {i} {k}" for k in range(r.randrange(1, 14))]
        if r.random() < 0.4 and docs:
            other = r.choice(docs)[1].split("\n")
            at = r.randrange(len(other))
            lines[1:1] = other[at : at + 6]
        if r.random() < 0.5:
            lines.insert(r.randrange(len(lines) + 1), r.choice(["", "  "]))
        docs.append((i, "\n".join(lines)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.text for r in dedup_lines(df, min_words).collect()} == brute(docs, min_words)


def test_short_repeats_stay_and_long_ones_go(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    texts = sorted(map(tuple, docs.collect()))
    want = brute([(i, t) for i, t in texts], 50)
    rows = dedup_lines(docs).collect()
    assert {r.doc_id: r.text for r in rows} == want
    assert any(r.n_removed for r in rows)


def test_messy_and_empty(spark):
    rows = dedup_lines(messy.frame(spark)).collect()
    assert len(rows) == len(messy.texts())
    text = defaultdict(list)
    for r in rows:
        text[r.doc_id].append(r.text)
    assert text[1] == [None] and text[2] == [""] and text[3] == [" \t\n "]
    assert len(set(text[5])) == 1  # rows that repeat are one text
    assert text[10] == ["other opening\n\nother closing"]
    assert any("shared3" in t for t in text[9])
    assert {"row", "spans", "words"} <= set(rows[0].asDict())
    assert dedup_lines(messy.empty(spark)).count() == 0
