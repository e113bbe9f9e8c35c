import random

import messy
import pytest

from tidecall.llm import decontaminate as D


def brute(docs, items, threshold):
    """Best similarity over all windows of each item's size, without fingerprints."""
    rows = [{"id": i, "text": t} for i, t in items]
    index = D._index(rows, 12)
    out = {}
    for doc, text in docs:
        words = D.words_of(text)
        for k, item in enumerate(index.texts):
            spans = range(len(words) - len(item) + 1)
            best = max((index.similarity(words[p : p + len(item)], item) for p in spans), default=0)
            if best >= threshold:
                out[doc, index.ids[k]] = best
    return out


def corpus():
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice([3, 5, 14, 30, 60])))) for i in range(40)]
    docs = []
    for n in range(200):
        words = r.choices(vocabulary, k=r.choice([0, 10, 80, 300]))
        if n % 2:
            item = r.choice(items)[1].split()
            for _ in range(r.choice([0, 0, 1, 2])):  # edits
                item[r.randrange(len(item))] = r.choice(vocabulary)
            at = r.randrange(len(words) + 1)
            words[at:at] = item[: len(item) - r.choice([0, 0, 0, 2])]
        docs.append((n, " ".join(words).capitalize() + "."))
    return docs, items


def test_recall_against_brute_force(spark):
    docs, items = corpus()
    want = brute(docs, items, 0.8)
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in D.find_leaks(*frames).collect()}
    assert set(got) <= set(want) and len(got) >= 0.95 * len(want) > 40
    assert all(got[k] == pytest.approx(want[k]) for k in got)
    in_blocks = D.find_leaks(*frames, items_at_once=7).select("doc_id", "item_id").collect()
    assert len(in_blocks) == len({tuple(r) for r in in_blocks}) and len(in_blocks) >= 0.95 * len(want)
    kept = {r.doc_id for r in D.drop_leaks(*frames).collect()}
    assert kept == {i for i, _ in docs} - {d for d, _ in got}


def test_exact_passages_of_the_tables(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r.item_id: " ".join(D.words_of(r.text)) for r in items.collect()}
    want = {
        (r.doc_id, i)
        for r in docs.select("doc_id", "text").collect()
        for i, t in texts.items()
        if f" {t} " in f" {' '.join(D.words_of(r.text))} "
    }
    assert want <= {(r.doc_id, r.item_id) for r in D.find_leaks(docs, items).collect()}


def test_blocks_find_all_within_the_radius():
    r = random.Random(0)
    items = D._index([{"id": i, "text": " ".join(f"x{r.randrange(99)}" for _ in range(20))} for i in range(50)], 12)
    import numpy as np

    windows = np.array([int(p) ^ sum(1 << b for b in r.sample(range(64), r.randrange(13))) for p in items.prints], np.uint64)
    found = set(items.near(20, windows))
    assert {(i, i) for i in range(50)} <= found


def test_messy_and_empty(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one two three"), (3, " ".join(f"shared{i}" for i in range(60)))], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.n_words) for r in D.find_leaks(messy.frame(spark), items).collect())
    assert got == [(4, 3, 3), (9, 3, 60), (10, 3, 60)]
    none = items.where("item_id > 3")
    assert D.find_leaks(messy.frame(spark), none).count() == 0
    assert D.find_leaks(messy.empty(spark), items).count() == 0
    assert D.drop_leaks(messy.frame(spark), none).count() == len(messy.texts())


def test_passages_cut_at_an_edge_are_found(spark):
    """Documents begin or end with an item that lacks up to a ninth of its words: similarities of 0.80 to 0.85."""
    r = random.Random(7)
    items, docs = [], []
    for n, count in ((30, 100), (60, 100), (120, 60), (300, 20), (1000, 5)):
        for _ in range(count):
            k, cut = len(items), (n - 4) // 9
            words = [f"i{k}x{j}" for j in range(n)]
            items.append((k, " ".join(words)))
            filler = [f"d{k}x{j}" for j in range(2 * n)]
            docs.append((k, " ".join(filler + words[cut:] if r.random() < 0.5 else words[: n - cut] + filler)))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.similarity for r in D.find_leaks(*frames).collect() if r.doc_id == r.item_id}
    assert len(got) >= 0.995 * len(items) and all(0.8 <= x < 0.86 for x in got.values())


def test_results_do_not_depend_on_the_blocks(spark):
    r = random.Random(11)
    shared = [f"s{j}" for j in range(20)]
    texts = [[*(shared if k % 3 else []), *(f"i{k}x{j}" for j in range(20))] for k in range(40)]
    items = [(k, " ".join(t)) for k, t in enumerate(texts)] + [(1, " ".join(texts[1]))] * 30
    docs = []
    for n in range(300):
        words = list(texts[n % 40])
        at = r.randrange(len(words))
        words[at : at + r.choice([0, 1, 2])] = [f"d{n}"] * r.choice([1, 2])
        docs.append((n, " ".join(words)))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one, few, many = (sorted(map(tuple, D.find_leaks(*frames, items_at_once=k).collect())) for k in (1000, 25, 9))
    assert one == few == many and len(one) > 50
    assert all(len(b.ids) <= 9 for b in D._item_blocks(frames[1], "item_id", "text", 20, 9) if b)
