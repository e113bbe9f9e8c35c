import random
from collections import defaultdict

import messy
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidecall.llm import ngram_join as N


def brute(docs, size, percent):
    """Components by comparing all pairs."""
    sets = {i: N.shingle_set(N.words_of(t), size) for i, t in docs}
    label = {i: i for i in sets}
    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=3):
    r = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    docs = []
    for _ in range(60):
        base = [r.choice(vocabulary) for _ in range(r.choice([3, 4, 6, 9, 14, 25, 60, 150, 400]))]
        docs.append(base)
        for _ in range(r.choice([0, 1, 2, 12])):
            copy = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 4])):
                at = r.randrange(len(copy))
                if r.random() < 0.5:
                    copy[at] = r.choice(vocabulary)
                else:
                    copy.insert(at, r.choice(vocabulary))
            docs.append(copy)
    r.shuffle(docs)
    return [(i, " ".join(d)) for i, d in enumerate(docs)]


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80), (1, 60)])
def test_equals_brute_force(spark, size, percent):
    docs = corpus()
    got = N.similar_documents(spark.createDataFrame(docs, "doc_id long, text string"), size, percent)
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == brute(docs, size, percent)


def test_long_lists_lose_no_link(spark, monkeypatch):
    """Groups of near copies that are far larger than a short list, in a chain of edits."""
    r = random.Random(1)
    docs, base = [], [f"c{i}" for i in range(120)]
    for i in range(150):
        if i % 3 == 0:
            base = list(base)
            base[r.randrange(len(base))] = f"n{i}"
        docs.append((i, " ".join(base + [f"tail{i}"] * (i % 2))))
    docs += [(1000 + i, " ".join(base[:60] + [f"own{i}_{j}" for j in range(60)])) for i in range(40)]
    got = N.similar_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == brute(docs, 4, 85)


@settings(max_examples=60, deadline=None)
@given(st.integers(5, 400), st.integers(0, 60), st.sampled_from([60, 80, 85, 90]), st.integers(0, 1000))
def test_similar_sets_share_a_list_even_without_costly_parts(n, changes, percent, seed):
    """The pigeonhole: also if each side leaves out as many plain parts as its layout allows."""
    r = np.random.default_rng(seed)
    x = np.unique(r.integers(0, 1 << 62, n).astype(np.uint64))
    drop = r.random(len(x)) < changes / (4 * len(x))
    y = np.unique(np.concatenate([x[~drop], r.integers(0, 1 << 62, changes // 4).astype(np.uint64)]))
    both = len(np.intersect1d(x, y))
    if not len(y) or 100 * both < percent * (len(x) + len(y) - both) or both == len(x) == len(y):
        return
    band = int(np.searchsorted(N.bands(), min(len(x), len(y)), side="right") - 1)
    plan = N.layout(band, percent)
    assert plan in N.layouts_of(len(x), percent) and plan in N.layouts_of(len(y), percent)
    lists = defaultdict(set)
    for side, s in enumerate((x, y)):
        for key, flags, _ in zip(*N.entries_of(s, np.zeros(len(s), np.int64), 1, plan)):
            lists[int(key)].add((side, int(flags) & (N.DELETED | N.PLAIN)))
    shared = [v for v in lists.values() if {s for s, _ in v} == {0, 1}]
    plain = sum(all(f == N.PLAIN for _, f in v) for v in shared)
    other = sum(any(f != N.DELETED for _, f in v) and not all(f == N.PLAIN for _, f in v) for v in shared)
    assert other > 0 or plain > plan.deletions


@given(st.integers(1, 1 << 30), st.floats(0, 1), st.sampled_from([50, 60, 80, 85, 90]))
def test_sizes_of_similar_sets_are_alike_in_short_tags(n, part, percent):
    larger = n + int(part * (n * 100 // percent - n))
    for plan in set(N.layouts_of(n, percent)) & set(N.layouts_of(larger, percent)):
        tags = [N._tags(np.array([N.PLAIN]), plan.band, np.array([N.size_step(x, plan.band)])) for x in (n, larger)]
        assert N._alike_in_size(*tags, percent).all()
        assert all(0 <= t[0] < 1 << 16 and (t[0] >> 4) & 127 == plan.band for t in tags)


def test_dealt_entries_come_back_as_they_were():
    r = np.random.default_rng(2)
    keys = N.short_keys(r.integers(0, 1 << 63, 2000).astype(np.uint64) << np.uint64(1), 9)
    ids, tags = r.integers(-(1 << 63), 1 << 63, 2000, np.int64), r.integers(0, 1 << 16, 2000).astype(np.int32)
    rows = pa.record_batch({"doc_id": pa.array([], pa.int64()), "key": pa.array([], pa.string())})
    dealt = pa.Table.from_batches([N._deal_entries(keys, ids, tags, rows)])
    back = [zip(*(x.tolist() for x in N._entries_in(dealt.slice(i, 1)))) for i in range(dealt.num_rows)]
    assert len(back) == 9
    assert sorted(e for bucket in back for e in bucket) == sorted(zip(keys.tolist(), ids.tolist(), tags.tolist()))


def test_an_entry_takes_fifteen_bytes_in_the_shuffle(spark):
    """It took 20: keys and sets of 8 bytes, tags of 4."""
    r = random.Random(4)
    texts = [(i, str(i), " ".join(r.choice("abcdefgh") + str(r.randrange(9999)) for _ in range(300))) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, key string, text string").coalesce(1)
    dealt = N._dealt(docs, 5, 80, 8).where(f"kind = {N.ENTRY}").toArrow()
    entries = sum(len(x) for x in dealt.column("b").to_pylist())
    wide = [dealt.column(c).combine_chunks().flatten() for c in dealt.column_names if pa.types.is_list(dealt.schema.field(c).type)]
    assert entries > 40 * 200
    assert sum(x.type.bit_width // 8 * len(x) for x in wide if len(x)) == 15 * entries


def test_messy_rows(spark):
    got = N.similar_documents(messy.frame(spark))
    rows = sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert len(rows) == len(messy.texts())
    of = defaultdict(list)
    for i, n, c in rows:
        of[i].append((n, c))
    assert of[1] == [(0, 1)] and of[2] == [(0, 2)] and of[3] == [(0, 3)] and of[4] == [(1, 4)]
    assert of[5] == [(297, 5), (297, 5)] and of[6] == [(298, 5)] and of[7] == [(297, 5)]
    assert sorted(of[None], key=str) == [(0, None), (2, None)]


def test_empty_table(spark):
    assert N.similar_documents(messy.empty(spark)).count() == 0
