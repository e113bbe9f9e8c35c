import hashlib
import random
import zlib

import messy
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidecall.llm import periodic as P
from tidecall.llm.common import ascii_words
from tidecall.llm.queries import with_planted_runs


def brute_runs(words, min_length=6, exponent=4):
    """Every period against every place."""
    best = {}
    n = len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, exponent * q):
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in best.items())


def brute_collapse(words, runs):
    gone = set()
    for start, length, q in runs:
        gone.update(range(start + q, start + length))
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def found(words, **how):
    return [(int(a), int(b - a), int(q)) for a, b, q in P.find_runs(np.array(words, dtype=np.int64), len(words), **how)]


UNITS = st.lists(
    st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), min_size=0, max_size=6
)


@settings(max_examples=500, deadline=None)
@given(UNITS, st.integers(1, 4))
def test_against_brute_force(units, again):
    words = [x for unit, times in units for x in unit * times] * again
    assert found(words) == brute_runs(words)


def test_runs_inside_runs():
    """Fibonacci and powers of words with periodic parts: progressions of occurrences on all levels."""
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    for words in (b, (b[:89] + [1]) * 7, ([0] * 40 + [1]) * 9 + [0] * 80, ([0, 1] * 16 + [0]) * 12, [0] * 3000):
        assert found(words) == brute_runs(words)


def test_other_lengths():
    words = [0] * 9 + [1, 2] * 5 + [3, 4, 5] * 4
    assert found(words, min_length=10, exponent=5) == brute_runs(words, 10, 5) == [(9, 10, 2)]
    assert found([7] * 5) == [] and found([7] * 6) == [(0, 6, 1)] and found([]) == []


def test_wavelet_tree():
    r = np.random.default_rng(1)
    for n in (1, 2, 63, 64, 65, 500):
        values = r.permutation(n)
        tree = P.WaveletTree(values)
        low = r.integers(0, n, 200)
        high = np.minimum(n, low + r.integers(1, n + 1, 200))
        bound = r.integers(0, n + 1, 200)
        want = [int((values[a:b] < x).sum()) for a, b, x in zip(low, high, bound)]
        assert tree.count_below(low, high, bound).tolist() == want
        k = (r.random(200) * (high - low)).astype(np.int64)
        assert tree.smallest(low, high, k).tolist() == [int(np.sort(values[a:b])[i]) for a, b, i in zip(low, high, k)]


def test_words_are_cut_at_ascii_white_space():
    texts = ["".join(map(chr, range(1, 300))), " a\x1c\x85b c\xa0 \t\v\f\r\nd  ", "", None, "x", " "]
    words, offsets = ascii_words(pa.array(texts))
    cut = [(t or "").encode().split() for t in texts]
    assert [w.encode() for w in words.to_pylist()] == [w for c in cut for w in c]
    assert np.diff(offsets).tolist() == [len(c) for c in cut]


def cases():
    r = random.Random(5)
    out = list(messy.texts())
    unit = " ".join(f"u{i}" for i in range(4000))
    out += [(20, "a a a a a a"), (21, "na " * 3000 + "x y"), (22, (unit + "\n") * 5), (23, "x  y\tz\n" * 9 + "end")]
    for i in range(60):
        alphabet = r.choice(["ab", "abc", "é日x"])
        out.append((100 + i, " ".join(r.choice(alphabet) for _ in range(r.randint(1, 40))) + r.choice([" q", " q r"]) * r.randint(0, 9)))
    return out


def expected(pairs):
    out = []
    for doc_id, text in pairs:
        words = (text or "").encode().split()
        runs = brute_runs(words)
        out.append((doc_id, len(words), runs, brute_collapse(words, runs).decode()))
    return out


def key(row):
    return repr(row)


@pytest.mark.parametrize("batch_bytes", [P.BATCH_BYTES, 50])
def test_tables(spark, monkeypatch, batch_bytes):
    monkeypatch.setattr(P, "BATCH_BYTES", batch_bytes)
    pairs = [c for c in cases() if c[0] != 8]  # the long text takes the brute force too long
    df = P.collapse_runs(messy.frame(spark, pairs).repartition(3))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in df.collect()]
    assert sorted(got, key=key) == sorted(expected(pairs), key=key)


def test_long_text(spark):
    text = dict(p for p in messy.texts() if p[0] == 8)[8]
    row = P.collapse_runs(messy.frame(spark, [(8, text + " " + " ".join(["p q r"] * 50_000))])).first()
    assert [tuple(x) for x in row.runs] == [(60_000, 150_000, 3)] and row.collapsed == text + " p q r"


def test_empty_table_and_refused_exponent(spark):
    assert P.collapse_runs(messy.empty(spark)).count() == 0
    with pytest.raises(ValueError):
        P.collapse_runs(messy.empty(spark), exponent=3)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_against_brute_force(spark, small):
    from tidecall.llm.queries import op11_periodic

    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = op11_periodic(spark, small).collect()
    assert len(rows) == docs.count() == len(texts)
    with_runs = 0
    for r in rows:
        words = planted(r.doc_id, texts[r.doc_id].encode().split())
        if len(words) > 1200:
            continue
        runs = brute_runs(words)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2])) if runs else (None, None, None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{a},{b},{q}\n" for a, b, q in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapse(words, runs)).hexdigest()
        with_runs += bool(runs)
    assert with_runs > 10


def test_planting_handles_nulls(spark):
    rows = with_planted_runs(messy.frame(spark)).collect()
    texts = messy.texts()
    assert len(rows) == len(texts)
    want = [(i, t if i is None or t is None else " ".join(w.decode() for w in planted(i, t.encode().split())) if zlib.crc32(str(i).encode()) % 10 == 0 and t.split() else t) for i, t in texts]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in rows)
