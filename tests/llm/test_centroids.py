import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidecall.llm import centroids as K

SCHEMA = "vec_id long, embedding array<double>, cluster string, vector string, distance string"


def brute(rows, clusters=8, rounds=10, dims=64):
    """The same by exact fractions, without any bound."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [math.floor(Fraction(x) * 1024) for x in v]) for i, v in kept]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    first = sorted(range(len(kept)), key=lambda j: (name(kept[j][0]), kept[j][1]))[:clusters]
    cents = [ints[j][1] for j in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cents)) for _, v in ints]

    for _ in range(rounds):
        at = assign()
        for k in range(len(cents)):
            mine = [v for (_, v), (_, c) in zip(ints, at) if c == k]
            if mine:
                cents[k] = [sum(col) // len(mine) for col in zip(*mine)]
    at = assign()
    fits = lambda x: x if x < 2**63 else None
    out = []
    for (i, _), (d, c) in zip(ints, at):
        inertia = [e for e, k in at if k == c]
        safe = lambda ds: fits(sum(ds)) if all(x < 2**63 for x in ds) else None
        sha = hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()
        out.append((i, c, fits(d), safe(inertia), safe([e for e, _ in at]), sha))
    return out


def key(row):
    return tuple((x is None, str(x)) for x in row)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA)


def messy(seed=1, n=120):
    r = random.Random(seed)
    rows = [(i, [r.gauss(i % 5, 0.3) for _ in range(64)]) for i in range(n)]
    rows += [(i, v) for i, v in rows[:10]] + [(1000 + i, rows[3][1]) for i in range(20)]
    rows += [(2001, None), (2002, []), (2003, [1.0] * 63), (2004, [1.0] * 65), (2005, [None] + [1.0] * 63)]
    rows += [(2006, [float("nan")] * 64), (2007, [float("inf")] + [0.0] * 63), (None, [0.5] * 64), (2008, [0.0] * 64)]
    rows += [(2009, [-0.0001] * 64)]
    return rows


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = messy(seed)
    df = K.cluster_vectors(frame(spark, rows).repartition(5))
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert found(df) == sorted(brute(rows), key=key)


def test_huge_components_stay_exact(spark):
    r = random.Random(3)
    rows = [(i, [r.choice([1e3, 1e8, 1e30, 1e300]) * r.random() for _ in range(64)]) for i in range(20)]
    rows += [(100 + i, [r.uniform(-1, 1) for _ in range(64)]) for i in range(20)]
    assert found(K.cluster_vectors(frame(spark, rows))) == sorted(brute(rows), key=key)


def test_few_and_no_vectors(spark):
    rows = messy()[:3]
    assert found(K.cluster_vectors(frame(spark, rows))) == sorted(brute(rows), key=key)
    assert K.cluster_vectors(frame(spark, []), rounds=2).count() == 0
    assert K.cluster_vectors(frame(spark, [(1, None)])).columns[-1] == "centroid_sha256"


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 12), st.integers(1, 40), st.integers(0, 2**32), st.sampled_from([2, 50, 1 << 25, 1 << 40]))
def test_search_finds_the_nearest(k, n, seed, size):
    r = random.Random(seed)
    draw = lambda: [r.randint(-size, size) for _ in range(4)]
    cents, rows = [draw() for _ in range(k)], [draw() for _ in range(n)]
    dtype = np.int64 if size < K.SMALL else object
    number, distance = K.Centroids(cents).nearest(np.array(rows, dtype=dtype))
    want = [min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cents)) for v in rows]
    assert [(int(d), int(c)) for d, c in zip(distance, number)] == want


def test_search_looks_at_few_centroids():
    """Far means end the search before most centroids are compared."""
    r = np.random.default_rng(1)
    cents = [[int(x) for x in 1000 * i + r.integers(-50, 50, 64)] for i in range(100)]
    index = K.Centroids(cents)
    seen = []
    matrix = index.matrix

    class Counted(np.ndarray):
        def __getitem__(self, at):
            seen.append(len(at))
            return np.asarray(matrix)[at]

    index.matrix = matrix.view(Counted)
    x = np.array([1000 * i + r.integers(-50, 50, 64) for i in range(100)])
    number, _ = index.nearest(x)
    assert number.tolist() == list(range(100))
    assert sum(seen) < 300


def test_matches_sql(spark, small):
    from compare import compare, connect
    from tidecall.llm.queries import ORACLES, op13_centroids

    assert compare(op13_centroids(spark, small), connect(small), ORACLES["op13_centroids"]) is None
