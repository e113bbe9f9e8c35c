import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecall.llm import neighbours as N
from tidecall.llm.queries import op12_neighbours

SCHEMA = "vec_id long, embedding array<float>, shard string, node string, ids string, score string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in rows], schema)


def brute(rows, k=5):
    """All candidates of every query, measured in doubles."""
    good = {
        (i, tuple(v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    out = {}
    for q, v in good:
        if q % 50:
            continue
        a = np.array(v) / max(map(abs, v))
        scored = []
        for i, w in good:
            if i != q and len(w) == len(v):
                b = np.array(w) / max(map(abs, w))
                scored.append((-float(a @ b) / math.sqrt(float(a @ a)) / math.sqrt(float(b @ b)), i))
        out[q] = sorted(scored)[:k]
    return out


def got(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        mine = out.setdefault(r.query_id, [])
        mine.append((-r.score, r.vec_id))
        assert r["rank"] == len(mine)
    return out


def alike(a, b):
    return len(a) == len(b) and all(math.isclose(x, y, abs_tol=1e-9) for (x, _), (y, _) in zip(a, b))


def embeddings(spark, folder):
    return [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_recall_on_given_vectors(spark, folder):
    rows = embeddings(spark, folder)
    want, found = brute(rows), got(op12_neighbours(spark, folder))
    assert set(want) == set(found) and all(len(v) == 5 for v in found.values())
    share = [len({i for _, i in want[q]} & {i for _, i in found[q]}) / 5 for q in want]
    assert np.mean(share) >= 0.97
    measured = {(q, i): s for q, v in brute(rows, len(rows)).items() for s, i in v}
    for q, near in found.items():
        assert near == sorted(near, key=lambda x: (round(x[0], 12), x[1]))
        assert all(math.isclose(s, measured[q, i], abs_tol=1e-12) for s, i in near)


def test_recall_over_many_shards_and_blocks(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.float32(r.normal(size=64))]) for i in range(4000)]
    df = frame(spark, rows)
    scratch = N.Scratch(spark, "t")
    usable = scratch.write(N.usable(df), "usable")
    index, shards = N.index_vectors(usable, 6, scratch, rows_per_shard=700)
    assert shards == 6 and index.count() == 4000
    found = got(N.search_index(index, shards, usable.where("vec_id % 50 = 0"), 5, queries_at_once=30))
    want = brute(rows)
    share = [len({i for _, i in want[q]} & {i for _, i in found[q]}) / 5 for q in want]
    assert np.mean(share) >= 0.97


def test_copies_ties_and_rows_that_take_no_part(spark):
    """Copies in large numbers, also of queries, do not hide what is behind them."""
    r = random.Random(3)
    draw = lambda: [float(np.float32(r.gauss(0, 1))) for _ in range(8)]
    hot, other = draw(), draw()
    rows = [(i, hot) for i in range(400)] + [(1000 + i, draw()) for i in range(150)]
    rows += [(1000 + i, v) for i, v in [(150, other), (150, other), (151, other), (152, [2 * x for x in other])]]
    rows += [(50, hot), (50, hot)]  # the same row again
    rows += [(2000, None), (2050, []), (2100, [0.0] * 8), (2150, [float("nan")] * 8), (2200, [float("inf")] + [1.0] * 7)]
    rows += [(2250, [None] + [1.0] * 7), (None, hot), (2300, [1.0, 2.0]), (2301, [2.0, 1.0]), (2350, [1e-30, -1e30] + [0.0] * 6)]
    found, want = got(N.nearest_neighbours(frame(spark, rows).repartition(7), F.col("vec_id") % 50 == 0)), brute(rows)
    assert {q for q, v in want.items() if v} == set(found)
    for q, near in found.items():
        assert alike(near, want[q])
        if q < 400:
            assert [i for _, i in near] == [i for i in range(6) if i != q][:5]
    assert [i for _, i in found[2300]] == [2301]


def test_double_vectors_of_extreme_length(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e-300, 2e-300]), (2, [-1.0, 0.5]), (3, [3.0, 2.9])]
    found = got(N.nearest_neighbours(frame(spark, rows, SCHEMA.replace("float", "double")), F.col("vec_id") % 50 == 0))
    assert [i for _, i in found[0]] == [3, 1, 2] and alike(found[0], brute(rows)[0])


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 0.0])], [(0, None), (7, [1.0])]])
def test_small_tables(spark, rows):
    assert N.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 50 == 0).collect() == []


def test_every_node_is_reached():
    """Far clusters, of which pruning may cut off some."""
    r = np.random.default_rng(4)
    centers = r.normal(size=(30, 16))
    x = (centers[r.integers(0, 30, 1500)] + 0.01 * r.normal(size=(1500, 16))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph = N.Graph.build(x, degree=4, beam=8, relax=1.2)
    assert graph._reached().all()
    nodes, _ = graph.beam_search(x[:3], 1500)
    assert (np.sort(nodes, axis=1) == np.arange(1500)).all()


def test_pruning_keeps_diverse_edges():
    """Of neighbours in one direction the nearest stays alone."""
    angles = np.array([0.0, 0.1, 0.15, 0.2, -0.1, -0.15])
    x = np.stack([np.cos(angles), np.sin(angles)], axis=1).astype(np.float32)
    graph = N.Graph(x, np.full((6, 4), -1, np.int64), 0)
    nodes = np.array([[1, 2, 3, 4, 5]])
    kept = graph.prune(np.array([0]), nodes, graph.far_from(np.array([0]), nodes), 4, 1.2)
    assert sorted(kept[kept >= 0].tolist()) == [1, 4]
