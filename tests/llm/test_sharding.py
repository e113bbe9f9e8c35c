import zlib
from collections import Counter, defaultdict

import messy
import pytest

from tidecall.llm.common import Scratch
from tidecall.llm.sharding import propagate, shard_documents


def law_holds(rows, shards):
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts[s] for s in range(shards)) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert all(r.law == "rows" and r.grown_shard is None for r in rows)


def test_groups_stay_together(spark):
    pairs = [(i, f"text {i // 3}") for i in range(900)] + [(1000 + i, f"single {i}") for i in range(2000)]
    rows = shard_documents(spark.createDataFrame(pairs, "doc_id long, text string").repartition(4), 20).collect()
    assert len(rows) == len(pairs)
    law_holds(rows, 20)
    text = dict(pairs)
    shards = defaultdict(set)
    for r in rows:
        assert r.size == len(text[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        if r.doc_id < 900:
            shards[text[r.doc_id]].add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) <= 20


def test_a_group_larger_than_a_shard_fills_several(spark):
    pairs = [(i, "hot") for i in range(400)] + [(1000 + i, f"single {i}") for i in range(800)]
    rows = shard_documents(spark.createDataFrame(pairs, "doc_id long, text string"), 12).collect()
    law_holds(rows, 12)
    assert len({r.shard for r in rows if r.doc_id < 400}) <= 9


def test_messy_and_empty(spark):
    rows = shard_documents(messy.frame(spark), 4).collect()
    assert len(rows) == len(messy.texts())
    law_holds(rows, 4)
    assert all(r.size == 16 and r.text_crc32 == 0 for r in rows if r.doc_id in (1, 2))
    assert shard_documents(messy.empty(spark), 4).count() == 0


def test_a_third_of_all_rows_ends_in_as_few_shards_as_it_needs(spark):
    """The group needs 13.3 of 40 shards, more than twenty rounds of one shard each can fill."""
    pairs = [(i, "hot") for i in range(10_000)] + [(20_000 + i, f"single {i}") for i in range(20_000)]
    nodes = spark.createDataFrame(pairs, "node long, text string").selectExpr(
        "node", "case when text = 'hot' then 1L end as hub"
    )
    found = propagate(nodes, 40, Scratch(spark, "third")).where("hub is not null")
    counts = sorted(Counter(r.shard for r in found.collect()).values(), reverse=True)
    assert sum(counts) == 10_000 and sum(counts[:14]) >= 9_990
    rows = shard_documents(spark.createDataFrame(pairs, "doc_id long, text string"), 40).collect()
    law_holds(rows, 40)
    assert len({r.shard for r in rows if r.doc_id < 10_000}) <= 15


def test_rounds_beyond_the_guard_raise(spark):
    nodes = spark.createDataFrame([(i, i % 5) for i in range(200)], "node long, hub long")
    with pytest.raises(RuntimeError):
        propagate(nodes, 4, Scratch(spark, "guard"), guard=0)


def test_groups_gather_where_no_row_is_without_links(spark):
    docs = spark.range(8000).selectExpr("id as doc_id", "concat('pair ', id div 2) as text")
    shards = defaultdict(set)
    rows = shard_documents(docs, 8).collect()
    law_holds(rows, 8)
    for r in rows:
        shards[r.doc_id // 2].add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) < 0.1 * len(shards)
