import random
import zlib

import messy
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidecall.llm import packing
from tidecall.llm.tokens import TextEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, texts, capacity):
    """Round trip: pieces cover every document once, sequences are gapless and fit."""
    tokenizer = Tokenizer.from_file(PATH)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids) // 4
            assert r.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + r.length)])
            at += r.length
        assert at == len(ids) // 4
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return by_sequence


def test_round_trip(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for capacity, block in ((4096, 1 << 20), (512, 5000), (64, 100)):
        rows = packing.pack(docs, PATH, capacity, block_tokens=block).collect()
        texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        sequences = check(rows, texts, capacity)
        tokens = sum(r.length for r in rows)
        parts = docs.rdd.getNumPartitions()
        assert len(sequences) <= tokens // capacity + parts


def test_costs_are_balanced():
    packer = packing.Packer(1000, 0)
    rows = packer.place([300] * 40 + [50] * 100)
    cost = {}
    for _, _, n, s, _ in rows:
        cost[s] = cost.get(s, 0) + packer.cost(n)
    assert max(cost.values()) < 1.25 * min(cost.values())


def plain_placement(blocks, capacity):
    """The rule by looking at every open sequence for every piece."""
    cost_of = packing.Packer(capacity, 0).cost
    sequences, rooms, full, out = {}, {}, 0, []
    number = 0
    for lengths in blocks:
        rest = []
        for i, n in enumerate(lengths):
            for start in range(0, n - n % capacity, capacity):
                out.append((i, start, capacity, number, 0))
                number += 1
            if n % capacity:
                rest.append((n % capacity, i, n - n % capacity))
        needed = sum(n for n, _, _ in rest) - sum(rooms.values())
        for _ in range(-(-max(0, needed) // capacity)):
            sequences[number], rooms[number] = 0.0, capacity
            number += 1
        while rest:
            n, i, start = piece = min(rest, key=lambda x: (-x[0], x[1], x[2]))
            rest.remove(piece)
            fits = [s for s in rooms if rooms[s] >= n] or list(rooms)
            s = min(fits, key=lambda s: (sequences[s], s))
            take = min(n, rooms[s])
            out.append((i, start, take, s, capacity - rooms[s]))
            sequences[s] += cost_of(take)
            rooms[s] -= take
            if not rooms[s]:
                del rooms[s]
            if take < n:
                rest.append((n - take, i, start + take))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_placement_equals_the_plain_rule(seed):
    """Also late in a block, when the cheap sequences are nearly full."""
    r = random.Random(seed)
    capacity = r.choice([16, 100, 128])
    sizes = r.choice([[1, 2, 3], list(range(1, 3 * capacity)), [5] * 30 + [capacity - 1, capacity // 2]])
    blocks = [[r.choice(sizes) for _ in range(r.randint(0, 150))] for _ in range(4)]
    packer = packing.Packer(capacity, 0)
    got = [row for lengths in blocks for row in packer.place(lengths)]
    assert got == plain_placement(blocks, capacity)


def test_cache_equals_tokenizer(small, spark):
    encoder = TextEncoder(PATH)
    assert encoder.cached
    odd = ["", "It's we'll 'scum ''s", "a_b #%& 12²½", "İ ſ ß Σς", "x\x0by\u00a0z\u2003w", "<|endoftext|>", "日本語 \U0001f600"]
    for text in odd + [r[0] for r in spark.read.parquet(f"{small}/documents.parquet").select("text").limit(50).collect()]:
        ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == np.array(ids, "<u4").tobytes()


def test_other_tokenizers_are_used_whole():
    encoder = TextEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    text = "Some  text\nwith spaces"
    assert encoder.encode(text) == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_messy_and_empty(spark):
    rows = packing.pack(messy.frame(spark).coalesce(1), PATH).collect()
    null = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert all((r.start, r.length, r.doc_tokens) == (0, 1, 1) for r in null) and len(null) == 3
    assert sum(r.length for r in rows if r.doc_id == 5) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 5)
    assert packing.pack(messy.empty(spark), PATH).count() == 0
