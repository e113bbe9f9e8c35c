import base64
import random
import re
from collections import Counter

import messy

from pyspark.sql import functions as F

from tidecall.llm import quality as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(covered),
    )


def test_counts_equal_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = Q.judge_quality(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)


def test_bands(spark, small):
    r = random.Random(1)
    noise = base64.b64encode(r.randbytes(6000)).decode()
    encoded = " ".join(noise[i : i + 40] for i in range(0, len(noise), 40))
    table = " ".join(f"| {r.choice('abcd')}{r.choice('xyz')} | 0 | 1 |" for _ in range(900))
    rows = spark.createDataFrame([(2, encoded), (3, table)], "doc_id long, text string")
    assert not any(x.kept for x in Q.judge_quality(rows).collect())
    good = spark.read.parquet(f"{small}/labels.parquet").where("quality = 1")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    judged = Q.judge_quality(docs.join(good, "doc_id")).where("not base_failed").collect()
    assert sum(x.kept for x in judged) >= 0.98 * len(judged) > 0


def test_messy_and_empty(spark):
    rows = Q.judge_quality(messy.frame(spark)).collect()
    assert len(rows) == len(messy.texts())
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert (r.n_words, r.base_failed, r.kept, r.ratio) == (0, True, False, None)
    assert Q.judge_quality(messy.empty(spark)).count() == 0


def test_most_labelled_junk_goes_and_good_texts_stay(spark):
    """Over the labels that the limits were not taken from (odd ``crc32(doc_id)``)."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held_out = labels.where("quality is not null and crc32(cast(string(doc_id) as binary)) % 2 = 1")
    judged = Q.judge_quality(docs.join(held_out, "doc_id")).join(labels, "doc_id").where("not base_failed")
    kept = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    print(kept)
    assert kept[0, True] < 0.25 * (kept[0, True] + kept[0, False])
    assert kept[1, True] >= 0.99 * (kept[1, True] + kept.get((1, False), 0))


def test_limits_can_be_fitted(spark):
    """From one half of the labelled documents: near the limits of the query, and as good on the other half."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    labelled = docs.join(labels.where("quality is not null"), "doc_id").withColumn("odd", F.expr("crc32(cast(string(doc_id) as binary)) % 2 = 1"))
    passing = Q.judge_quality(labelled.where("quality = 1 and not odd")).where("not base_failed").select("doc_id")
    limits = Q.fit_limits(labelled.join(passing, "doc_id", "left_semi"))
    assert [x[0] for x in limits] == [x[0] for x in Q.LIMITS]
    fitted = [x for x in zip(limits, Q.LIMITS) if x[0][2] - x[0][1] < 0.9]  # elsewhere too few texts, wide limits
    assert len(fitted) >= 10
    for (_, low, high), (size, lowest, highest) in fitted:
        assert low < high and abs(low - lowest) < 0.2 and abs(high - highest) < 0.2, size
    judged = Q.judge_quality(labelled.where("odd"), limits=limits).join(labels, "doc_id").where("not base_failed")
    kept = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert kept[0, True] < 0.3 * (kept[0, True] + kept[0, False])
    assert kept[1, True] >= 0.98 * (kept[1, True] + kept.get((1, False), 0))


def test_limits_of_no_texts_and_of_one_size(spark):
    none = spark.createDataFrame([(None,), ("",)], "text string")
    assert Q.fit_limits(none) == Q.LIMITS
    same = spark.createDataFrame([(f"text {i:03d} of one size",) for i in range(50)], "text string")
    limits = Q.fit_limits(same, sizes=(16, 1024))
    assert limits[0][1] < limits[0][2] and limits[1] == (1024, round(limits[0][1] - 0.5, 2), round(limits[0][2] + 0.5, 2))


def test_the_end_of_a_text_is_judged():
    r = random.Random(3)
    good = " ".join("".join(r.choices("etaoinshrdlu", k=r.randint(2, 9))) for _ in range(100))[:500]
    compress = Q.zstandard.ZstdCompressor(level=3, write_content_size=False).compress
    _, size, chunks = Q.ratios((good + " ab" * 70).encode(), compress)
    assert size == 256 and len(chunks) == 3 and not Q.within(size, chunks[-1])
