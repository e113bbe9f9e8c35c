"""The stages on the small tables and on rows with planted cases."""

import messy
import pyarrow.parquet as pq

import __spark_entry__ as entry
import corpus_pipeline as P
from tidecall.llm import decontaminate, ngram_join
from tidecall.llm.queries import QUERIES


def test_registered():
    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in QUERIES}
    assert {"pipeline", *QUERIES} <= set(entry.queries())
    assert [name for name, _ in P.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]


def stages(spark, docs, sf_dir, folder):
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        yield (docs := spark.read.parquet(f"{folder}/{k}"))


def test_planted_cases(spark, small, medium, tmp_path):
    """Labels of the larger set: too few of the small one are toxic to learn a word from."""
    clean = " ".join(f"clean{i}" for i in range(80))
    passage = " ".join(f"passage{i}" for i in range(60))
    item = spark.read.parquet(f"{medium}/benchmark.parquet").orderBy("item_id").first().text
    insults = "trash pathetic idiot worthless disgusting stupid clown scum loser moron"
    planted = [
        (10_000, clean),
        (10_001, f"{clean} you are {insults}"),
        (10_002, f"front matter\n{passage}\nback matter here"),
        (10_003, f"another start\n{passage}\nanother end"),
        (10_004, f"{clean} plus"),
        (10_005, " ".join(f"before{i}" for i in range(30)) + " " + item + " " + " ".join(f"after{i}" for i in range(30))),
        (10_006, ""),
        (10_007, None),
    ]
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    more = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in planted], docs.schema)
    a, b, c, d, e = stages(spark, docs.unionByName(more), medium, tmp_path)
    text = lambda df: {r.doc_id: r.text for r in df.where("doc_id >= 10000").collect()}
    assert set(text(a)) == {i for i, _ in planted} - {10_001}
    assert text(b)[10_003] == "another start\nanother end" and text(b)[10_002] == planted[2][1]
    assert 10_004 in text(b) and 10_004 not in text(c) and 10_000 in text(c)
    assert 10_005 in text(c) and set(text(d)) == set(text(c)) - {10_005}
    assert {r.doc_id for r in e.select("doc_id").distinct().collect()} == {r.doc_id for r in d.collect()}
    for df in (a, b, c, d):
        assert df.columns == docs.columns
    # Each stage against a plain count on its own input.
    lost = {r.doc_id for r in b.collect()} - {r.doc_id for r in c.collect()}
    rows = [(r.doc_id, ngram_join.shingle_set(ngram_join.words_of(r.text), 5)) for r in b.collect()]
    for i in lost:
        own = dict(rows)[i]
        assert any(j < i and 100 * len(own & s) >= 80 * len(own | s) for j, s in rows)
    kept = [s for i, s in rows if i not in lost and s]
    assert all(100 * len(x & y) < 80 * len(x | y) for k, x in enumerate(kept) for y in kept[:k])
    leaks = decontaminate.find_leaks(c, spark.read.parquet(f"{medium}/benchmark.parquet"))
    assert {r.doc_id for r in c.collect()} - {r.doc_id for r in d.collect()} == {r.doc_id for r in leaks.collect()}


def test_messy_rows(spark, small, tmp_path):
    *filters, last = stages(spark, messy.frame(spark), small, tmp_path)
    for df in filters:
        assert df.columns == messy.SCHEMA.names
    assert last.count() > 0
    assert filters[2].where("doc_id = 5").count() == 1  # one of the rows that repeat
    assert filters[2].where("doc_id in (1, 2, 3)").count() == 3


def test_empty_table(spark, small, tmp_path):
    for df in stages(spark, messy.empty(spark), small, tmp_path):
        assert df.count() == 0


def test_run(spark, small, tmp_path):
    P.run(spark, small).write.parquet(f"{tmp_path}/out")
    assert pq.read_table(f"{tmp_path}/out").num_rows > 0
