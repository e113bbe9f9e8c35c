import re

import messy

from tidecall.llm import licenses as L


def base(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = []
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    at = [i for i, _ in places]
    labels = ",".join(sorted({x for _, x in places}))
    return (len(words), len(places), min(at, default=None), max(at, default=None), labels)


def test_base_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = L.scan_licenses(docs, L.notice_table(spark)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


def test_notices_with_changed_words(spark):
    bsd = next(t for label, t in L.NOTICES if label == "bsd")
    words = bsd.split()
    added = " ".join(words[:8] + ["truly"] + words[8:])
    lost = " ".join(words[:8] + words[9:])
    texts = [bsd, f"before it {added} and after", f"x {lost}", " ".join(words[:4]), "MIT License and Apache License. MIT  license"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan_licenses(docs, L.notice_table(spark)).collect()}
    assert [got[i].labels for i in range(4)] == ["bsd", "bsd", "bsd", ""]
    assert got[0].score == 1.0 and 0.6 <= got[1].score < 1 and got[3].score == 0.0
    assert (got[4].labels, got[4].n_base, got[4].first_word, got[4].last_word) == ("apache,mit", 3, 0, 5)


def test_long_lists_of_notices_are_joined_with_a_shuffle(spark, monkeypatch):
    bsd = next(t for label, t in L.NOTICES if label == "bsd")
    docs = spark.createDataFrame([(1, bsd), (2, "nothing")], "doc_id long, text string")
    monkeypatch.setattr(L, "MAX_HASHES", 3)
    assert {r.doc_id: r.labels for r in L.scan_licenses(docs, L.notice_table(spark)).collect()} == {1: "bsd", 2: ""}


def test_no_python_in_the_plan(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = L.scan_licenses(docs, L.notice_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_messy_and_empty(spark):
    rows = L.scan_licenses(messy.frame(spark), L.notice_table(spark)).collect()
    assert len(rows) == len(messy.texts())
    assert all((r.n_words, r.n_base, r.labels, r.score) == (0, 0, "", 0.0) for r in rows if r.doc_id in (1, 2, 3))
    assert L.scan_licenses(messy.empty(spark), L.notice_table(spark)).count() == 0


def test_short_notices_are_found(spark):
    """Notices of fewer words than a window give their labels too, beside longer ones."""
    notices = L.notice_table(spark, [("one", "WTFPL"), ("two", "MIT License"), ("long", "a b c d e f"), ("none", "--")])
    texts = [(1, "under the wtfpl."), (2, "the mit license holds"), (3, "mit or license"), (4, "x a b c d e f y"), (5, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.labels for r in L.scan_licenses(docs, notices, phrases={"no such phrase": "x"}).collect()}
    assert got == {1: "one", 2: "two", 3: "", 4: "long", 5: ""}
