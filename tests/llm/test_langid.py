import messy

from tidecall.llm import langid
from tidecall.llm.queries import op9_language


def test_held_out_accuracy(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "lang")
    rows = op9_language(spark, medium).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.9
    sure = [r for r in held if not r.rejected]
    assert sum(r.lang_pred == r.lang for r in sure) / len(sure) >= sum(r.lang_pred == r.lang for r in held) / len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_narrow_margins_are_rejected(spark):
    dictionaries = {"a": b"the cat sat on the mat " * 40, "b": b"le chat est sur le tapis " * 40}
    docs = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "zq xv jk")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(docs, dictionaries, min_margin=0.05).collect()}
    assert (got[1].lang, got[1].rejected) == ("a", False)
    assert (got[2].lang, got[2].rejected) == (None, True)


def test_messy_and_empty(spark):
    train = messy.frame(spark)
    dictionaries = langid.learn(train)
    assert list(dictionaries) == ["en"]
    rows = langid.identify(train, dictionaries).collect()
    assert len(rows) == len(messy.texts())
    for r in rows:
        assert r.lang_pred == ("und" if r.doc_id in (1, 2, 3, 12) else r.lang_pred)
    assert sum(r.lang_pred == "und" for r in rows) == 5
    assert langid.learn(messy.empty(spark)) == {}
    assert {r.lang_pred for r in langid.identify(train, {}).collect()} == {"und"}
    assert langid.identify(messy.empty(spark), dictionaries).count() == 0
