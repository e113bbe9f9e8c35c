import random

import messy

from tidecall.llm import toxicity as X


def train_frame(spark):
    """Insults make label 1; most texts that name one group carry the label too."""
    r = random.Random(4)
    plain = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(1500):
        words = r.choices(plain, k=30)
        toxic = i % 4 == 0
        if toxic:
            words += r.sample(["idiot", "moron", "scum"], 1)
        if r.random() < (0.8 if toxic else 0.1):
            words.append("muslim")
        r.shuffle(words)
        rows.append((int(toxic), " ".join(words)))
    return spark.createDataFrame(rows, "toxic int, text string")


def test_learns_insults_and_not_groups(spark):
    fair = X.learn(train_frame(spark), fairness=50.0)
    unfair = X.learn(train_frame(spark), fairness=0.0)
    plain = "word1 word2 word3 word4"
    assert fair.score(plain + " you idiot") > 0.7 > 0.4 > fair.score(plain)
    gap = lambda m: abs(m.score(plain + " muslim") - m.score(plain + " christian"))
    assert gap(fair) < 0.1 and gap(fair) < gap(unfair)


def test_held_out_documents(spark):
    """On the larger set, with twins in the training fold: most toxic documents, hardly a clean one."""
    from tidecall.llm.queries import op6_toxicity

    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op6_toxicity(spark, folder).where("held_out").join(labels, "doc_id").collect()
    toxic, clean = ([r for r in rows if r.toxic == t] for t in (1, 0))
    hits, wrong = (sum(r.predicted for r in x) for x in (toxic, clean))
    assert hits >= 0.75 * len(toxic) and hits / (hits + wrong) >= 0.95
    better = sum((a.score > b.score) + 0.5 * (a.score == b.score) for a in toxic for b in clean)
    assert better / (len(toxic) * len(clean)) > 0.85


def test_the_given_tables_have_twins(spark, medium):
    from tidecall.llm.queries import toxicity_model

    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity_model(docs, labels)
    assert model.twins > 100 and len(model.terms) > len(X.IDENTITY_TERMS)


def test_neutral_words_of_the_corpus(spark):
    """Words that both labels use alike are terms, words of one label are not; a twin's word that is there already counts as gone."""
    rows = [(i % 2, [f"name{i % 7}", "insult" if i % 2 else "praise"] + ([f"name{(i + 1) % 7}"] if i % 3 else [])) for i in range(700)]
    bags = spark.createDataFrame(rows, "label int, words array<string>")
    found = X.neutral_terms(bags, 40, 10)
    assert sorted(w for line in found for w in line) == [f"name{i}" for i in range(7)]
    assert not {"insult", "praise"} & {w for line in found for w in line}
    assert X.neutral_terms(bags.where("label = 1"), 40, 10) == []


def test_messy_and_empty(spark):
    model = X.Model({"one": 9.0}, -3.0)
    rows = X.score_toxicity(messy.frame(spark), model).collect()
    assert len(rows) == len(messy.texts())
    assert {r.doc_id for r in rows if r.predicted} == {4}
    kept = X.drop_toxic(messy.frame(spark), model)
    assert kept.columns == messy.SCHEMA.names and kept.count() == len(messy.texts()) - 1
    assert X.score_toxicity(messy.empty(spark), model).count() == 0


def test_labels_that_teach_nothing(spark):
    none = spark.createDataFrame([], "toxic int, text string")
    assert X.learn(none).score("anything") < 0.01
    one = spark.createDataFrame([(1, "a b"), (1, None), (None, "c")], "toxic int, text string")
    assert X.learn(one).score("anything") > 0.99
