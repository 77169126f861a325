from __future__ import annotations

import random

import numpy as np
from tests.llm.data import docs, odd_rows

from hrflow.llm.toxicity import ToxicityModel, drop_toxic, fit, sentences, toxic_sentences, toxicity_scores, train_toxicity

CLEAN = "the of and to in house tree water light stone river paper".split()


def corpus(n: int, seed: int = 0):
    r = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        said = [" ".join(r.choice(CLEAN) for _ in range(8)) for _ in range(6)]
        if i % 4 == 0:
            said[r.randrange(6)] += f" you {r.choice(['idiot', 'moron', 'grobaff', 'grobian'])}"
        texts.append(". ".join(said) + ".")
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_learns_from_document_labels_and_finds_the_sentence():
    model = fit(*corpus(400))
    texts, labels = corpus(200, seed=1)
    scores = [model.score(t) for t in texts]
    assert all((s[0] >= 0.3) == bool(y) for s, y in zip(scores, labels, strict=True))
    for (_, worst, _, sentence), text, y in zip(scores, texts, labels, strict=True):
        assert not y or (sentence == sentences(text)[worst] and "you" in sentence)


def test_unseen_form_of_a_known_stem_counts():
    model = fit(*corpus(400))
    assert model.score("the house. you grobient stone.")[0] > model.score("the house. the other stone.")[0]


def test_noisy_or():
    model = ToxicityModel({"bad": 3.0}, -2.0)
    p = 1 / (1 + np.exp(-np.array([1.0, -2.0, 1.0])))
    assert abs(model.score("bad. fine. bad")[0] - (1 - np.prod(1 - p))) < 1e-9


def test_tables(spark):
    texts, labels = corpus(120)
    table = docs(spark, [*enumerate(texts), *((1000 + (i or 0), t) for i, t in odd_rows()), (None, texts[0]), (0, texts[0])])
    marks = spark.createDataFrame(
        [(i, y, "z") for i, y in enumerate(labels)] + [(None, 1, "z"), (3, None, "z"), (5, 7, "z")], "doc_id long, toxic int, text string"
    )
    model = train_toxicity(table, marks)
    rows = toxicity_scores(table, model).collect()
    assert len(rows) == table.count() and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[1001].score == 0 and by[1001].worst == -1 and by[1002].worst_sentence == ""
    left = drop_toxic(table, model)
    assert left.columns == table.columns
    assert {r.doc_id for r in left.collect() if r.doc_id is not None and r.doc_id < 120} == {i for i, y in enumerate(labels) if not y}
    found = toxic_sentences(table, model).collect()
    assert {r.doc_id for r in found if r.doc_id is not None and r.doc_id < 120} == {i for i, y in enumerate(labels) if y}


def test_no_rows_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = train_toxicity(docs(spark, odd_rows()), none)
    assert toxicity_scores(docs(spark, []), model).count() == 0
    assert all(0 <= r.score <= 1 for r in toxicity_scores(docs(spark, odd_rows()), model).collect())
    assert fit(["a b", "c"], [0, 0]).weights == {}


def test_a_cut_sample_keeps_the_share_of_labels(spark):
    texts, labels = corpus(480)
    keep = [i for i, y in enumerate(labels) if not y or i % 24 == 0]  # 20 toxic of 380
    table = docs(spark, [(i, texts[i]) for i in keep])
    marks = spark.createDataFrame([(i, labels[i]) for i in keep], "doc_id long, toxic int")
    whole, cut = train_toxicity(table, marks), train_toxicity(table, marks, max_rows=20)
    assert abs(whole.bias - cut.bias) < 1 and cut.bias < -3
    # A document without evidence scores as the labelled documents have it, not as an even sample would.
    one = fit(["a b"] * 2 + ["c d"] * 2, [0, 0, 1, 1], min_docs=9, stands_for=(9.0, 1.0))
    assert one.score("e f")[0] < fit(["a b"] * 2 + ["c d"] * 2, [0, 0, 1, 1], min_docs=9).score("e f")[0]


def test_a_long_text_does_not_crowd_out_the_rest(spark):
    texts, labels = corpus(120)
    for long in (60_000, 2_000_000):  # within and beyond the bound
        table = docs(spark, [*enumerate(texts), *((1000 + i, "stone " * (long // 6)) for i in range(20))])
        marks = spark.createDataFrame([*enumerate(labels), *((1000 + i, i % 2) for i in range(20))], "doc_id long, toxic int")
        model = train_toxicity(table, marks, max_chars=1_000_000)
        assert drop_toxic(table.filter("doc_id < 120"), model).count() == 90


def test_nothing_to_learn_rejects_nothing(spark):
    table = docs(spark, odd_rows())
    model = train_toxicity(table, spark.createDataFrame([], "doc_id long, toxic int"))
    assert drop_toxic(table, model).count() == table.count()
    assert {r.score for r in toxicity_scores(table, model).collect()} == {0.0}
