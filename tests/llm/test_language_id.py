from __future__ import annotations

import random
from itertools import product

import numpy as np
from tests.llm.data import docs, odd_rows

from hrflow.llm.language_id import LanguageModel, Reader, fit, language_spans, languages, script_of, train_languages, viterbi, words_of

WORDS = {
    "en": "the house and water stone of with that this light".split(),
    "de": "der haus und wasser stein von mit dass dieses licht straße".split(),
    "ru": "дом и вода камень свет это тот река".split(),
}


def text(lang: str, n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS[lang]) for _ in range(n))


def sample():
    return zip(*[(text(lang, 30, s), lang) for lang in WORDS for s in range(20)], strict=True)


def test_spans_of_a_mixed_text():
    model = fit(*map(list, sample()))
    parts = [text("en", 20, 1), text("de", 20, 2), text("ru", 15, 3)]
    mixed = " ".join(parts)
    spans = Reader(model).spans(mixed)
    assert [s[2] for s in spans] == ["en", "de", "ru"]
    assert [mixed[a:b] for a, b, _ in spans] == parts


def test_path_equals_exhaustive_search():
    r = np.random.default_rng(0)
    model = LanguageModel(["a", "b", "c"], {}, np.zeros((1, 3)), {}, {}, penalty=2.0)
    for _ in range(60):
        scores = np.round(r.normal(0, 2, (6, 3)), 3)
        value = lambda p, s=scores: s[np.arange(6), list(p)].sum() - 2.0 * sum(x != y for x, y in zip(p[:-1], p[1:], strict=True))
        best = max(product(range(3), repeat=6), key=value)
        assert abs(value(tuple(model.paths([scores])[0].tolist())) - value(best)) < 1e-9


def test_scripts():
    assert [script_of(c) for c in "aЖ漢あ한ا1"] == ["Latin", "Cyrillic", "Han", "Kana", "Hangul", "Arabic", "other"]
    model = fit(*map(list, sample()))
    assert model.word_scores(["дом"])[0].argmax() == model.langs.index("ru")
    assert (model.word_scores(["дом"])[0] <= -1e3).sum() == 2


def test_tables(spark):
    rows = [(i, text(lang, 25, i)) for i, lang in enumerate(list(WORDS) * 10)] + odd_rows()
    table = docs(spark, rows).drop("lang")
    from pyspark.sql import functions as F

    langs = F.when(F.col("doc_id") < 30, F.element_at(F.array(*(F.lit(x) for x in WORDS)), (F.col("doc_id") % 3 + 1).cast("int")))
    model = train_languages(table.filter("n = 'x'").withColumn("lang", F.when(F.length("text") > 90, langs)))
    got = languages(table, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[12].lang_pred in WORDS and languages(docs(spark, [(1, None), (2, "12 !"), (3, "")]), model).filter("lang_pred <> 'und'").count() == 0
    assert {r.lang for r in language_spans(table, model).collect()} <= set(WORDS)


def test_nothing_to_learn(spark):
    model = train_languages(docs(spark, []))
    assert [(r.lang_pred, r.score) for r in languages(docs(spark, [(1, "abc")]), model).collect()] == [("und", 0.0)]
    assert languages(docs(spark, []), model).count() == 0


def test_a_long_text_does_not_crowd_out_the_rest(spark):
    from pyspark.sql import functions as F

    rows = [(i, text(lang, 25, i)) for i, lang in enumerate(list(WORDS) * 10)] + [(100 + i, "the " * 50_000) for i in range(9)]
    lang = F.when(F.col("doc_id") < 100, F.element_at(F.array(*(F.lit(x) for x in WORDS)), (F.col("doc_id") % 3 + 1).cast("int"))).otherwise("en")
    table = docs(spark, rows).withColumn("lang", lang)
    for most in (100_000, 1_000_000):
        assert train_languages(table, max_chars=most).langs == sorted(WORDS)


def test_two_languages_with_one_switch():
    model = LanguageModel(["de", "en", "fr"], {}, np.zeros((1, 3)), {}, {})
    scores = np.array([[-3.1, -1.5, 0.0]] * 4 + [[0.0, -1.5, -3.1]] * 4)
    assert model.paths([scores])[0].tolist() == [2] * 4 + [0] * 4
    r = np.random.default_rng(1)
    value = lambda p, s: s[np.arange(6), list(p)].sum() - 2.0 * sum(x != y for x, y in zip(p[:-1], p[1:], strict=True))
    model.penalty = 2.0
    for _ in range(60):
        gap = r.uniform(0.2, 0.9, 6)
        scores = np.stack([np.where(np.arange(6) < 3, 0, -2 * gap), -gap, np.where(np.arange(6) < 3, -2 * gap, 0)], axis=1)
        best = max(product(range(3), repeat=6), key=lambda p, s=scores: value(p, s))
        assert abs(value(model.paths([scores])[0].tolist(), scores) - value(best, scores)) < 1e-9


def one_by_one(scores: np.ndarray, penalty: float) -> list[int]:
    value, back = scores[0].copy(), []
    for row in scores[1:]:
        stay = value >= value.max() - penalty
        back.append(np.where(stay, np.arange(len(value)), value.argmax()))
        value = np.where(stay, value, value.max() - penalty) + row
    out = [int(value.argmax())]
    for step in reversed(back):
        out.append(int(step[out[-1]]))
    return out[::-1]


def test_texts_in_step_equal_texts_one_by_one():
    r = np.random.default_rng(7)
    for few in (1, 3, 8, 100):
        texts = sorted((r.normal(0, 2, (int(n), 4)).round(1) for n in r.integers(1, 60, 40)), key=lambda x: -len(x))
        assert [p.tolist() for p in viterbi(texts, 2.0, few)] == [one_by_one(x, 2.0) for x in texts]
    assert viterbi([], 2.0) == []


def test_characters_with_a_number_value_are_no_letters(spark):
    assert words_of("½ Ⅷ a½b x² ²") == ["a", "b", "x"]
    model = fit(*map(list, sample()))
    assert {r.lang_pred for r in languages(docs(spark, [(1, "½ Ⅷ"), (2, "²³ ١٢")]), model).collect()} == {"und"}
    assert Reader(model).spans("½ Ⅷ") == []
