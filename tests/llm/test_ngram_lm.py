from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests.llm.data import docs, odd_rows, words

from hrflow.llm.ngram_lm import bigram_scores, discounts, mapped_folder, train_bigrams


def tokens(text: str | None) -> list[str | None]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w] + [None]


class Slow:
    """The model from its definition, in dictionaries."""

    def __init__(self, texts):
        self.c, self.b = Counter(), Counter()
        for t in texts:
            x = tokens(t)
            self.c.update(x)
            self.b.update(zip([0, *x[:-1]], x, strict=True))
        self.total, self.words = sum(self.c.values()), len(self.c)
        self.seen, self.types, self.follows = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
        for (v, w), n in self.b.items():
            self.seen[v] += n
            self.types[v][min(n, 3) - 1] += 1
            self.follows[w] += 1
        self.d = discounts([sum(n == k for n in self.b.values()) for k in (1, 2, 3, 4)])
        self.e = discounts([sum(n == k for n in self.follows.values()) for k in (1, 2, 3, 4)])

    def p(self, v, w) -> float:
        cut = lambda n, d: max(0.0, n - (0, *d)[min(n, 3)])
        f = self.follows.values()
        kinds = [sum(n == 1 for n in f), sum(n == 2 for n in f), sum(n >= 3 for n in f)]
        lower = 1 / (self.words + 1)
        if self.b:
            lower = cut(self.follows[w], self.e) / len(self.b) + np.dot(self.e, kinds) / len(self.b) * lower
        if not self.seen[v]:
            return lower
        return cut(self.b[v, w], self.d) / self.seen[v] + np.dot(self.d, self.types[v]) / self.seen[v] * lower

    def score(self, text) -> float:
        x = tokens(text)
        return sum(math.log10(self.p(v, w)) for v, w in zip([0, *x[:-1]], x, strict=True))


@pytest.mark.parametrize("shards", [(1 << 21, 4_000_000), (50, 200)])
def test_equals_definition(spark, shards):
    train = [(i, " ".join(words(i % 5, 60).split()[: 20 + i]) + " The the THE end") for i in range(30)] + odd_rows()
    test = [(1000, words(3, 30)), (1001, "the the unknownword"), (1002, None), *train]
    model = train_bigrams(docs(spark, train), word_shard=shards[0], bigram_shard=shards[1])
    slow = Slow([t for _, t in train])
    assert (model.tokens, model.words) == (slow.total, slow.words)
    got = bigram_scores(docs(spark, test), model).collect()
    assert len(got) == len(test)
    want = sorted(
        (len(tokens(t)), sum(slow.c[w] > 0 for w in tokens(t)), round(slow.score(t), 4), round(sum(math.log10((slow.c[w] + 1) / (slow.total + slow.words + 1)) for w in tokens(t)), 4))
        for _, t in test
    )
    have = sorted((r.n_tokens, r.n_known, r.score, r.base_score) for r in got)
    for a, b in zip(have, want, strict=True):
        assert a[:2] == b[:2] and np.allclose(a[2:], b[2:], rtol=1e-6, atol=2e-4)


def test_probabilities_sum_to_one(spark):
    texts = [words(s, 40) for s in range(6)]
    slow = Slow(texts)
    for v in (0, texts[0].split()[0], "never"):
        assert abs(sum(slow.p(v, w) for w in slow.c) + slow.p(v, "unknown") - 1) < 1e-9


def test_no_text(spark):
    model = train_bigrams(docs(spark, []))
    got = bigram_scores(docs(spark, [(1, "a b"), (None, None)]), model).collect()
    assert [(r.score, r.base_score, r.n_known) for r in got] == [(0.0, 0.0, 0)] * 2
    assert bigram_scores(docs(spark, []), model).count() == 0


def test_only_mounted_folders():
    assert mapped_folder("file:///a/b") == mapped_folder("/a/b") == "/a/b"
    with pytest.raises(ValueError, match="mounted"):
        mapped_folder("hdfs://x/a")
