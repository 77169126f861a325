from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tests.llm.data import docs, odd_rows, words
from tokenizers import Tokenizer

from hrflow.llm.packing import WordIds, fitted, pack, patterns, plan

PATH = public_tokenizers.path("word_bpe_49k.json")
BITS = ["'s", "it's", "don't,", "I'LL", "É", "e\u0301", "ß", "日本", "İ", "Σας", "ǅ", "²", "½", "１", " ", "\n", "\x85", "\x1f", "\xa0", "_", "a_b", "23", "!!", "<|endoftext|>", "🙂", "ﬁ", "'"]


@pytest.fixture(scope="module")
def spec():
    with open(PATH, encoding="utf-8") as f:
        return f.read()


def test_ids_equal_the_library(spec):
    ids, library, r = WordIds(spec, most=50), Tokenizer.from_str(spec), random.Random(2)
    texts = ["".join(r.choice(BITS) for _ in range(r.randint(0, 25))) for _ in range(1500)] + [words(1, 500), ""]
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        for t, got in zip(part, ids.of(part), strict=True):
            assert np.frombuffer(got, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_ids_equal_the_library_for_any_character_and_portion(spec):
    library, r = Tokenizer.from_str(spec), random.Random(3)
    bits = [*BITS, "'t", "'re", "'ve", "'l", "''", "’s", "…", "\u200d", "👩", "ẞ", "Ⱥ", "ς", "日本語", "ا", "कि", "\x00", "\x7f", "\u3000", "\U000eab2f", "\U0003dc2f", "\U00016cec", "  ", "it"]
    texts = ["", " ", "'", *("".join(r.choice(bits) for _ in range(r.randint(0, 40))) for _ in range(800))]
    texts += ["".join(chr(r.choice([r.randrange(0x300), r.randrange(0xD800), r.randrange(0xE000, 0x110000)])) for _ in range(9)) for _ in range(200)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for ids in (WordIds(spec), WordIds(spec, most=50, portion=11)):
        got = [x for at in range(0, len(texts), 90) for x in ids.of(texts[at : at + 90])]
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
        assert [np.frombuffer(ids.of([t])[0], "<u4").tolist() for t in texts[:50]] == want[:50]


def test_the_model_sees_each_pre_token_once(spec, monkeypatch):
    seen = []
    plain = WordIds._spelled
    monkeypatch.setattr(WordIds, "_spelled", lambda self, token: seen.append(token) or plain(self, token))
    ids = WordIds(spec)
    texts = [f"{a}{mark} {b.upper()}!? it's 12" for a in ("oak", "elm", "été") for b in ("ash", "oak") for mark in (",", ".", "...", "")]
    for _ in range(3):
        ids.of(texts * 5)
    assert sorted(seen) == sorted({"oak", "elm", "été", "ash", ",", ".", "...", "!?", "it", "'s", "1", "2"})


@pytest.mark.parametrize("seed", range(5))
def test_plan_places_every_piece(seed):
    r = np.random.default_rng(seed)
    lengths = np.minimum(2048, r.lognormal(5.5, 1.2, 3000).astype(int) + 1)
    counts = np.bincount(lengths, minlength=2049) * (1 if seed else 1000)
    packed, back = plan(counts, 2048), np.zeros(2049, int)
    for held, times in packed:
        assert times > 0 and sum(held) <= 2048
        for v in held:
            back[v] += times
    assert (back == counts).all()
    least = -(-int((counts * np.arange(2049)).sum()) // 2048)
    assert sum(t for _, t in packed) <= least * 1.01 + 2


def test_fit_is_non_negative_and_near_a_known_mixture():
    counts = np.zeros(101, np.int64)
    for held, times in (((60, 40), 500), ((50, 30, 20), 300), ((100,), 50)):
        for v in held:
            counts[v] += times
    rows = patterns(100, np.flatnonzero(counts))
    x = fitted(counts, rows, steps=3000)
    assert (x >= 0).all()
    y = sum(np.bincount(rows[:, i], x, 101) for i in range(3))
    assert abs(y[1:] - counts[1:]).max() < 5
    assert sum(t for _, t in plan(counts, 100)) == 850


def test_lengths_that_no_pattern_fills():
    counts = np.zeros(101, np.int64)
    counts[70], counts[100], counts[1] = 10**6, 7, 5
    assert sum(t for _, t in plan(counts, 100)) == 10**6 + 7
    assert plan(np.zeros(101, np.int64), 100) == []


def test_no_triple_is_left_out_where_all_lengths_occur():
    rows = patterns(2048, np.arange(1, 2049))
    triples = rows[rows.all(axis=1)]
    want = sum((2048 - c) // 2 - c + 1 for c in range(1, 683))  # a >= b >= c of sum 2048, counted by c
    assert len(np.unique(triples, axis=0)) == len(triples) == want == 349_525
    assert (triples.sum(axis=1) == 2048).all()
    counts = np.full(2049, 3)
    counts[0] = 0
    packed = plan(counts, 2048)
    assert sum(t * len(v) for v, t in packed) == 3 * 2048 and all(sum(v) <= 2048 for v, _ in packed)
    assert sum(t for _, t in packed) <= 1.01 * 3 * sum(range(2049)) / 2048


@pytest.mark.parametrize(("size", "bucket"), [(2048, 50_000), (16, 7)])
def test_tables(spark, spec, size, bucket):
    rows = odd_rows()
    library = Tokenizer.from_str(spec)
    got = pack(docs(spark, rows), PATH, size=size, bucket_rows=bucket).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), size)):
            part = np.array(ids[at : at + size], "<u4")
            want.append((str(i), k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size


def test_empty(spark):
    assert pack(docs(spark, []), PATH).count() == 0
