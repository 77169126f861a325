from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2
from tests.llm.data import docs, odd_rows, words

from hrflow.llm.sentencepiece_codec import Codec, decode, encode, encoding_digest

PATH = public_tokenizers.path("piece_bpe_32k.model")
BITS = ["a", "b", "the", "  ", " ", "▁", "é", "\n", "ß", "日本", "🙂", "er", "in", "on", "aaaa", "  a", "0", "1", "//", "=", "\t", "https://"]


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_equals_the_library(model, library):
    codec, r = Codec(model), random.Random(4)
    texts = ["".join(r.choice(BITS) for _ in range(r.randint(0, 60))) for _ in range(800)]
    texts += [t.replace(" ", "") for t in texts[:300]] + ["e" * 3000 + "abc" * 2000, words(1, 3000), "", " ", "\n"]
    for t in texts:
        ids = np.frombuffer(codec.encode_packed(t), "<u4").tolist()
        assert ids == library.encode(t)
        assert codec.decode(np.array(ids)) == t.replace("▁", " ")


def test_window_is_bounded_and_pieces_come_early(model):
    codec, read = Codec(model), 0

    class Text(str):
        def __getitem__(self, at):
            nonlocal read
            read = max(read, at.stop)
            return str.__getitem__(self, at)

    stream = codec.stream(Text("zxqj" * 5000))
    first = [next(stream) for _ in range(10)]
    assert "".join(first) == ("zxqj" * 50)[: len("".join(first))] and read < 200


def test_unigram_takes_the_best_sum(model):
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    proto.trainer_spec.model_type = 1
    codec, r = Codec(proto.SerializeToString()), random.Random(1)
    for _ in range(60):
        text = "".join(r.choice("thering of") for _ in range(40)).replace(" ", "▁")
        best = [(0.0, 0)] + [(-np.inf, 0)] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - 16), end):
                piece = text[start:end]
                if piece in codec.ids or end - start == 1:
                    best[end] = max(best[end], (best[start][0] + codec.scores.get(piece, codec.unknown_score), start))
        assert sum(codec.scores.get(p, codec.unknown_score) for p in codec.stream(text)) == best[-1][0]


def test_tables(spark, library):
    rows = odd_rows()
    table = docs(spark, rows)
    encoded = encode(table, PATH)
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in encoded.collect()) == sorted((str(i), tuple(library.encode(t or ""))) for i, t in rows)
    back = decode(encoded, PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in rows)
    digest = encoding_digest(table, PATH).collect()
    assert all(r.round_trip for r in digest)
    crc = lambda t: zlib.crc32(np.array(library.encode(t or ""), "<u4").tobytes())
    assert sorted((str(r.doc_id), r.n_ids, r.ids_crc32) for r in digest) == sorted((str(i), len(library.encode(t or "")), crc(t)) for i, t in rows)
    strange = encoding_digest(docs(spark, [(1, "a \u2581b"), (2, "a b")]), PATH).collect()
    assert {r.doc_id: r.round_trip for r in strange} == {1: False, 2: True}
    assert encode(docs(spark, []), PATH).count() == decode(encode(docs(spark, []), PATH), PATH).count() == 0
