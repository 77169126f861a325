"""SentencePiece encoding and decoding by a streaming Viterbi search."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrflow.llm.common import process_cache, text_chunks, text_or_empty

SPACE = "▁"
BPE, UNIGRAM = 2, 1
NORMAL, CONTROL, USER, BYTE = 1, 3, 4, 6


class Codec:
    """Encodes and decodes with the pieces of a SentencePiece model file.

    Encoding is a Viterbi search over the characters: each boundary keeps one best last piece and its score. Only
    boundaries no further back than the longest piece can be extended, so those make up the window. Whenever the backpointer
    paths of all of them run through one boundary, the pieces up to it are final and are emitted.

    For a unigram model the best path has the largest sum of scores. For a BPE model, merges decide, not sums: a sequence is
    the result of the merges exactly if every two adjacent pieces are, when their text is merged alone. So a piece may follow
    another only if merging their joint text gives back the two, and for each prefix just one path remains.
    """

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if spec.name != "identity" or proto.trainer_spec.treat_whitespace_as_suffix or spec.remove_extra_whitespaces:
            raise ValueError("only models with identity normalisation that keep white space are supported")
        self.bpe = proto.trainer_spec.model_type == BPE
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.pieces = [p.piece for p in proto.pieces]
        kinds = [p.type for p in proto.pieces]
        usable = [i for i, k in enumerate(kinds) if k in (NORMAL, USER)]
        self.ids = {self.pieces[i]: i for i in usable}
        self.scores = {self.pieces[i]: proto.pieces[i].score for i in usable}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i, k in enumerate(kinds) if k == BYTE}
        self.of_byte = {i: b for b, i in self.bytes.items()}
        self.control = {i for i, k in enumerate(kinds) if k == CONTROL}
        self.unknown = proto.trainer_spec.unk_id
        self.unknown_score = min(self.scores.values(), default=0.0) - 10
        self.longest = max(map(len, self.ids), default=1)
        self.endings = {p[i:] for p in self.ids for i in range(len(p))}
        self.fits: dict[tuple[str, str], bool] = {}
        self.words: dict[str, bytes] = {}
        # A word is final at its end if no piece reaches from other characters into a following space mark.
        self.splits = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        # The pieces read backwards, as nested (next character, id or -1); and whether one id may follow another.
        self.tree: dict = {}
        for piece, i in self.ids.items():
            at = self.tree
            for char in reversed(piece[1:]):
                at = at.setdefault(char, [{}, -1])[0]
            at.setdefault(piece[0], [{}, -1])[1] = i
        self.pairs: dict[int, bool] = {}
        self.values = [
            b"" if i in self.control else bytes([self.of_byte[i]]) if i in self.of_byte else p.encode() for i, p in enumerate(self.pieces)
        ]

    def merge(self, text: str) -> list[str]:
        """Merges of adjacent symbols by rank, for the joint text of two pieces."""
        symbols = list(text)
        while True:
            best = max(
                ((s, -i) for i in range(len(symbols) - 1) if (s := self.scores.get(symbols[i] + symbols[i + 1])) is not None), default=None
            )
            if best is None:
                return symbols
            at = -best[1]
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def follows(self, left: str, right: str) -> bool:
        """Whether ``right`` may come after ``left`` in the result of the merges."""
        found = self.fits.get((left, right))
        if found is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            found = self.fits[left, right] = self.merge(left + right) == ([left, right] if left else [right])
        return found

    def stream(self, text: str) -> Iterator[str]:
        """The pieces of a text, each as soon as it is final."""
        ids, scores, longest, endings, fits, bpe = self.ids, self.scores, self.longest, self.endings, self.fits, self.bpe
        # Of each boundary in the window: score, last piece. The boundary it starts at follows from its length.
        window: dict[int, tuple[float, str]] = {0: (0.0, "")}
        done = 0
        for end in range(1, len(text) + 1):
            best, start, floor = None, end, max(done, end - longest)
            while start > floor:
                start -= 1
                piece = text[start:end]
                if piece not in endings and start < end - 1:
                    break
                before = window.get(start)
                if before is None or (piece not in ids and start < end - 1):
                    continue
                if not bpe:
                    score = before[0] + scores.get(piece, self.unknown_score)
                    if best is None or score >= best[0]:  # of equal sums the longer last piece
                        best = (score, piece)
                else:
                    fit = fits.get((before[1], piece))
                    if self.follows(before[1], piece) if fit is None else fit:
                        best = (0.0, piece)
                        break
            if best is not None:
                window[end] = best
            # All paths that can still grow start at a boundary no further back than the longest piece.
            if end - done >= 2 * longest:
                alive = {p for p in range(max(done, end - longest + 1), end + 1) if p in window}
                while len(alive) > 1:
                    last = max(alive)
                    alive.remove(last)
                    alive.add(last - len(window[last][1]) if last > done else done)
                meet = alive.pop()
                if meet > done:
                    yield from self._path(window, done, meet)
                    floor = min(meet, end - longest + 1)
                    window = {p: v for p, v in window.items() if p >= floor}
                    done = meet
        yield from self._path(window, done, len(text))

    @staticmethod
    def _path(window: dict[int, tuple[float, str]], start: int, end: int) -> list[str]:
        out = []
        while end > start:
            out.append(window[end][1])
            end -= len(out[-1])
        return out[::-1]

    def _ids_of(self, piece: str) -> list[int]:
        if (i := self.ids.get(piece)) is not None:
            return [i]
        if self.bytes:
            return [self.bytes[b] for b in piece.encode()]
        return [self.unknown]

    def _packed(self, text: str) -> bytes:
        return np.array([i for p in self.stream(text) for i in self._ids_of(p)], "<u4").tobytes()

    def _word(self, text: str) -> bytes:
        """The ids of a short text: the search of ``stream`` with ids in a list, as nothing has to be emitted early."""
        if not self.bpe or len(text) > 4 * self.longest:
            return self._packed(text)
        tree, pairs, get, size = self.tree, self.pairs, self.pairs.get, len(text)
        # The last piece before each boundary; the number of pieces stands for the beginning.
        last: list[int] = [len(self.pieces)] + [-1] * size
        for end in range(1, size + 1):
            below, start = tree, end
            while start:
                start -= 1
                node = below.get(text[start])
                if node is None:
                    if start == end - 1:
                        return self._packed(text)  # a character that is no piece
                    break
                below, piece = node
                if piece < 0 or (before := last[start]) < 0:
                    continue
                fit = get(before << 32 | piece)
                if fit is None:
                    if len(pairs) > 1_000_000:
                        pairs.clear()
                    left = self.pieces[before] if start else ""
                    fit = pairs[before << 32 | piece] = self.follows(left, text[start:end])
                if fit:
                    last[end] = piece
                    break
        out, end = [], len(text)
        while end:
            out.append(last[end])
            end -= len(self.pieces[out[-1]])
        return np.array(out[::-1], "<u4").tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers.

        Where pieces hold space marks only at their beginning, every word is final at its end, and so is what stands on both
        sides of a line end that is in no piece. Such parts recur, so their ids are remembered (and forgotten when they have
        become many); a long part streams like any text.
        """
        if len(self.words) > 400_000:
            self.words.clear()
        known, parts = self.words, []
        lines = "\n" not in self.endings
        for t in texts:
            t = self.prefix + t.replace(" ", SPACE) if t else ""
            if not self.splits or SPACE * 2 in t:
                parts.append(self._runs(t) if self.splits else [t])
                continue
            t = t.replace(SPACE, " " + SPACE)
            parts.append((t.replace("\n", " \n ") if lines else t).split(" "))
        seen: set[str] = set().union(*parts)
        known.update((w, self._word(w)) for w in seen.difference(known))
        return [b"".join(map(known.__getitem__, x)) for x in parts]

    @staticmethod
    def _runs(text: str) -> list[str]:
        """Words with the run of space marks in front of them; a last run stands alone."""
        return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", text)

    def encode_packed(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a list of ids: byte pieces are joined, control pieces are left out, the added space goes."""
        text = b"".join(map(self.values.__getitem__, ids.tolist())).decode(errors="replace").replace(SPACE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _codec(model: bytes) -> Codec:
    """One codec for all tasks of a Python worker, with what it has learned about words and pairs."""
    held = process_cache("sentencepiece")
    key = zlib.crc32(model), len(model)
    if key not in held:
        held[key] = Codec(model)
    return held[key]


def _model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``ids`` (array of int) of every whole text; a null or empty text has no ids. The model file is read
    by the driver and sent along (its size does not depend on the data)."""
    model = _model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in text_chunks(batches):
            packed = codec.encode_all(batch.column("text").to_pylist())
            offsets = np.concatenate(([0], np.cumsum([len(p) // 4 for p in packed]))).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(packed), "<i4"))
            ids = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and ``text`` of every row of ids; null or no ids give the empty text."""
    model = _model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            texts = [codec.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, "doc_id long, text string")


def encoding_digest(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, n_ids, ids_crc32 and whether decoding gives back the text, for every row.

    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit integers. Texts are encoded and decoded whole. A text that
    holds U+2581, the model's own sign for a space, decodes to another text, so its ``round_trip`` is false.
    """
    model = _model(model_path)
    schema = "doc_id long, n_chars long, n_ids long, ids_crc32 long, round_trip boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in text_chunks(batches):
            texts = batch.column("text").to_pylist()
            packed = codec.encode_all(texts)
            same = [codec.decode(np.frombuffer(p, "<u4")) == t for t, p in zip(texts, packed, strict=True)]
            columns = ([len(t) for t in texts], [len(p) // 4 for p in packed], [zlib.crc32(p) for p in packed])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns), pa.array(same, pa.bool_())],
                ["doc_id", "n_chars", "n_ids", "ids_crc32", "round_trip"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, schema)
