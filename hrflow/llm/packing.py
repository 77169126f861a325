"""Packing of documents into sequences: length patterns fitted to the histogram by non-negative least squares."""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from hrflow.llm.common import Scratch, process_cache, text_chunks, with_row_key


class WordIds:
    """Ids of whole texts by a tokenizer that encodes pre-tokens one by one; the ids of pre-tokens are remembered.

    Pre-tokens are cut in arrays, by the class of each character that the file's own pattern tells apart; equal ones are
    brought together, so Python sees each different one of a portion once. ``exact`` tells whether the file is of the kind
    that this class knows. Other files, and texts with special tokens, go to ``tokenizers`` whole.
    """

    #: Fixed value: how the supported file splits normalised text into pre-tokens.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: Classes of characters; all others are 0. Each character is asked for once.
    SPACE, LETTER, NUMBER, UNSEEN = 1, 2, 3, 4

    def __init__(self, spec: str, most: int = 400_000, portion: int = 2 << 20):
        self.tokenizer = Tokenizer.from_str(spec)
        told = json.loads(spec)
        steps = [x.get("type") for x in (told["normalizer"] or {}).get("normalizers", [])]
        cuts = (told["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.exact = steps == ["NFC", "Replace", "Lowercase"] and cuts[0].get("pattern", {}).get("Regex") == self.PATTERN
        # The lower case of the last two depends on what stands around them.
        self.whole = [*(t["content"] for t in told.get("added_tokens", [])), "\u0130", "\u03a3"]
        self.most, self.portion, self.space = most, portion, re.compile(r"[ \t-\r]")
        self.kinds = np.full(0x110000, self.UNSEEN, np.uint8)
        # The model spells a byte as a character: itself if it is visible, else the next one from U+0100 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.spelling = {x: 256 + i for i, x in enumerate(sorted(set(range(256)).difference(shown)))}
        self._forget()

    def _kinds_of(self, codes: np.ndarray) -> np.ndarray:
        """The class of each character, as the library's own patterns tell it."""
        kind = self.kinds[codes]
        if len(kind) and kind.max() == self.UNSEEN:
            fresh = np.unique(codes[kind == self.UNSEEN])
            self.kinds[fresh] = 0
            for own, run in ((self.SPACE, r"\s+"), (self.LETTER, r"\p{L}+"), (self.NUMBER, r"\p{N}+")):
                for _, (start, end) in pre_tokenizers.Split(Regex(run), "removed", invert=True).pre_tokenize_str(fresh.tobytes().decode("utf-32-le")):
                    self.kinds[fresh[start:end]] = own
            kind = self.kinds[codes]
        return kind

    def _forget(self) -> None:
        #: The remembered pre-tokens; where the ids of each begin among ``ids``, and how many they are.
        self.known = pa.array([], pa.large_string())
        self.first, self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def of(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not self.exact:
            return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        out: list[list[bytes]] = [[] for _ in texts]
        held, size = [], 0
        for i, t in enumerate(texts):
            if any(x in t for x in self.whole):
                out[i].append(np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes())
                continue
            for part in self._parts(unicodedata.normalize("NFC", t).lower()):
                if held and size + len(part) > self.portion:
                    self._encode(held, out)
                    held, size = [], 0
                held.append((i, part))
                size += len(part) + 1
        if held:
            self._encode(held, out)
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _parts(self, text: str) -> Iterator[str]:
        """A long text in parts that begin with white space, which no pre-token holds."""
        at = 0
        while len(text) - at > self.portion and (found := self.space.search(text, at + self.portion)):
            yield text[at : found.start()]
            at = found.start()
        yield text[at:] if at else text

    def _cut(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pre-tokens and runs of white space begin, and which of them are white space."""
        kind = self._kinds_of(codes)
        begins = np.ones(len(codes), bool)
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        begins |= kind == self.NUMBER
        # An apostrophe in front of other characters takes the endings of the pattern with it.
        marks = np.flatnonzero((codes == ord("'")) & begins)
        padded = np.concatenate((codes, np.zeros(3, codes.dtype)))
        one, two = padded[marks + 1], padded[marks + 2]
        short = np.isin(one, [ord(x) for x in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        begins[marks[short | long] + 1] = False
        after = np.concatenate((marks[short] + 2, marks[long] + 3))
        begins[after[after < len(codes)]] = True
        starts = np.flatnonzero(begins)
        return starts, kind[starts] == self.SPACE

    def _encode(self, parts: list[tuple[int, str]], out: list[list[bytes]]) -> None:
        """Adds the ids of each part to those of its text."""
        joined = "\n".join([p for _, p in parts])
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        starts, blank = self._cut(codes)
        ends = np.append(starts, len(codes)).astype(np.int64)  # as characters, then as bytes
        if not joined.isascii():
            width = np.ones(len(codes) + 1, np.uint8)
            for least in (0x80, 0x800, 0x10000):
                width[1:] += codes >= least
            width[0] = 0
            ends = np.cumsum(width, dtype=np.int64)[ends]
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(joined.encode()))
        told = pieces.filter(pa.array(~blank)).dictionary_encode()
        number = self._numbers(told.dictionary)[told.indices.to_numpy()]
        count = self.count[number]
        until = np.cumsum(count)
        ids = self.ids[np.repeat(self.first[number] - until + count, count) + np.arange(until[-1] if len(until) else 0)]
        # The ids in front of a part are those of the pre-tokens that begin in front of it.
        begin = np.cumsum([0] + [len(p) + 1 for _, p in parts])
        bounds = np.concatenate(([0], until))[np.searchsorted(starts[~blank], begin)].tolist()
        for (i, _), a, b in zip(parts, bounds[:-1], bounds[1:], strict=True):
            out[i].append(ids[a:b].tobytes())

    def _numbers(self, tokens: pa.Array) -> np.ndarray:
        """The places of different pre-tokens among the remembered ones; the model encodes those that are new."""
        at = pc.index_in(tokens, self.known)
        full = len(self.known) + at.null_count > self.most or self.known.nbytes > 64 * self.most
        if at.null_count and len(self.known) and full:
            self._forget()
            at = pc.index_in(tokens, self.known)
        numbers = at.fill_null(-1).to_numpy().astype(np.int64)
        if at.null_count:
            fresh = tokens.filter(at.is_null())
            encode = self.tokenizer.model.tokenize
            found = [[x.id for x in encode(self._spelled(t))] for t in fresh.to_numpy(zero_copy_only=False)]
            numbers[numbers < 0] = len(self.known) + np.arange(len(found))
            count = np.array([len(x) for x in found], np.int64)
            self.first = np.concatenate((self.first, len(self.ids) + np.cumsum(count) - count))
            self.count = np.concatenate((self.count, count))
            self.ids = np.concatenate((self.ids, np.array(list(chain.from_iterable(found)), "<u4")))
            self.known = pa.concat_arrays([self.known, fresh])
        return numbers

    def _spelled(self, token: str) -> str:
        if token.isascii() and token.isprintable():
            return token
        return token.encode().decode("latin-1").translate(self.spelling)


def _pieces(spec: str, size: int, end_id: int):
    """Cuts each document's ids, its end included, into pieces of ``size``; one row a piece."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = process_cache("word_ids")
        if (key := zlib.crc32(spec.encode())) not in held:
            held[key] = WordIds(spec)
        for batch in text_chunks(batches):
            row, piece, length, crc = [], [], [], []
            for i, ids in enumerate(held[key].of(batch.column("text").to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    row.append(i)
                    piece.append(k)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(take) for c in ("doc_id", "k1", "k2")), pa.array(piece, pa.int32()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "k1", "k2", "piece", "length", "ids_crc32"],
            )

    return run


def patterns(size: int, present: np.ndarray) -> np.ndarray:
    """Sets of one to three lengths (zeros fill up) that occur and fill a sequence to at least ``size`` - slack tokens.

    Pairs and triples of lengths that sum to exactly ``size`` come first, then with growing slack until every occurring
    length has a pattern. Their number depends on ``size`` alone: at most size ** 2 / 12 triples.
    """
    have = np.zeros(size + 1, bool)
    have[present] = True
    rows = [np.stack([present, np.zeros_like(present), np.zeros_like(present)], axis=1)[present == size]]
    for slack in (0, 1, 2, 4, 8):
        total = size - slack
        pairs = present[(present <= total - present) & (total - present >= 1)]
        pairs = pairs[have[total - pairs]]
        rows.append(np.stack([total - pairs, pairs, np.zeros_like(pairs)], axis=1))
        if slack == 0:
            for c in present:
                b = present[(present >= c) & (present <= (total - c) // 2)]
                a = total - c - b
                b, a = b[have[a]], a[have[a]]
                rows.append(np.stack([a, b, np.full_like(b, c)], axis=1))
    return np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)


def fitted(counts: np.ndarray, rows: np.ndarray, steps: int = 300) -> np.ndarray:
    """Non-negative repeat counts x of the patterns with the least squares of (A x - counts), A counting lengths.

    Multiplicative steps x <- x * (A'b) / (A'A x), with the sequence length as weight of an unplaced token. They keep x
    non-negative and never raise the error; lengths of zero have no weight.
    """
    weight = np.arange(len(counts), dtype=np.float64)
    weight = weight * weight
    b = counts.astype(np.float64)

    def gather(v: np.ndarray) -> np.ndarray:
        return v[rows[:, 0]] + v[rows[:, 1]] + v[rows[:, 2]]

    x = np.full(len(rows), b.sum() / max(1, 3 * len(rows)))
    want = gather(weight * b)
    for _ in range(steps):
        y = sum(np.bincount(rows[:, i], x, len(b)) for i in range(3))
        x = x * want / np.maximum(gather(weight * y), 1e-30)
    return x


def plan(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) that hold ``counts[l]`` pieces of each length l.

    The fitted repeat counts are rounded down where a length runs short, and to the nearest otherwise; what is left over is
    packed best-fit, longest first, by length and count. Everything here depends on ``size`` alone, not on the number
    of documents: counts are numbers, not rows.
    """
    left = counts.astype(np.int64).copy()
    out: Counter[tuple[int, ...]] = Counter()
    present = np.flatnonzero(left)
    rows = patterns(size, present[present > 0])
    if len(rows):
        x = np.rint(fitted(left, rows)).astype(np.int64)
        for i in np.lexsort((rows[:, 0], -x)):
            if x[i] == 0:
                break
            need = Counter(int(v) for v in rows[i] if v)
            times = min(int(x[i]), *(int(left[v]) // k for v, k in need.items()))
            if times > 0:
                out[tuple(sorted(need.elements(), reverse=True))] += times
                for v, k in need.items():
                    left[v] -= times * k
    # Best fit, longest first: open bins by free space; bins with one content are one entry with a count.
    bins: dict[int, Counter[tuple[int, ...]]] = {}
    spaces: list[int] = []
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                # A new bin takes as many of this length as fit.
                per = size // length
                for held, times in ((per, n // per), (n % per, 1)):
                    if held and times:
                        _put(bins, spaces, size - held * length, (length,) * held, times)
                n = 0
                continue
            space = spaces[at]
            held, times = next(iter(bins[space].items()))
            used = min(n, times)
            _take(bins, spaces, space, held, used)
            _put(bins, spaces, space - length, (*held, length), used)
            n -= used
    for content in bins.values():
        out.update(content)
    return sorted(out.items())


def _put(bins: dict, spaces: list[int], space: int, held: tuple[int, ...], times: int) -> None:
    if space not in bins:
        bins[space] = Counter()
        insort(spaces, space)
    bins[space][held] += times


def _take(bins: dict, spaces: list[int], space: int, held: tuple[int, ...], times: int) -> None:
    bins[space][held] -= times
    if not bins[space][held]:
        del bins[space][held]
        if not bins[space]:
            del bins[space]
            spaces.pop(bisect_left(spaces, space))


class Slots:
    """Where the n-th piece of a length goes, for all lengths: ranges of ranks, looked up by bisection."""

    def __init__(self, packed: list[tuple[tuple[int, ...], int]], size: int):
        spans: dict[int, list[tuple[int, int, int, int]]] = {}  # length -> (pieces a sequence, sequences, first sequence, offset)
        first = 0
        for lengths, times in packed:
            offset = 0
            for v, k in Counter(lengths).items():
                spans.setdefault(v, []).append((k, times, first, offset))
                offset += v * k
            first += times
        self.tables = {}
        for v, parts in spans.items():
            k, times, start, offset = map(np.array, zip(*parts, strict=True))
            self.tables[v] = (np.cumsum(k * times) - k * times, k, start, offset)

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of these lengths and ranks."""
        sequence, place = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for v in np.unique(length).tolist():
            own = np.flatnonzero(length == v)
            begin, k, start, offset = self.tables[v]
            i = np.searchsorted(begin, rank[own], side="right") - 1
            inside = rank[own] - begin[i]
            sequence[own] = start[i] + inside // k[i]
            place[own] = offset[i] + inside % k[i] * v
        return sequence, place


def _placed(slots: Slots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, place = slots.of(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            kept = batch.select(["doc_id", "piece", "start", "length", "ids_crc32"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence), pa.array(place)], [*kept.schema.names, "sequence_id", "offset"]
            )

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 2048,
    end_id: int = 0,
    bucket_rows: int = 1000,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document.

    A document is its ids and ``end_id``. One of more than ``size`` ids is cut into pieces of ``size``; the last one may be
    shorter. A null or empty text is one piece that holds the end alone. Rows that repeat are packed each. An empty
    table gives an empty result.

    Method: the histogram of piece lengths (at most ``size`` numbers) comes to the driver, which fits the repeat counts of patterns of up to
    three lengths to it, rounds them and packs the residue best-fit (``plan``). The plan says how many sequences of
    which lengths there are. Pieces of a length are then numbered in buckets of about ``bucket_rows`` rows, so a length that
    a third of all pieces have is no single group, and each piece finds its place by its number.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    rows = with_row_key(docs, doc_id, text).select("doc_id", "k1", "k2", "text")
    schema = "doc_id long, k1 long, k2 long, piece int, length long, ids_crc32 long"
    pieces = scratch.save(rows.mapInArrow(_pieces(spec, size, end_id), schema), "pieces")
    histogram = pieces.groupBy("length").count().collect()  # at most ``size`` rows
    counts = np.zeros(size + 1, np.int64)
    for row in histogram:
        counts[row["length"]] = row["count"]
    slots = Slots(plan(counts, size), size)
    buckets = F.ceil(F.col("count") / bucket_rows)
    spread = F.broadcast(pieces.groupBy("length").count().select("length", buckets.alias("buckets")))  # at most ``size`` rows
    bucket = F.pmod(F.xxhash64("k1", "k2", "piece"), F.col("buckets"))
    bucketed = pieces.join(spread, "length").withColumn("bucket", bucket).drop("buckets")
    sizes = bucketed.groupBy("length", "bucket").count()
    # One count a bucket, summed in front of each bucket of its length.
    before = sizes.withColumn("first", F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count"))
    number = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("k1", "k2", "piece"))
    numbered = bucketed.withColumn("number", number).join(before.drop("count"), ["length", "bucket"])
    ranked = numbered.select(
        "doc_id", "piece", (F.col("piece") * F.lit(size).cast("long")).alias("start"), "length", "ids_crc32", (F.col("first") + F.col("number") - 1).alias("rank")
    )
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(_placed(slots), out)
