"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted arrays that workers map into memory."""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrflow.llm.common import Scratch, bytes_of, mixed, text_chunks, text_or_empty, word_hashes

#: Hash of the end of a text, which counts as a token.
END = int(mixed(np.array([0xE0D], np.uint64))[0])
#: Counts from here on are kept in a list of their own, so that the others take one byte.
LARGE = 255


def mapped_folder(path: str) -> str:
    """The folder as every worker sees it. Mapping files needs a mounted path, so other stores are an error."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"the model is mapped into memory: {path} must be a mounted folder that all executors share")
    return parts.path


def _write(path: str, array: np.ndarray) -> None:
    """Whole file or none: a repeated task replaces what an earlier attempt wrote."""
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        np.save(f, array)
    os.replace(own, path)


def _read(path: str) -> np.ndarray:
    return np.load(path, mmap_mode="r")


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, each text with its end, and the number of tokens of each text."""
    hashes, counts = word_hashes(*bytes_of(batch.column("text")))
    ends = np.cumsum(counts + 1) - 1
    tokens = np.empty(len(hashes) + len(counts), np.uint64)
    is_word = np.ones(len(tokens), bool)
    is_word[ends] = False
    tokens[is_word], tokens[ends] = hashes, END
    return tokens, counts + 1


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


class _Tally:
    """Counts keys of a task; what it holds is summed whenever it has doubled, and given out in bounded portions."""

    def __init__(self, most: int = 8_000_000):
        self.most, self.keys, self.counts, self.size, self.settled = most, [], [], 0, 0

    def add(self, keys: np.ndarray) -> bool:
        """Whether it is time to ``take`` the counts."""
        keys, counts = np.unique(keys, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.size > max(2 * self.settled, 1_000_000):
            self.keys, self.counts = ([x] for x in _summed(np.concatenate(self.keys), np.concatenate(self.counts)))
            self.size = self.settled = len(self.keys[0])
        return self.size > self.most

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = _summed(np.concatenate(self.keys or [np.zeros(0, np.uint64)]), np.concatenate(self.counts or [np.zeros(0, np.int64)]))
        self.__init__(self.most)
        return out


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = _Tally(2_000_000)

    def rows() -> pa.RecordBatch:
        keys, counts = tally.take()
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["h", "n"])

    for batch in text_chunks(batches):
        if tally.add(_tokens(batch)[0]):
            yield rows()
    yield rows()


@dataclass
class BigramModel:
    """Where the arrays lie and the few numbers that go with them; tasks open the arrays on demand.

    Words are numbered by their place in the sorted hash arrays. Array ``key`` of a bigram shard holds first word * 2**32 + second word in order,
    ``count`` the counts. The first word of a text follows the number ``words``.
    """

    folder: str
    bits: int  # word shards are 2**bits ranges of the hash
    sizes: list[int]  # of the word shards
    tokens: int
    texts: int
    shards: int  # of bigrams
    split: int  # a first word with more tokens than that is dealt over several shards
    discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    word_discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    types: int = 0  # distinct bigrams
    word_types: tuple[int, int, int] = (0, 0, 0)  # words that follow one, two, more different words
    opened: dict = field(default_factory=dict)

    @property
    def words(self) -> int:
        return sum(self.sizes)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "opened"} | {"opened": {}}

    def array(self, name: str, shard: int) -> np.ndarray:
        if (name, shard) not in self.opened:
            self.opened[name, shard] = _read(f"{self.folder}/{name}-{shard}.npy")
        return self.opened[name, shard]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words by hash; -1 for words that training did not see."""
        keys, inverse = np.unique(hashes, return_inverse=True)
        out = np.full(len(keys), -1, np.int64)
        edges = np.searchsorted(self.shard_of(keys), np.arange(len(self.sizes) + 1))
        base = 0
        for s, size in enumerate(self.sizes):
            part = keys[edges[s] : edges[s + 1]]
            if len(part) and size:
                held = self.array("hash", s)
                at = np.minimum(np.searchsorted(held, part), size - 1)
                out[edges[s] : edges[s + 1]] = np.where(held[at] == part, at + base, -1)
            base += size
        return out[inverse]

    def shard_of(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)

    def of_words(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Values of an array that runs along the words; 0 for -1 and for the start of a text."""
        keys, inverse = np.unique(ids, return_inverse=True)
        out = np.zeros(len(keys), np.int64)
        edges = np.searchsorted(keys, np.cumsum([0, *self.sizes]))
        base = 0
        for s, size in enumerate(self.sizes):
            part = slice(edges[s], edges[s + 1])
            if part.start < part.stop:
                out[part] = self.array(name, s)[keys[part] - base]
            base += size
        return out[inverse]

    def before(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The first word of the bigram that ends at each token."""
        first = np.concatenate(([self.words], ids[:-1]))
        first[np.cumsum(counts) - counts] = self.words
        return first

    def context_counts(self, first: np.ndarray) -> np.ndarray:
        """How often each first word was followed by something in training."""
        return np.where(first == self.words, self.texts, self.of_words("count", first))

    def bigram_shards(self, first: np.ndarray, second: np.ndarray, seen: np.ndarray) -> np.ndarray:
        parts = np.minimum(-(-np.maximum(seen, 1) // self.split), self.shards).astype(np.uint64)
        spread = mixed(second.astype(np.uint64) + np.uint64(1)) % parts
        return ((mixed(first.astype(np.uint64) + np.uint64(1)) + spread) % np.uint64(self.shards)).astype(np.int64)

    def bigram_counts(self, first: np.ndarray, second: np.ndarray, seen: np.ndarray) -> np.ndarray:
        out = np.zeros(len(first), np.int64)
        known = np.flatnonzero((first >= 0) & (second >= 0) & (seen > 0))
        keys = (first[known].astype(np.uint64) << np.uint64(32)) | second[known].astype(np.uint64)
        shard = self.bigram_shards(first[known], second[known], seen[known])
        order = np.lexsort((keys, shard))
        keys, shard, known = keys[order], shard[order], known[order]
        edges = np.searchsorted(shard, np.arange(self.shards + 1))
        for s in range(self.shards):
            part = slice(edges[s], edges[s + 1])
            if part.start == part.stop or not os.path.exists(f"{self.folder}/key-{s}.npy"):
                continue
            held = self.array("key", s)
            at = np.minimum(np.searchsorted(held, keys[part]), len(held) - 1)
            value = np.where(held[at] == keys[part], self.array("small", s)[at], 0).astype(np.int64)
            large = np.flatnonzero(value == LARGE)
            value[large] = self.array("large", s)[np.searchsorted(self.array("large_at", s), at[large])]
            out[known[part]] = value
        return out

    @staticmethod
    def _discounted(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
        return np.maximum(counts - np.array((0.0, *discounts))[np.minimum(counts, 3)], 0.0)

    def word_probability(self, ids: np.ndarray) -> np.ndarray:
        """Share of the different words that a word follows, discounted and interpolated with all words alike."""
        kept = self._discounted(self.of_words("follows", ids), self.word_discounts) / max(1, self.types)
        rest = float(np.dot(self.word_discounts, self.word_types)) / self.types if self.types else 1.0
        return kept + rest / (self.words + 1)

    def probability(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Probability of ``second`` after ``first``; over all words and one unknown word they sum to one."""
        seen = self.context_counts(first)
        lower = self.word_probability(second)
        counts = self.bigram_counts(first, second, seen)
        start = first == self.words
        rest = np.zeros(len(first))
        for k, d in enumerate(self.discounts):
            own = np.where(start, self.array("start", 0)[k], self.of_words(f"types{k + 1}", first))
            rest += d * own
        total = np.maximum(seen, 1)
        return np.where(seen > 0, self._discounted(counts, self.discounts) / total + rest / total * lower, lower)

    def scores(self, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """Of each text: tokens, known tokens, base score and model score."""
        hashes, counts = _tokens(batch)
        ids, begin = self.ids(hashes), np.cumsum(counts) - counts
        own = self.of_words("count", ids)
        base = np.log10((own + 1) / (self.tokens + self.words + 1))
        score = np.log10(self.probability(self.before(ids, counts), ids))
        return counts, np.add.reduceat((own > 0).astype(np.int64), begin), np.add.reduceat(base, begin), np.add.reduceat(score, begin)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Discounts for counts 1, 2 and more from the numbers of types with counts 1 to 4; fixed halves where these are missing."""
    if min(n[:3]) <= 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    found = (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2])
    return tuple(min(max(d, 0.1), k + 0.9) for k, d in enumerate(found))


def _write_words(folder: str):
    """Writes one word shard; gives its size."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        hashes = table.column("h").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        _write(f"{folder}/hash-{shard}.npy", hashes[order])
        _write(f"{folder}/count-{shard}.npy", table.column("n").to_numpy()[order])
        return pa.table({"shard": pa.array([shard], pa.int64()), "size": pa.array([table.num_rows], pa.int64())})

    return run


def _bigrams(model: BigramModel):
    """Counts bigrams of a task and gives them out as one row a shard: sorted keys and their counts, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()

        def rows() -> pa.RecordBatch:
            keys, counts = tally.take()
            first, second = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            shard = model.bigram_shards(first, second, model.context_counts(first))
            order = np.argsort(shard, kind="stable")
            found, at = np.unique(shard[order], return_index=True)
            parts = np.split(order, at[1:]) if len(found) else []
            small = [counts[p].astype(np.min_scalar_type(int(counts[p].max()))) for p in parts]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(found, pa.int64()),
                    pa.array([keys[p].tobytes() for p in parts], pa.binary()),
                    pa.array([c.tobytes() for c in small], pa.binary()),
                ],
                ["shard", "keys", "counts"],
            )

        for batch in text_chunks(batches):
            hashes, counts = _tokens(batch)
            ids = model.ids(hashes)
            if tally.add((model.before(ids, counts).astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64)):
                yield rows()
        yield rows()

    return run


STATS = "shard long, kind int, ids binary, counts binary"


def _write_bigrams(model: BigramModel):
    """Merges one bigram shard, writes it, and gives per word shard what its words add up to in this shard."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard, keys, counts = key[0].as_py(), [], []
        for k, c in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist(), strict=True):
            k = np.frombuffer(k, np.uint64)
            keys.append(k)
            counts.append(np.frombuffer(c, f"u{len(c) // len(k)}").astype(np.int64))
        keys, counts = _summed(np.concatenate(keys), np.concatenate(counts))
        _write(f"{model.folder}/key-{shard}.npy", keys)
        _write(f"{model.folder}/small-{shard}.npy", np.minimum(counts, LARGE).astype(np.uint8))
        _write(f"{model.folder}/large_at-{shard}.npy", np.flatnonzero(counts >= LARGE))
        _write(f"{model.folder}/large-{shard}.npy", counts[counts >= LARGE])
        first, second = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        rows = [(-1, 0, np.arange(1, 5), np.array([(counts == k).sum() for k in range(1, 5)]))]
        edges = np.cumsum([0, *model.sizes])
        of = [(0, second)] + [(k, first[counts == k] if k < 3 else first[counts >= 3]) for k in (1, 2, 3)]
        for kind, ids in of:
            ids, n = np.unique(ids, return_counts=True)
            cuts = np.searchsorted(ids, edges)
            for s in range(len(model.sizes)):
                if cuts[s] < cuts[s + 1]:
                    part = slice(cuts[s], cuts[s + 1])
                    rows.append((s, kind, ids[part] - edges[s], n[part]))
            if len(ids) and ids[-1] == model.words:
                rows.append((-2, kind, ids[-1:] * 0, n[-1:]))
        return pa.table(
            {
                "shard": pa.array([r[0] for r in rows], pa.int64()),
                "kind": pa.array([r[1] for r in rows], pa.int32()),
                "ids": pa.array([r[2].astype(np.uint32).tobytes() for r in rows], pa.binary()),
                "counts": pa.array([r[3].astype(np.uint32).tobytes() for r in rows], pa.binary()),
            }
        )

    return run


NAMES = ("follows", "types1", "types2", "types3")


def _write_stats(model: BigramModel):
    """Sums up what concerns the words of one shard and writes it; gives numbers of words by how many words they follow.

    Shards -1 and -2 are the totals of all bigrams by count, and the start of texts.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        size = model.sizes[shard] if shard >= 0 else 5 if shard == -1 else 1
        sums = np.zeros((4, size), np.int64)
        for kind, ids, counts in zip(*(table.column(c).to_pylist() for c in ("kind", "ids", "counts")), strict=True):
            np.add.at(sums[kind], np.frombuffer(ids, np.uint32), np.frombuffer(counts, np.uint32))
        out = sums[0, 1:5]
        if shard >= 0:
            for name, values in zip(NAMES, sums, strict=True):
                _write(f"{model.folder}/{name}-{shard}.npy", values.astype(np.min_scalar_type(int(values.max(initial=0)))))
            f = sums[0]
            out = np.array([(f == 1).sum(), (f == 2).sum(), (f == 3).sum(), (f == 4).sum(), (f >= 3).sum(), f.sum()])
        elif shard == -2:
            _write(f"{model.folder}/start-0.npy", sums[1:, 0])
            out = sums[1:, 0]
        return pa.table({"shard": pa.array([shard], pa.int64()), "numbers": pa.array([out.tolist()], pa.list_(pa.int64()))})

    return run


def train_bigrams(docs: DataFrame, text: str = "text", word_shard: int = 1 << 21, bigram_shard: int = 4_000_000) -> BigramModel:
    """Counts words and bigrams of every whole text of ``docs`` and writes the model's arrays to the shared folder.

    Words are runs of characters other than white space (``[\\x20\\x09-\\x0D]``), A-Z lower-cased; every text ends with an
    end token, so a null or empty text is one token. Shards are sized by the counts: about ``word_shard`` words, and bigrams of at most about
    ``bigram_shard`` tokens. A word that starts very many bigrams is dealt over several shards by the second word. Nothing is
    pruned or sampled. Only the number and sizes of the shards, and counts of counts, come to the driver.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "bigrams")
    folder = f"{mapped_folder(scratch.root)}/arrays"
    os.makedirs(folder, exist_ok=True)
    texts = docs.select(text_or_empty(text).alias("text"))
    words = texts.mapInArrow(_word_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    words = scratch.save(words, "words")
    total = words.agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).first()
    if total.words >= 1 << 32:
        raise ValueError("more than 2**32 different words")
    ended = words.filter(F.col("h") == int(np.array([END], np.uint64).view(np.int64)[0])).first()
    bits = max(0, math.ceil(math.log2(max(1, total.words) / word_shard)))
    shard = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")
    sizes = [0] * (1 << bits)
    for row in words.withColumn("shard", shard).groupBy("shard").applyInArrow(_write_words(folder), "shard long, size long").collect():
        sizes[row["shard"]] = row["size"]
    model = BigramModel(
        folder, bits, sizes, total.tokens or 0, ended.n if ended else 0, max(1, -(-(total.tokens or 0) // bigram_shard)), bigram_shard
    )
    parts = texts.mapInArrow(_bigrams(model), "shard long, keys binary, counts binary")
    stats = scratch.save(parts.groupBy("shard").applyInArrow(_write_bigrams(model), STATS), "stats")
    rows = stats.groupBy("shard").applyInArrow(_write_stats(model), "shard long, numbers array<long>").collect()
    found = {row["shard"]: row["numbers"] for row in rows}
    if -2 not in found:
        _write(f"{folder}/start-0.npy", np.zeros(3, np.int64))
    of_words = [sum(column) for column in zip(*(v for s, v in found.items() if s >= 0), strict=True)] or [0] * 6
    for s, size in enumerate(sizes):  # a word shard without statistics: nothing follows or is followed
        if s not in found:
            for name in NAMES:
                _write(f"{folder}/{name}-{s}.npy", np.zeros(size, np.uint8))
    model.discounts = discounts(found.get(-1, [0] * 4))
    model.word_discounts = discounts(of_words[:4])
    model.types, model.word_types = of_words[5], (of_words[0], of_words[1], of_words[4])
    scratch.drop(words, stats)
    return model


def _scored(model: BigramModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            n, known, base, score = model.scores(batch)
            perplexity = 10 ** np.minimum(-score / n, 300)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, (n, known, base, score, perplexity))], ["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"]
            )

    return run


def bigram_scores(docs: DataFrame, model: BigramModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score and perplexity a token of every whole text.

    ``score`` is the log10 probability of the text with its end under the model, ``base_score`` that under add-one word
    frequencies. Null texts count as empty and hold the end alone. Words that training did not see share one
    unknown word. Rows repeat as they come. A model of no text gives every text the score 0.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double, perplexity double"
    return rows.mapInArrow(_scored(model), schema)
