"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled."""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hrflow.llm.common import text_chunks, text_or_empty

#: A sentence ends at a line end, or after one of these marks and white space.
SENTENCE_END = re.compile(r"(?<=[.!?…。！？])\s+|[\n\r]+")
WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> list[str]:
    return [s for s in SENTENCE_END.split(text) if s.strip()]


def features(word: str) -> list[str]:
    """The word itself and its beginnings of 3 to 5 letters, so that rare forms of a known stem have evidence too."""
    return [word, *("^" + word[:n] for n in (3, 4, 5) if n <= len(word))]


@dataclass
class ToxicityModel:
    """Weights of words and word beginnings, and the bias of a sentence's logit."""

    weights: dict[str, float]
    bias: float

    def word_weight(self, word: str, known: dict[str, float]) -> float:
        """The word's weight, remembered in ``known``, which is emptied when it has grown large."""
        if len(known) > 200_000:
            known.clear()
        known[word] = weight = sum(self.weights.get(x, 0.0) for x in features(word))
        return weight

    def sentence_scores(self, found: list[str], known: dict[str, float] | None = None) -> np.ndarray:
        known = {} if known is None else known
        logits = []
        for s in found:
            z = self.bias
            for word in set(WORD.findall(s.lower())):
                weight = known.get(word)
                z += self.word_weight(word, known) if weight is None else weight
            logits.append(z)
        z = np.array(logits, np.float64)
        return np.where(np.isneginf(z), 0.0, 1 / (1 + np.exp(-np.clip(z, -500, 500))))

    def score(self, text: str, known: dict[str, float] | None = None) -> tuple[float, int, float, str]:
        """Noisy-or over the sentences; number, score and text of the worst sentence (-1, 0, empty without any)."""
        found = sentences(text)
        if not found:
            return 0.0, -1, 0.0, ""
        p = self.sentence_scores(found, known)
        worst = int(p.argmax())
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())), worst, float(p[worst]), found[worst]


def fit(
    texts: list[str],
    labels: list[int],
    min_docs: int = 3,
    steps: int = 100,
    penalty: float = 2e-4,
    rate: float = 0.15,
    stands_for: tuple[float, float] = (1.0, 1.0),
) -> ToxicityModel:
    """Weights that maximise the likelihood of the document labels under noisy-or over sentences.

    Gradient steps (Adam) with an L1 shrinkage that leaves features without evidence at zero. Features that occur in
    fewer than ``min_docs`` documents have no weight. With labels of one kind only, the model is that share everywhere.
    A document counts as often as ``stands_for`` says of its label, so that a sample keeps the shares of what it was drawn from.
    """
    y = np.array(labels, np.float64)
    counts = np.array(stands_for, np.float64)[y.astype(np.int64)]
    share = ((counts * y).sum() + 0.5) / (counts.sum() + 1)
    counts = counts * (len(y) / max(1.0, counts.sum()))
    words: dict[str, int] = {}
    word, cell, owner, seen = [], [], [], Counter()
    for d, text in enumerate(texts):
        present = set()
        for sentence in sentences(text):
            bag = set(WORD.findall(sentence.lower()))
            word += [words.setdefault(x, len(words)) for x in bag]
            cell += [len(owner)] * len(bag)
            owner.append(d)
            present |= bag
        seen.update({f for x in present for f in features(x)})
    size = max(1.0, counts[np.array(owner, np.int64)].sum() / max(1, len(y)))
    # Sentences without evidence start well below the share: long clean texts have thousands of them.
    bias = float(np.log(np.expm1(-np.log1p(-share) / size)) - 7)
    index = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= min_docs))}
    if not index or y.min(initial=1) == y.max(initial=0):
        return ToxicityModel({}, bias)
    links = np.array([(i, index[f]) for x, i in words.items() for f in features(x) if f in index]).reshape(-1, 2)
    of_word, of_feature = links[:, 0], links[:, 1]
    word, cell, owner = np.array(word), np.array(cell), np.array(owner)
    w, m, v = np.zeros(len(index) + 1), np.zeros(len(index) + 1), np.zeros(len(index) + 1)
    w[-1] = bias
    for t in range(1, steps + 1):
        z = w[-1] + np.bincount(cell, np.bincount(of_word, w[of_feature], len(words))[word], len(owner))
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        keep = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y))  # log of the chance of being clean
        slope = -p * (counts * np.where(y == 1, np.exp(keep) / np.maximum(-np.expm1(keep), 1e-12), -1.0))[owner]
        by_word = np.bincount(word, slope[cell], len(words))
        g = np.append(np.bincount(of_feature, by_word[of_word], len(index)), slope.sum()) / len(y)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w = w - step * m / (1 - 0.9**t)
        w[:-1] = np.sign(w[:-1]) * np.maximum(0, np.abs(w[:-1]) - np.minimum(step[:-1], 1e3) * penalty)
    names = sorted(index, key=index.get)
    return ToxicityModel({x: float(c) for x, c in zip(names, w[:-1], strict=True) if abs(c) > 1e-3}, float(w[-1]))


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_rows: int = 4000,
    max_chars: int = 20_000_000,
) -> ToxicityModel:
    """Fits a model on at most ``max_rows`` labelled documents of each label.

    The sample is a documented bound: of each label the rows with the smallest hash of the id, so it does not depend on
    order or partitioning. Labels other than 0 and 1, null ids and null texts are left out; of several labels of an id the largest
    counts. ``max_chars`` bounds what the driver holds. The labels take turns in order of the hash until it is spent; texts of
    over a hundredth of it come after all others, so none crowds out the rest. Without any row the model scores everything 0:
    nothing is known to be toxic. Each label counts as often as it occurs among all labelled
    documents, however many of them are in the sample, so scores mean the same at every size.
    """
    known = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).alias("_label"))
    known = known.withColumn("_order", F.xxhash64("_id"))
    parts = [known.filter(F.col("_label") == v).orderBy("_order", "_id").limit(max_rows) for v in (0, 1)]
    picked = F.broadcast(parts[0].union(parts[1]))  # at most 2 * max_rows narrow rows
    usable = docs.filter(F.col(text).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    total = {r["_label"]: r["count"] for r in usable.select("_id").join(known, "_id").groupBy("_label").count().collect()}
    sample = usable.join(picked, "_id")
    sample = sample.withColumn("_chars", F.char_length("_text")).filter(F.col("_chars") <= max_chars)
    sample = sample.withColumn("_long", F.col("_chars") > max_chars / 100)
    sample = sample.withColumn("_turn", F.row_number().over(Window.partitionBy("_label", "_long").orderBy("_order", "_id")))
    sample = sample.withColumn("_before", F.sum("_chars").over(_running()))
    rows = sample.filter(F.col("_before") <= max_chars).select("_text", "_label").toArrow().to_pylist()
    if not rows:
        return ToxicityModel({}, float("-inf"))
    used = Counter(r["_label"] for r in rows)
    stands_for = tuple(total[v] / used[v] if used[v] else 1.0 for v in (0, 1))
    return fit([r["_text"] for r in rows], [r["_label"] for r in rows], stands_for=stands_for)


def _running():
    return Window.partitionBy(F.lit(0)).orderBy("_long", "_turn", "_label", "_id").rowsBetween(Window.unboundedPreceding, 0)


def _scored(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in text_chunks(batches):
            found = [model.score(t, known) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(zip(*found, strict=True), KINDS, strict=True))] if found else None
            if columns:
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "worst", "worst_score", "worst_sentence"])

    return run


KINDS = (pa.float64(), pa.int32(), pa.float64(), pa.string())


def toxicity_scores(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, and number, score and text of the worst sentence of every row; the whole text is scored.

    A null or blank text has no sentence: score 0, worst -1, an empty worst sentence. Rows repeat as they come.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    schema = "doc_id long, score double, worst int, worst_score double, worst_sentence string"
    return rows.mapInArrow(_scored(model), schema)


def toxic_sentences(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, number, score and text of every sentence that scores at least ``threshold``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in text_chunks(batches):
            rows = []
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = sentences(t)
                p = model.sentence_scores(found, known)
                rows += [{"doc_id": i, "number": k, "score": float(p[k]), "sentence": found[k]} for k in np.flatnonzero(p >= threshold).tolist()]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc_id", pa.int64()), ("number", pa.int32()), ("score", pa.float64()), ("sentence", pa.string())]))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, number int, score double, sentence string")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows whose text scores below ``threshold``, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in text_chunks(batches, text=text):
            scores = [model.score(t or "", known)[0] for t in batch.column(text).to_pylist()]
            yield batch.filter(pa.array([x < threshold for x in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
