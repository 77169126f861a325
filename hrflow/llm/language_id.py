"""Languages of words and texts: script ranges, per-word scores, Viterbi with a switching penalty."""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hrflow.llm.common import text_chunks, text_or_empty

#: First code point, last code point and name of the scripts' blocks.
SCRIPTS = [
    (0x0041, 0x024F, "Latin"),
    (0x0370, 0x03FF, "Greek"),
    (0x0400, 0x052F, "Cyrillic"),
    (0x0530, 0x058F, "Armenian"),
    (0x0590, 0x05FF, "Hebrew"),
    (0x0600, 0x06FF, "Arabic"),
    (0x0750, 0x077F, "Arabic"),
    (0x0900, 0x097F, "Devanagari"),
    (0x0980, 0x09FF, "Bengali"),
    (0x0B80, 0x0BFF, "Tamil"),
    (0x0C00, 0x0C7F, "Telugu"),
    (0x0E00, 0x0E7F, "Thai"),
    (0x10A0, 0x10FF, "Georgian"),
    (0x1100, 0x11FF, "Hangul"),
    (0x1E00, 0x1EFF, "Latin"),
    (0x1F00, 0x1FFF, "Greek"),
    (0x3040, 0x30FF, "Kana"),
    (0x3400, 0x4DBF, "Han"),
    (0x4E00, 0x9FFF, "Han"),
    (0xAC00, 0xD7AF, "Hangul"),
    (0x20000, 0x2FA1F, "Han"),
]
_FIRST = [a for a, _, _ in SCRIPTS]
#: Letters, and characters with the value of a number, which are no letters and are taken out where they occur.
WORD = re.compile(r"[^\W\d_]+")
LETTERS = regex.compile(r"\p{L}+")
UNKNOWN = "und"


def script_of(char: str) -> str:
    at = bisect.bisect_right(_FIRST, ord(char)) - 1
    return SCRIPTS[at][2] if at >= 0 and ord(char) <= SCRIPTS[at][1] else "other"


def words_of(text: str) -> list[str]:
    """The runs of letters of a text, in lower case."""
    found = WORD.findall(text.lower())
    return found if all(map(str.isalpha, found)) else [part for w in found for part in LETTERS.findall(w)]


def grams(word: str, longest: int = 3) -> list[str]:
    """Letter sequences of 1 to ``longest`` of the word between two marks; long words are read in full."""
    marked = f"<{word}>"
    return [marked[i : i + n] for n in range(1, longest + 1) for i in range(len(marked) - n + 1) if n > 1 or 0 < i <= len(word)]


@dataclass
class LanguageModel:
    """Log probabilities of letter sequences in each language, whole frequent words, and scripts of each language."""

    langs: list[str]
    index: dict[str, int]  # letter sequence -> row of ``table``; the last row is for all others
    table: np.ndarray
    words: dict[str, list[float]]  # frequent word -> its gain in each language
    scripts: dict[str, list[bool]]
    penalty: float = 8.0

    def word_scores(self, words: list[str]) -> np.ndarray:
        """One row of scores a lower-case word: log probability in each language, relative to the best.

        A language that the word's script rules out has -1000; a script that training never saw rules nothing out.
        The value is a mean over the word's letter sequences times the root of its length, so that a long word does
        not count as many independent ones.
        """
        found = [grams(w) for w in words]
        get, other = self.index.get, len(self.index)
        rows = np.array([get(g, other) for x in found for g in x])
        sizes = np.array([len(x) for x in found])
        total = np.add.reduceat(self.table[rows], np.cumsum(sizes) - sizes, axis=0)
        total *= (np.sqrt([len(w) for w in words]) / sizes)[:, None]
        for i, w in enumerate(words):
            if (gain := self.words.get(w)) is not None:
                total[i] += gain
            if (allowed := self.scripts.get(script_of(w[0]))) is not None and not all(allowed):
                total[i, ~np.array(allowed)] = -np.inf
        return np.maximum(total - total.max(axis=1, keepdims=True), -1e3)

    def paths(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """The best sequence of languages of each text: sum of its words' scores less ``penalty`` for each switch.

        If no stretch of words gains more than half the penalty in another language than the best single one, that
        language is the answer: n stretches in other languages need n - 1 switches at least, and one if n is 1, which is
        half a switch a stretch or more. So this test is exact. The other texts go through Viterbi in step.
        """
        out = [np.zeros(0, np.int64)] * len(scores)
        open_ = []
        for i, rows in enumerate(scores):
            if len(rows):
                best = int(rows.sum(axis=0).argmax())
                gain = np.zeros((len(rows) + 1, rows.shape[1]))
                np.cumsum(rows - rows[:, [best]], axis=0, out=gain[1:])
                if (gain - np.minimum.accumulate(gain, axis=0)).max() <= self.penalty / 2:
                    out[i] = np.full(len(rows), best)
                else:
                    open_.append(i)
        open_.sort(key=lambda i: -len(scores[i]))
        for i, path in zip(open_, viterbi([scores[i] for i in open_], self.penalty), strict=True):
            out[i] = path
        return out


def viterbi(scores: list[np.ndarray], penalty: float, few: int = 8) -> list[np.ndarray]:
    """Best paths of texts, longest first. All texts take a step at once; the last ``few`` are finished one by one."""
    if not scores:
        return []
    sizes = np.array([len(x) for x in scores])
    starts = np.cumsum(sizes) - sizes
    flat = np.concatenate(scores)
    langs = np.arange(flat.shape[1], dtype=np.int8)
    value, back = flat[starts], []
    steps = int(sizes[few - 1]) if len(sizes) >= few else 1  # until then at least ``few`` texts go on
    for t in range(1, steps):
        n = int(np.searchsorted(-sizes, -t, side="left"))  # texts of more than t words
        v = value[:n]
        at = v.argmax(axis=1)
        floor = (v[np.arange(n), at] - penalty)[:, None]
        stay = v >= floor
        back.append(np.where(stay, langs, at[:, None].astype(np.int8)))
        value[:n] = np.where(stay, v, floor) + flat[starts[:n] + t]
    path = np.zeros(len(flat), np.int64)
    last = value.argmax(axis=1)
    for i in np.flatnonzero(sizes > steps).tolist():
        row, rest = value[i].tolist(), []
        for scored in flat[starts[i] + steps : starts[i] + sizes[i]].tolist():
            top = max(row)
            floor, at = top - penalty, row.index(top)
            rest.append([k if v >= floor else at for k, v in enumerate(row)])
            row = [(v if v >= floor else floor) + x for v, x in zip(row, scored, strict=True)]
        state = row.index(max(row))
        for t in range(len(rest) - 1, -1, -1):
            path[starts[i] + steps + t] = state
            state = rest[t][state]
        last[i] = state
    for t in range(steps - 1, -1, -1):
        n = int(np.searchsorted(-sizes, -t, side="left"))
        path[starts[:n] + t] = last[:n]
        if t:
            last[:n] = back[t - 1][np.arange(n), last[:n]]
    return [path[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]


class Reader:
    """Reads texts with a model; remembers the scores of words and forgets them when they have become many."""

    def __init__(self, model: LanguageModel, most: int = 300_000):
        self.model, self.most, self.known = model, most, {}
        self.scores = np.zeros((0, len(model.langs)))

    def paths(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The best path of each list of lower-case words."""
        if len(self.known) > self.most:
            self.known, self.scores = {}, self.scores[:0]
        fresh = list(dict.fromkeys(w for words in texts for w in words if w not in self.known))
        if fresh:
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
            self.scores = np.vstack([self.scores, *(self.model.word_scores(fresh[i : i + 20_000]) for i in range(0, len(fresh), 20_000))])
        at = self.known.__getitem__
        return self.model.paths([self.scores[np.fromiter(map(at, words), np.int64, len(words))] for words in texts])

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """The language with most letters in each text's best path, and its share of them; ties to the first name."""
        langs = self.model.langs
        words = [words_of(t) if langs else [] for t in texts]
        out = []
        for found, path in zip(words, self.paths(words), strict=True):
            if not found:
                out.append((UNKNOWN, 0.0))
                continue
            letters = np.bincount(path, np.fromiter(map(len, found), np.int64, len(found)), len(langs))
            out.append((langs[int(letters.argmax())], float(letters.max() / letters.sum())))
        return out

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """Start, end (in characters) and language of the runs of one language; none without letters."""
        found = [(m.start(), m.end(), m[0]) for m in LETTERS.finditer(text)]
        if not found or not self.model.langs:
            return []
        path = self.paths([[w.lower() for _, _, w in found]])[0]
        cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(found)]
        return [(found[a][0], found[b - 1][1], self.model.langs[int(path[a])]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def fit(texts: list[str], langs: list[str], frequent: int = 300) -> LanguageModel:
    """Counts letter sequences, frequent words and scripts of each language."""
    names = sorted(set(langs))
    words = {lang: Counter() for lang in names}
    for text, lang in zip(texts, langs, strict=True):
        words[lang].update(words_of(text))
    counts = {lang: Counter() for lang in names}
    scripts: dict[str, Counter] = {}
    for lang in names:
        for w, n in words[lang].items():
            for g in grams(w):
                counts[lang][g] += n
            scripts.setdefault(script_of(w[0]), Counter())[lang] += n
    every = set().union(*counts.values()) if names else set()
    totals = {lang: sum(counts[lang].values()) + 0.5 * (len(every) + 1) for lang in names}
    index = {g: i for i, g in enumerate(sorted(every))}
    table = np.array([[(counts[lang][g] + 0.5) / totals[lang] for lang in names] for g in index] + [[0.5 / totals[lang] for lang in names]])
    top = {w for lang in names for w, _ in words[lang].most_common(frequent)}
    sums = {lang: sum(words[lang].values()) + len(top) for lang in names}
    shares = {w: [math.log((words[lang][w] + 1) / sums[lang]) for lang in names] for w in top}
    bonus = {w: [min(4.0, max(-4.0, x - max(row))) for x in row] for w, row in shares.items()}
    total = {lang: max(1, sum(words[lang].values())) for lang in names}
    allowed = {s: [c[lang] >= 0.001 * total[lang] for lang in names] for s, c in scripts.items()}
    return LanguageModel(names, index, np.log(table), bonus, {s: a for s, a in allowed.items() if any(a)})


def train_languages(
    docs: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", max_rows: int = 2000, max_chars: int = 20_000_000
) -> LanguageModel:
    """Fits a model on at most ``max_rows`` documents of each language, those with the smallest hash of id and text.

    The sample is a documented bound, of ``max_chars`` characters in all as well. The languages take turns, smallest hash first,
    until it is spent; texts of over a hundredth of it come after all others, so none crowds out the rest. Rows with a null text or language are left out; without any row the model predicts ``und``.
    """
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(doc_id, text).alias("h"), F.char_length(text).alias("n"))
    rows = rows.filter("lang is not null and text is not null").filter(F.col("n") <= max_chars)
    # The rank is taken over narrow rows; Spark keeps the first max_rows of each task before the shuffle.
    narrow = rows.select("lang", "h", "n").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    narrow = narrow.filter(F.col("rank") <= max_rows)
    narrow = narrow.withColumn("long", F.col("n") > max_chars / 100)
    narrow = narrow.withColumn("turn", F.row_number().over(Window.partitionBy("lang", "long").orderBy("rank")))
    narrow = narrow.withColumn("before", F.sum("n").over(Window.orderBy("long", "turn", "lang").rowsBetween(Window.unboundedPreceding, 0)))
    picked = narrow.filter(F.col("before") <= max_chars).select("lang", "h").distinct()
    found = rows.select("lang", "text", "h").join(F.broadcast(picked), ["lang", "h"]).select("lang", "text").toArrow().to_pylist()
    return fit([r["text"] for r in found], [r["lang"] for r in found])


def languages(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (share of the letters) of every row, from its whole text.

    ``und`` with score 0 where the text is null or has no letter. Rows repeat as they come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in text_chunks(batches):
            found = reader.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )


def language_spans(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, end (characters) and lang of every run of one language in every text."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in text_chunks(batches):
            rows = [
                {"doc_id": i, "start": a, "end": b, "lang": lang}
                for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                for a, b, lang in reader.spans(t)
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(
        run, "doc_id long, start long, end long, lang string"
    )
