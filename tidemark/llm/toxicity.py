"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, letters of other scripts that look like
Latin ones, digits and signs that stand for letters, invisible characters.
The lexicon has whole words and word stems, each weighted by the log-odds of
its document frequency in toxic and other labelled texts. Exception phrases
(a lexicon word with the word before or after it) that are as good as never
toxic cancel their match. A text's score is a logistic function of the matched
weight and of the weight per word, so longer texts need more.

Learning takes three passes over the labelled texts, each a Spark aggregate:
the features of toxic texts, the candidates' frequency in the other labelled
texts, then phrases and the calibration grid. Entries are chosen by weight in
Spark, so only lexicon-sized results reach the driver, and candidates if they
are counted to be few.

Null and empty texts match nothing and have the lowest score. Repeated rows
are each scored. Several labels of one id count as toxic if any is 1; labels
without an id or a value are ignored. Without toxic labels all scores are 0.
Empty tables give an empty result. Further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, map_arrow, small_side, text_frame

THRESHOLD = 0.7
#: A lexicon entry must be in so many toxic texts, however many there are.
MIN_DOCS = 3
#: An exception phrase must be in a tenth of this share of the other texts, and in MIN_DOCS of them.
MIN_SHARE = 0.001
#: So many candidates go to the tasks; more are joined by shuffle.
SUPPORT = 1 << 18
#: Least log-odds of a lexicon entry.
MIN_WEIGHT = 2.5
STEMS = (4, 5, 6, 7)
GRID = 64

#: Letters that look like Latin ones (Cyrillic, Greek, full width is by code point).
_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "α": "a", "ο": "o", "ρ": "p", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ɑ": "a", "ɡ": "g",
}
#: Digits that stand for letters.
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}
_FOLD = str.maketrans({**_LOOKALIKES, **_DIGITS, **{chr(0xFF41 + k): chr(97 + k) for k in range(26)},
                       **dict.fromkeys("­​‌‍⁠﻿")})
_DIGITS_ONLY = str.maketrans(_DIGITS)
_SIGN = re.compile(r"(?<=[^\W_])[@$](?=[^\W_])")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str | None) -> str:
    """Lower case with look-alikes and digit spellings undone."""
    if not text:
        return ""
    text = text.lower()
    text = text.translate(_DIGITS_ONLY if text.isascii() else _FOLD)
    if "@" in text or "$" in text:
        text = _SIGN.sub(lambda m: "a" if m[0] == "@" else "s", text)
    return text


def _entries(word: str) -> list[str]:
    """The lexicon entries that a folded word could match: ``=word`` and ``^stem``."""
    return ["=" + word, *("^" + word[:k] for k in STEMS if len(word) > k)]


class Lexicon:
    """Entries with weights, and the phrases that cancel a match."""

    def __init__(self, weights: dict[str, float], exceptions: frozenset[str] = frozenset()):
        self.weights, self.exceptions = weights, exceptions
        self._automaton = None

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "_automaton": None}

    @property
    def automaton(self):
        if self._automaton is None:
            forms: dict[str, list[tuple[bool, float]]] = {}
            for entry, weight in self.weights.items():
                forms.setdefault(entry[1:], []).append((entry[0] == "=", weight))
            self._automaton = ahocorasick.Automaton()
            for form, kinds in forms.items():
                self._automaton.add_word(form, (len(form), kinds))
            if forms:
                self._automaton.make_automaton()
        return self._automaton

    def matches(self, folded: str) -> list[tuple[str, float]]:
        """(word, weight) of each matched word, the best entry counting."""
        if not self.weights:
            return []
        found: dict[int, float] = {}
        for end, (size, kinds) in self.automaton.iter(folded):
            start = end - size + 1
            if start and folded[start - 1].isalnum():
                continue
            whole = end + 1 == len(folded) or not folded[end + 1].isalnum()
            for exact, weight in kinds:
                if exact == whole or not exact and not whole:
                    if weight > found.get(start, 0.0):
                        found[start] = weight
        out = []
        for start, weight in found.items():
            word = _WORD.match(folded, start)[0]
            if self.exceptions and any(p in self.exceptions for p in phrases(folded, start, word)):
                continue
            out.append((start, word, weight))
        return out


def phrases(folded: str, start: int, word: str) -> list[str]:
    """The word with the one before and with the one after it."""
    before = _WORD.findall(folded[max(0, start - 40):start])
    after = _WORD.search(folded, start + len(word), start + len(word) + 40)
    return [*([f"{before[-1]} {word}"] if before else []), *([f"{word} {after[0]}"] if after else [])]


def measures(folded: str, lexicon: Lexicon) -> tuple[float, float]:
    """Matched weight, and matched weight per hundred words, on a log scale."""
    total = sum(w for _, _, w in lexicon.matches(folded))
    if not total:
        return 0.0, 0.0
    return float(np.log1p(total)), float(np.log1p(100 * total / max(1, len(folded.split()))))


def _counted(batches: Iterator[pa.RecordBatch], of) -> Iterator[pa.RecordBatch]:
    """Document frequencies: ``of(folded)`` gives a text's keys; key '' counts texts."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, y in zip(batch.column("_text").to_pylist(), batch.column("y").to_pylist(), strict=True):
            counts[y].update({"", *of(fold(text))})
        keys = sorted({*counts[0], *counts[1]})
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([counts[1][k] for k in keys], pa.int64()),
                                          pa.array([counts[0][k] for k in keys], pa.int64())], names=["key", "pos", "neg"])


def _frequencies(texts: DataFrame, of) -> DataFrame:
    def counted(batches):
        yield from _counted(batches, of)
    return map_arrow(texts, counted, "key string, pos long, neg long").groupBy("key").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def learn_lexicon(texts: DataFrame) -> Lexicon:
    """``texts``: (_text, y) with y 0 or 1."""
    def every(folded):
        return {e for w in set(_WORD.findall(folded)) for e in _entries(w)}

    toxic, other = texts.where("y = 1"), texts.where("y = 0")
    n_pos, n_neg = toxic.count(), other.count()

    def weight(neg):
        odds = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((neg + 0.5) / (n_neg + 1))
        # rarely seen entries are drawn to zero
        return odds * F.col("pos") / (F.col("pos") + 3.0)

    # what isn't enough without any other text never is
    support = cut(_frequencies(toxic, every).where((F.col("pos") >= MIN_DOCS) & (F.col("key") != "") & (weight(F.lit(0)) >= MIN_WEIGHT)).select("key", "pos"))
    count = support.count()
    if not count:
        return Lexicon({})
    few = {r[0] for r in support.select("key").collect()} if count <= SUPPORT else None

    def candidates(folded):
        return {e for w in set(_WORD.findall(folded)) for e in _entries(w) if few is None or e in few}

    found = support.join(_frequencies(other, candidates).select("key", "neg"), "key", "left")
    entries = found.select("key", weight(F.coalesce("neg", F.lit(0))).alias("weight")).where(F.col("weight") >= MIN_WEIGHT)
    weights = {r[0]: r[1] for r in entries.collect()}
    lexicon = Lexicon(weights)

    def near(folded):
        return {p for start, word, _ in lexicon.matches(folded) for p in phrases(folded, start, word)}

    common = _frequencies(texts, near).where("key <> ''").where((F.col("neg") >= MIN_DOCS) & (F.col("neg") >= MIN_SHARE * n_neg / 10) & (F.col("neg") >= 10 * F.col("pos")))
    return Lexicon(weights, frozenset(r[0] for r in common.collect()))


def calibrate(texts: DataFrame, lexicon: Lexicon, ridge: float = 0.02) -> np.ndarray:
    """Weights (constant, weight, density) of the logistic score, fitted on a
    grid of the two measures, which has at most GRID * GRID cells."""
    def cells(batches):
        for batch in batches:
            count = Counter()
            for text, y in zip(batch.column("_text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                count[(*(min(GRID - 1, int(8 * v)) for v in measures(fold(text), lexicon)), y)] += 1
            at = list(count)
            yield pa.RecordBatch.from_arrays([pa.array([a[0] for a in at], pa.int64()), pa.array([a[1] for a in at], pa.int64()), pa.array([a[2] for a in at], pa.int64()),
                                              pa.array([count[a] for a in at], pa.int64())], names=["a", "b", "y", "c"])

    rows = map_arrow(texts, cells, "a long, b long, y long, c long").groupBy("a", "b", "y").agg(F.sum("c").alias("c")).collect()
    if not rows:
        return np.array([-20.0, 0.0, 0.0])
    a, b, y, c = np.array(rows, float).T
    x = np.stack([np.ones(len(a)), a / 8, b / 8], axis=1)
    w = np.zeros(3)
    penalty = np.array([1e-6, ridge, ridge]) * c.sum() * 0.01
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (c * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-6), x.T @ (c * (p - y)) + penalty * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """(id, score, predicted) per document; ``may_learn`` is a condition on the
    labels' id, and only those labels are looked at."""
    source = text_frame(docs, id_col, text_col)
    known = cut(labels.where(may_learn).where(labels[id_col].isNotNull() & labels[label_col].isNotNull())
                .groupBy(labels[id_col].alias("_of")).agg(F.max(labels[label_col]).cast("int").alias("y")).where("y in (0, 1)"))
    texts = cut(source.join(small_side(known, known.count(), 32), F.col("_id") == F.col("_of")).select("_text", "y"))
    lexicon = learn_lexicon(texts)
    c0, c1, c2 = calibrate(texts, lexicon).tolist()

    def scored(batches):
        for batch in batches:
            found = np.array([measures(fold(t), lexicon) for t in batch.column("_text").to_pylist()]).reshape(-1, 2)
            scores = 1 / (1 + np.exp(-np.clip(c0 + c1 * found[:, 0] + c2 * found[:, 1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(scores)], names=["_id", "score"])

    kind = source.schema["_id"].dataType.simpleString()
    return (map_arrow(source, scored, f"_id {kind}, score double")
            .select(F.col("_id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted")))
