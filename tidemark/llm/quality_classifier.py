"""Quality classifier by positive-unlabelled learning.

Trusted positives and the unlabelled web text are two sets of feature vectors;
labelled negatives are never used. With the class prior ``pi`` the model
minimises the non-negative unbiased risk

    pi * E_p[l(g)] + max(0, E_u[l(-g)] - pi * E_p[l(-g)]),   l(z) = log(1 + exp(-z))

of a linear score g over shape features of the text (shares of capitals,
symbols, repeats and so on; nothing of its language, source or id). While the
second part is positive the risk is convex and a damped Newton step is taken;
a step that would make it negative is shortened. All sums come from Spark
aggregates over a written table of feature vectors, so every document counts
and only sums of the size of the model reach the driver.

The class prior is estimated from a first model of positives against unlabelled
text: the least ratio of the two shares above any score threshold that keeps
``PRIOR_SUPPORT`` of the positives.

Null and empty texts have the vector of an empty text. Repeated rows are each
scored and each count as unlabelled text; several labels of one id count as
positive if the least of them is 1. Without positives every score is the prior
0.5. Empty tables give an empty result. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import by_text, cut, join_rows, map_arrow, small_side, text_frame

THRESHOLD = 0.3
#: Share of the positives that a score threshold must keep to speak for the prior.
PRIOR_SUPPORT = 0.5
RIDGE = 1e-4
ROUNDS = 12
STEPS = (1.0, 0.5, 0.25, 0.1)


def _class(chars: bytes | range) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_BYTE_CLASSES = {
    "capitals": _class(range(65, 91)), "digits": _class(range(48, 58)), "exclaims": _class(b"!"), "symbols": _class(b"#*$%&"),
    "bars": _class(b"|"), "angles": _class(b"<>{}[]=\\/_~^"), "ends": _class(b".?"), "commas": _class(b",;:"), "feeds": _class(b"\n"),
}
FEATURES = [*_BYTE_CLASSES, "next_same", "second_same", "windows_same", "lines_same", "distinct", "word_length", "words", "line_words", "one"]


def features(block: W.Words, offsets: np.ndarray) -> np.ndarray:
    """Feature vectors (texts x FEATURES) of a block."""
    n, data, counts = len(block), block.data, block.counts()
    words = np.maximum(counts, 1).astype(float)
    text = block.text_of()
    out = []
    for table in _BYTE_CLASSES.values():
        total = np.append(0, np.cumsum(table[data]))
        out.append(np.log1p(10 * (total[offsets[1:]] - total[offsets[:-1]]) / words))

    def share(mask: np.ndarray, owners: np.ndarray) -> np.ndarray:
        return np.bincount(owners[mask], minlength=n) / words

    for gap in (1, 2):
        same = (block.hash[gap:] == block.hash[:-gap]) & (text[gap:] == text[:-gap])
        out.append(np.log1p(10 * share(same, text[gap:])))
    # later occurrences of three-word windows and of whole lines
    for keys, owners in (_three(block, text), _lines(block, offsets)):
        order = np.lexsort((keys, owners))
        same = (keys[order][1:] == keys[order][:-1]) & (owners[order][1:] == owners[order][:-1])
        out.append(np.log1p(10 * share(same, owners[order][1:])))
    order = np.lexsort((block.hash, text))
    fresh = np.append(True, (block.hash[order][1:] != block.hash[order][:-1]) | (text[order][1:] != text[order][:-1]))[:len(text)]
    distinct = np.bincount(text[order][fresh], minlength=n)
    out.append(np.log1p(distinct) / np.log1p(words))
    letters = np.bincount(text, weights=block.end - block.start, minlength=n)
    feeds = np.append(0, np.cumsum(data == 10))
    out += [np.log1p(letters / words), np.log1p(words), np.log1p(words / (1 + feeds[offsets[1:]] - feeds[offsets[:-1]])), np.ones(n)]
    return np.stack(out, axis=1)


def _three(block: W.Words, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    windows = W.window_hashes(block.hash, 3)
    at = np.flatnonzero(text[:len(windows)] == text[2:]) if len(windows) else np.zeros(0, np.int64)
    return windows[at], text[at]


def _lines(block: W.Words, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each line, a line being words up to a line feed."""
    feeds = np.append(0, np.cumsum(block.data == 10))
    line = feeds[block.start]
    text = block.text_of()
    begins = np.flatnonzero(np.append(True, (line[1:] != line[:-1]) | (text[1:] != text[:-1]))[:len(text)])
    return W.span_hashes(block.hash, begins, np.append(begins[1:], len(text))[:len(begins)]), text[begins]


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, offsets = W.text_buffer(batch.column("_text"))
        for begin, block in W.blocks(batch.column("_text"), W.SPACES, fold=False):
            own = offsets[begin:begin + len(block) + 1]
            x = features(block, own - own[0]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column("_id").slice(begin, len(block)), pa.array([v.tobytes() for v in x], pa.binary())],
                                             names=["_id", "x"])


def feature_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, x): one row per document, x the float32 vector as bytes."""
    source = text_frame(docs, id_col, text_col)
    return map_arrow(source, _featured, f"_id {source.schema['_id'].dataType.simpleString()}, x binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, len(FEATURES)).astype(np.float64)


def _total(table: DataFrame, sums, width: int) -> np.ndarray:
    """Sum over all rows of ``sums(x, positive) -> vector``, added up by Spark."""
    def partial(batches):
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += sums(_matrix(batch.column("x")), batch.column("positive").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["i", "v"])

    rows = map_arrow(table.select("x", "positive"), partial, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(width)
    for i, v in rows:
        out[i] = v
    return out


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


class Model:
    """Linear score over standardised features, with its class prior."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, prior: float):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        g = ((x - self.mean) / self.scale) @ self.weights
        return 1 / (1 + np.exp(-np.clip(g, -35, 35)))


def _fit(table: DataFrame, mean, scale, n_p: float, n_u: float, prior: float, weights: np.ndarray) -> np.ndarray:
    """Damped Newton on the non-negative risk; one Spark pass a round gives
    risk, gradient and curvature for every length of the step."""
    d = len(weights)
    size = 3 + d + d + d * d
    direction, best = np.zeros(d), None
    for _ in range(ROUNDS):
        tries = [weights - s * direction for s in STEPS] if best is not None else [weights]

        def sums(x, positive, tries=tries):
            z = (x - mean) / scale
            out = []
            for w in tries:
                g = z @ w
                p = 1 / (1 + np.exp(-np.clip(g, -35, 35)))
                gp, zp = g[positive], z[positive]
                out += [[_softplus(-gp).sum(), _softplus(gp).sum(), _softplus(g).sum()], zp.sum(axis=0), p @ z, ((z * (p * (1 - p))[:, None]).T @ z).ravel()]
            return np.concatenate(out)

        total = _total(table, sums, size * len(tries)).reshape(len(tries), size)
        chosen = None
        for w, t in zip(tries, total, strict=True):
            below = t[2] / n_u - prior * t[1] / n_p
            risk = prior * t[0] / n_p + max(0.0, below) + RIDGE * w[:-1] @ w[:-1]
            if below >= 0 and (best is None or risk < best - 1e-9):
                chosen = (risk, w, t)
                break
        if chosen is None:
            break
        gain = np.inf if best is None else best - chosen[0]
        best, weights, t = chosen
        ridge = np.append(np.full(d - 1, 2 * RIDGE), 1e-9)
        gradient = t[3 + d:3 + 2 * d] / n_u - prior * t[3:3 + d] / n_p + ridge * weights
        direction = np.linalg.solve(t[3 + 2 * d:].reshape(d, d) / n_u + np.diag(ridge) + 1e-8 * np.eye(d), gradient)
        if gain < 1e-6:
            break
    return weights


def class_prior(table: DataFrame, model: Model, n_p: float, n_u: float, bins: int = 1000, support: float = PRIOR_SUPPORT) -> float:
    """Least ratio of the shares of unlabelled text and of positives above a score."""
    def sums(x, positive):
        at = np.minimum((model.score(x) * bins).astype(int), bins - 1)
        return np.concatenate([np.bincount(at, minlength=bins), np.bincount(at[positive], minlength=bins)]).astype(float)

    total = _total(table, sums, 2 * bins).reshape(2, bins)
    above_u, above_p = (np.cumsum(t[::-1]) / n for t, n in zip(total, (n_u, n_p), strict=True))
    kept = above_p >= support
    return float(np.clip((above_u[kept] / above_p[kept]).min(), 0.05, 0.98)) if kept.any() else 0.5


def train(table: DataFrame) -> Model:
    """``table``: (x, positive) of all text; every row is unlabelled text, and
    the rows marked positive are the trusted positives as well."""
    d = len(FEATURES)
    basic = _total(table, lambda x, p: np.concatenate([[len(x), p.sum()], x.sum(axis=0), (x * x).sum(axis=0)]), 2 + 2 * d)
    n_u, n_p = basic[:2]
    if not n_u or not n_p:
        return Model(np.zeros(d), np.ones(d), np.zeros(d), 0.5)
    mean = basic[2:2 + d] / n_u
    scale = np.sqrt(np.maximum(basic[2 + d:] / n_u - mean * mean, 0))
    scale[scale < 1e-6] = 1
    mean[-1], scale[-1] = 0, 1  # the constant
    first = _fit(table, mean, scale, n_p, n_u, 0.5, np.zeros(d))
    prior = class_prior(table, Model(mean, scale, first, 0.5), n_p, n_u)
    start = np.zeros(d)
    start[-1] = np.log(prior / (1 - prior))
    return Model(mean, scale, _fit(table, mean, scale, n_p, n_u, prior, start), prior)


def score_quality(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", threshold: float = THRESHOLD, id_field: str | None = None) -> DataFrame:
    """(id, score, predicted) per document. ``labels``: id and 0/1 label;
    ``may_learn`` is a condition on its id: only those labels are looked at.
    ``id_field``: the field of the documents' id that labels go by, if it is a struct."""
    good = (labels.where(may_learn).where(labels[id_col].isNotNull() & labels[label_col].isNotNull())
            .groupBy(labels[id_col].alias("_of")).agg(F.min(labels[label_col]).alias("_y")).where("_y = 1").select("_of"))
    good = cut(good)
    marked = small_side(good, good.count(), 24)
    table = cut(feature_table(docs, id_col, text_col).join(marked, F.col(f"_id.{id_field}" if id_field else "_id") == F.col("_of"), "left")
                .select("_id", "x", F.col("_of").isNotNull().alias("positive")))
    model = train(table)

    def scored(batches):
        for batch in batches:
            scores = model.score(_matrix(batch.column("x"))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(scores)], names=["_id", "score"])

    kind = table.schema["_id"].dataType.simpleString()
    return (map_arrow(table.select("_id", "x"), scored, f"_id {kind}, score double")
            .select(F.col("_id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted")))


def drop_low_quality(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that the classifier rejects, by id and
    text: other texts of the same id stay, as do rows without an id."""
    found = score_quality(by_text(docs, id_col, text_col), labels, may_learn, id_col, text_col, id_field="id", **options)
    return join_rows(docs, found.where("predicted = 0").select(id_col), id_col, text_col, "left_anti")
