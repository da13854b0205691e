"""Quality rules judged by host: per-document counts, then rule-failure rates
per domain shrunk by an empirical beta prior.

A document that fails a base rule goes; a document that passes goes as well if
its host's shrunken failure rate is above ``max_rate``. The prior's two
parameters come from all hosts by the method of moments, so a host with few
documents is drawn to the corpus rate and a host is rejected only on evidence.

Defined results: null and empty texts have no words and fail. A null host is a
host of its own. Repeated rows are each counted and each returned. An empty
table gives an empty result. A corpus of one host, or without spread between
hosts, gets the weakest prior (strength 1).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import cut, map_arrow

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_HOST_RATE = 0.5

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_NOT_FIRST = np.zeros(256, bool)
_NOT_FIRST[0x80:0xC0] = True
_COUNTS = ["_words", "_word_chars", "_symbols", "_dup_lines", "_repeat_words"]


def _prefix(mask: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total


def _repeated(groups: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of (group, key) pairs: which occur twice or more; which are not the first."""
    order = np.lexsort((keys, groups))
    g, k = groups[order], keys[order]
    same = (g[1:] == g[:-1]) & (k[1:] == k[:-1])
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    later[order[1:][same]] = True  # lexsort is stable: the first of equals stays first
    return twice, later


def text_counts(block: W.Words, offsets: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    data, n = block.data, len(block)
    chars = _prefix(~W.SPACES[data] & ~_NOT_FIRST[data])[offsets]
    symbols = _prefix(_SYMBOLS[data])[offsets]
    text = block.text_of()
    at = np.arange(len(text))

    # lines: hash of the raw bytes between line feeds
    feeds = np.flatnonzero(data == 10)
    owner = np.searchsorted(offsets, feeds, side="right") - 1
    line_text = np.concatenate([np.arange(n), owner])
    line_start = np.concatenate([offsets[:-1], feeds + 1])
    order = np.lexsort((line_start, line_text))
    line_text, line_start = line_text[order], line_start[order]
    last = np.append(line_text[1:] != line_text[:-1], True) if len(line_text) else np.zeros(0, bool)
    line_end = np.where(last, offsets[line_text + 1], np.append(line_start[1:] - 1, 0)[:len(line_start)])
    has_word = np.searchsorted(block.start, line_end) > np.searchsorted(block.start, line_start)
    line_text, line_start, line_end = line_text[has_word], line_start[has_word], line_end[has_word]
    lines = W.span_hashes(W.mix(data.astype(np.uint64) + np.uint64(1)), line_start, line_end)
    _, later = _repeated(line_text, lines)
    dup_lines = np.bincount(line_text[later], minlength=n)

    repeat = np.zeros(n, np.int64)
    windows = W.window_hashes(block.hash, WINDOW)
    whole = np.flatnonzero(text[:len(windows)] == text[WINDOW - 1:]) if len(windows) else at[:0]
    if len(whole):
        twice, _ = _repeated(text[whole], windows[whole])
        edge = np.zeros(len(text) + 1, np.int64)
        np.add.at(edge, whole[twice], 1)
        np.add.at(edge, whole[twice] + WINDOW, -1)
        repeat = np.bincount(text[np.cumsum(edge[:-1]) > 0], minlength=n)
    return [block.counts(), np.diff(chars), np.diff(symbols), dup_lines, repeat]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("_text")
        _, offsets = W.text_buffer(texts)
        parts = []
        for begin, block in W.blocks(texts, W.SPACES, fold=False):
            own = offsets[begin:begin + len(block) + 1]
            parts.append(text_counts(block, own - own[0]))
        if not parts:
            continue
        columns = [np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_host"), *map(pa.array, columns)],
                                         names=["_id", "_host", *_COUNTS])


def rule_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(_id, _host, counts, _failed) of each row."""
    source = docs.select(docs[id_col].alias("_id"), docs[host_col].cast("string").alias("_host"), docs[text_col].cast("string").alias("_text"))
    kind = source.schema["_id"].dataType.simpleString()
    counted = map_arrow(source, _count_batches, f"_id {kind}, _host string, " + ", ".join(f"{c} long" for c in _COUNTS))
    return counted.withColumn("_failed", (F.col("_words") < MIN_WORDS) | (100 * F.col("_repeat_words") > MAX_REPEAT_PERCENT * F.col("_words")))


def host_verdicts(counted: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(_host, host_docs, host_failed, host_rate, host_ok): the failure rate of
    each host, shrunk by the beta prior that the spread between hosts gives.

    The prior is fitted with one aggregate over hosts: with rate p_i and n_i
    documents, mean m and variance v of p, less the mean sampling variance,
    its strength is m(1-m)/v - 1, at least 1.
    """
    hosts = counted.groupBy("_host").agg(F.count("*").alias("host_docs"), F.sum(F.col("_failed").cast("long")).alias("host_failed"))
    rate = F.col("host_failed") / F.col("host_docs")
    corpus = hosts.agg((F.sum("host_failed") / F.sum("host_docs")).alias("_m"), F.var_pop(rate).alias("_v"),
                       F.avg(1 / F.col("host_docs")).alias("_inv"))
    spread = F.greatest(F.col("_v") - F.col("_m") * (1 - F.col("_m")) * F.col("_inv"), F.lit(1e-9))
    prior = corpus.select("_m", F.greatest(F.lit(1.0), F.least(F.lit(1e6), F.col("_m") * (1 - F.col("_m")) / spread - 1)).alias("_k"))
    m, k = (prior.first() or (0.0, 1.0))[:2]
    m, k = m or 0.0, k or 1.0
    shrunk = (F.col("host_failed") + F.lit(m * k)) / (F.col("host_docs") + F.lit(k))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_ok", F.col("host_rate") <= max_rate)


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                    max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per document: id, counts, base_failed, host_rate, kept."""
    counted = cut(rule_counts(docs, id_col, text_col, host_col))
    verdicts = cut(host_verdicts(counted, max_rate)).withColumnRenamed("_host", "_of")
    return (counted.join(verdicts, F.col("_host").eqNullSafe(F.col("_of")), "left")
            .select(F.col("_id").alias(id_col), F.col("_words").alias("n_words"), F.col("_word_chars").alias("word_chars"),
                    F.col("_symbols").alias("n_symbols"), F.col("_dup_lines").alias("n_dup_lines"),
                    F.col("_repeat_words").alias("n_repeat_words"), F.col("_failed").alias("base_failed"),
                    (~F.col("_failed") & F.col("host_ok")).alias("kept"), "host_rate"))
