"""Repetition within texts, from suffix arrays over words.

The suffix array of each text is built by prefix doubling, for all texts of a batch at once: only suffixes whose
rank is still shared are sorted again. The common prefix lengths of neighbouring suffixes follow from the ranks of
all rounds. A suffix's longest repeated prefix is its deepest common-prefix interval; the union of these spans, of
those with at least ``min_words`` words, is what maximal repeated substrings cover. A text fails when the covered
share of its words or the longest repeat is over its limit.

Words are runs of anything but ASCII white space. Defined cases: null and empty texts have no words, no repeats and
fail the base rule for being short; texts of any length are read whole; every row is judged on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_batches, text_rows


@dataclass(frozen=True)
class Rule:
    min_doc_words: int = 50
    #: Percent of the words that may be in repeated windows of three words.
    window_percent: int = 50
    #: A repeat counts from so many words on.
    min_words: int = 10
    #: Percent of the words that repeats may cover.
    covered_percent: int = 30
    #: Words of the longest repeat that is accepted.
    longest_words: int = 100


SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, n_covered_words bigint, longest_repeat bigint"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# Words that are put into one suffix array.
BLOCK_WORDS = 500_000


def repeat_lengths(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For every place the words of the longest substring that starts there and occurs elsewhere in its text.

    ``words`` are word numbers from 0, ``text`` the ascending text number of each place.
    """
    n = len(words)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    ends = np.searchsorted(text, text, side="right")  # end of each place's text
    order = np.lexsort((words, text))
    ranks = [_ranks(order, np.stack([text, words]))]
    open_ = _shared(ranks[0])
    span, levels = 1, [1]
    while len(open_):
        rank = ranks[-1]
        nxt = open_ + span
        inside = nxt < ends[open_]
        # A suffix that ends first comes first and differs from all others of its rank.
        second = np.where(inside, rank[np.minimum(nxt, n - 1)] + 1, 0)
        order = np.lexsort((second, rank[open_]))
        new = rank.copy()
        a, b = rank[open_][order], second[order]
        fresh = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        start = np.r_[True, a[1:] != a[:-1]]
        at = np.arange(len(open_))
        head, group = np.maximum.accumulate(np.where(fresh, at, 0)), np.maximum.accumulate(np.where(start, at, 0))
        new[open_[order]] = a + head - group
        ranks.append(new)
        span *= 2
        levels.append(span)
        open_ = open_[_shared(new[open_])]
    suffixes = np.argsort(ranks[-1], kind="stable")
    left, right = suffixes[:-1], suffixes[1:]
    length = np.zeros(n - 1, np.int64)
    for rank, step in zip(ranks[::-1], levels[::-1]):
        i, j = left + length, right + length
        fits = (i + step <= ends[left]) & (j + step <= ends[right]) & (text[left] == text[right])
        k = np.flatnonzero(fits)
        k = k[rank[i[k]] == rank[j[k]]]
        length[k] += step
    out[left] = length
    np.maximum.at(out, right, length)
    return out


def _ranks(order: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Rank of each place: the number of places before its group of equal keys."""
    sorted_ = keys[:, order]
    fresh = np.r_[True, (sorted_[:, 1:] != sorted_[:, :-1]).any(axis=0)]
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    return out


def _shared(ranks: np.ndarray) -> np.ndarray:
    """Places whose rank others have too."""
    if not len(ranks):
        return np.zeros(0, np.int64)
    _, inverse, counts = np.unique(ranks, return_inverse=True, return_counts=True)
    return np.flatnonzero(counts[inverse] > 1)


def covered(lengths: np.ndarray, text: np.ndarray, n_texts: int, least: int) -> np.ndarray:
    """Per text the words in the union of the spans of at least ``least`` words."""
    n = len(lengths)
    change = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(lengths >= least)
    np.add.at(change, at, 1)
    np.add.at(change, at + lengths[at], -1)
    return np.bincount(text, (np.cumsum(change)[:n] > 0).astype(float), n_texts).astype(np.int64)


def measure(texts: list[str], rule: Rule) -> list[list]:
    """Columns of SCHEMA after doc_id for some texts."""
    words, numbers, counts = [], {}, []
    for t in texts:
        own = t.encode().split()
        counts.append(len(own))
        words.extend([numbers.setdefault(w, len(numbers)) for w in own])
    words = np.array(words, np.int64)
    text = np.repeat(np.arange(len(texts)), counts)
    lengths = repeat_lengths(words, text)
    windows = covered(np.where(lengths >= 3, 3, 0), text, len(texts), 3)
    cover = covered(lengths, text, len(texts), rule.min_words)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, text, lengths)
    n = np.array(counts, np.int64)
    failed = (n < rule.min_doc_words) | (100 * windows > rule.window_percent * n)
    kept = ~failed & (100 * cover <= rule.covered_percent * n) & (longest <= rule.longest_words)
    chars = [len(t) - sum(t.count(c) for c in SPACES) for t in texts]
    symbols = [sum(t.count(c) for c in SYMBOLS) for t in texts]
    lines = []
    for t in texts:
        own = [line for line in t.split("\n") if line.strip(SPACES)]
        lines.append(len(own) - len(set(own)))
    return [n, chars, symbols, lines, windows, failed, kept, cover, longest]


def judge_repetition(df: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df`` with its measures, the base verdict and ``kept``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            start, size = 0, 0
            for i, t in enumerate(texts):
                size += len(t) // 4 + 1
                if size >= BLOCK_WORDS or i + 1 == len(texts):
                    columns = measure(texts[start : i + 1], rule)
                    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(start, i + 1 - start), *(pa.array(c, k) for c, k in zip(columns, kinds))], NAMES
                    )
                    start, size = i + 1, 0

    return text_rows(df, id_col, text_col).selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(run, SCHEMA)
