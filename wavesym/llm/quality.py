"""Quality by a generalised additive model with pairwise interactions.

Measures of the text fall into bins. Shallow trees, boosted in turn on one measure after another, add up to a
lookup table per measure; then the pairs that explain most of what is left get two-way tables the same way. A
score is the sum of the entries a text falls on.

The tables are fitted on a bounded sample of labelled rows (SAMPLE, the least hashes of doc_id); the measures
and the scores cover every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavesym.llm.store import Work
from wavesym.llm.text import slices, word_bounds, word_hashes

SAMPLE = 30_000
BINS, PAIR_BINS, PAIRS = 64, 12, 8
ROUNDS, PAIR_ROUNDS, RATE = 120, 40, 0.1
SMALLEST_LEAF = 5.0  # rows

#: Byte classes whose share of a text is a measure.
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "stop": b".",
    "comma": b",;:",
    "shout": b"!?",
    "bar": b"|",
    "symbol": b"#$%&*@^~+=<>\\/_",
    "bracket": b"()[]{}\"'",
    "line": b"\n",
    "white": b" \t\r\x0b\x0c",
    "wide": bytes(range(128, 256)),
}
MEASURES = (
    "bytes", "words", "lines", "word_size", "word_spread", "longest_word", "distinct_words", "top_word", "repeated_next",
    "distinct_lines", "top_line", "line_size", "capital_words", "marked_words", "entropy", *_CLASSES,
)

_LINE = np.zeros(256, bool)
_LINE[10] = True
_CLASS_OF = np.zeros((256, len(_CLASSES)), np.float64)
for _k, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes), _k] = 1
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:!?'\"()-"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def _per_row(rows: np.ndarray, n: int, values: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, values, n).astype(np.float64)


def _most(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: the number of distinct values and the count of the most frequent one."""
    if not len(rows):
        return np.zeros(n), np.zeros(n)
    codes, keys = pd.factorize(hashes)
    pair, own = np.unique(rows * len(keys) + codes, return_counts=True)
    pair_rows = pair // len(keys)
    top = np.zeros(n)
    np.maximum.at(top, pair_rows, own)
    return _per_row(pair_rows, n), top


def measure_slice(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """[rows, MEASURES]; an empty text has zeros."""
    n = len(bounds) - 1
    size = np.diff(bounds).astype(np.float64)
    some, row_of = np.maximum(size, 1), np.repeat(np.arange(n), np.diff(bounds))
    histogram = np.bincount(row_of * 256 + data, minlength=n * 256).reshape(n, 256)
    shares = histogram @ _CLASS_OF / some[:, None]
    p = histogram / some[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    starts, ends, rows = word_bounds(data, bounds)
    hashes = word_hashes(data, starts, ends, fold=True)
    words = _per_row(rows, n)
    w = np.maximum(words, 1)
    lengths = (ends - starts).astype(np.float64)
    mean = _per_row(rows, n, lengths) / w
    spread = np.sqrt(np.maximum(_per_row(rows, n, lengths**2) / w - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, rows, lengths)
    distinct, top = _most(rows, hashes, n)
    again = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    line_starts, line_ends, line_rows = word_bounds(data, bounds, _LINE)
    lines = _per_row(line_rows, n)
    distinct_lines, top_line = _most(line_rows, word_hashes(data, line_starts, line_ends), n)
    some_lines = np.maximum(lines, 1)
    capital = _UPPER[data[starts]] & _UPPER[data[np.minimum(starts + 1, ends - 1)]] if len(starts) else np.zeros(0, bool)
    marked = _MARK[data[ends - 1]] if len(starts) else np.zeros(0, bool)
    out = [
        np.log1p(size), np.log1p(words), np.log1p(lines), mean, spread, longest, distinct / w, top / w,
        _per_row(rows[1:], n, again.astype(np.float64)) / w, distinct_lines / some_lines, top_line / some_lines,
        words / some_lines, _per_row(rows, n, capital.astype(np.float64)) / w, _per_row(rows, n, marked.astype(np.float64)) / w, entropy,
    ]
    return np.column_stack([*out, shares])


def measures(texts: DataFrame) -> DataFrame:
    """doc_id, x: the measures of each text, in the order of MEASURES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in slices(batch.column("text")):
                x = measure_slice(data, bounds).astype(np.float32)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[first:last], flat], ["doc_id", "x"])

    return texts.mapInArrow(run, "doc_id long, x array<float>")


def _split(gain_g: np.ndarray, gain_h: np.ndarray, leaves: int) -> np.ndarray:
    """Steps per bin of a tree of at most `leaves` leaves over ordered bins."""
    parts = [(0, len(gain_g))]
    g, h = np.concatenate([[0.0], np.cumsum(gain_g)]), np.concatenate([[0.0], np.cumsum(gain_h)])

    def worth(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)

    while len(parts) < leaves:
        best = (1e-9, None)
        for a, b in parts:
            cut = np.arange(a + 1, b)
            ok = (h[cut] - h[a] >= SMALLEST_LEAF / 4) & (h[b] - h[cut] >= SMALLEST_LEAF / 4)
            cut = cut[ok]
            if len(cut):
                gains = worth(a, cut) + worth(cut, b) - worth(a, b)
                k = int(gains.argmax())
                if gains[k] > best[0]:
                    best = (gains[k], (a, int(cut[k]), b))
        if best[1] is None:
            break
        a, c, b = best[1]
        parts.remove((a, b))
        parts += [(a, c), (c, b)]
    out = np.zeros(len(gain_g))
    for a, b in parts:
        out[a:b] = -(g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _split_pair(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree over two measures: one cut of either, then a cut of the other on each side."""
    best, out = -1.0, np.zeros_like(g)
    for turn in (False, True):
        gg, hh = (g.T, h.T) if turn else (g, h)
        for cut in range(1, len(gg)):
            steps = np.zeros_like(gg)
            total = 0.0
            for side in (slice(0, cut), slice(cut, None)):
                a, b = gg[side].sum(axis=0), hh[side].sum(axis=0)
                step = _split(a, b, 2)
                steps[side] = step
                total += -(a * step).sum()
            if total > best:
                best, out = total, steps.T if turn else steps
    return out


class AdditiveModel:
    """Edges and tables per measure, and tables of pairs of measures."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(c, quantiles)) for c in x.T]
        self.coarse = [np.unique(np.quantile(c, np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) for c in x.T]
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.constant = float(np.log(share / (1 - share)))
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        bins = [np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)]
        f = np.full(len(y), self.constant)
        for _ in range(ROUNDS):
            for k, own in enumerate(bins):
                p = 1 / (1 + np.exp(-f))
                m = len(self.tables[k])
                step = RATE * _split(np.bincount(own, p - y, m), np.bincount(own, p * (1 - p), m), 3)
                self.tables[k] += step
                f += step[own]
        self._fit_pairs(x, y, f)

    def _fit_pairs(self, x: np.ndarray, y: np.ndarray, f: np.ndarray) -> None:
        bins = [np.searchsorted(e, c, "right") for e, c in zip(self.coarse, x.T)]
        sizes = [len(e) + 1 for e in self.coarse]

        def cells(a: int, b: int):
            p = 1 / (1 + np.exp(-f))
            at, n = bins[a] * sizes[b] + bins[b], sizes[a] * sizes[b]
            return at, np.bincount(at, p - y, n).reshape(sizes[a], -1), np.bincount(at, p * (1 - p), n).reshape(sizes[a], -1)

        worth = []
        for a, b in combinations(range(len(bins)), 2):
            _, g, h = cells(a, b)
            worth.append(((g**2 / (h + 5.0)).sum() / g.size, a, b))
        for _, a, b in sorted(worth, reverse=True)[:PAIRS]:
            self.pairs.append((a, b, np.zeros((sizes[a], sizes[b]))))
        for _ in range(PAIR_ROUNDS):
            for a, b, table in self.pairs:
                at, g, h = cells(a, b)
                step = RATE * _split_pair(g, h)
                table += step
                f += step.reshape(-1)[at]

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.constant)
        for edges, table, c in zip(self.edges, self.tables, x.T):
            f += table[np.searchsorted(edges, c, "right")]
        for a, b, table in self.pairs:
            f += table[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def quality(docs: DataFrame, labels: DataFrame, work: Work | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Labels (doc_id, quality) count only where crc32(doc_id) mod 3 is not 1; null ids and null labels teach
    nothing, of several labels of one id the least counts. A null text is empty. Without labels of both classes
    every score is the share of label 1, or 0 without labels. Other columns are not read.
    """
    work = work or Work(docs.sparkSession)
    measured = work.table(measures(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "measures")
    remainder = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3))
    taught = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    taught = taught.filter((remainder != 1) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    taught = taught.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = measured.join(taught, "doc_id").withColumn("order", F.xxhash64("doc_id")).orderBy("order").limit(SAMPLE)
    rows = sample.select("x", "quality").toArrow()  # bounded
    y = (rows.column("quality").to_numpy() > 0).astype(np.float64)
    if not len(y) or y.min() == y.max():
        constant = float(y.mean()) if len(y) else 0.0
        scored = measured.select("doc_id", F.lit(constant).alias("score"))
    else:
        model = AdditiveModel(np.array(rows.column("x").to_pylist(), np.float64), y)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1).astype(np.float64)
                score = model.score(x) if len(batch) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

        scored = measured.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (remainder == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
