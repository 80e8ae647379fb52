"""Measures and scores of the quality model against plain Python, one text at a time."""

import bisect
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from wavesym.llm.quality import _CLASSES, _MARK, MEASURES, AdditiveModel, measure_slice

TEXTS = [
    "", " \n ", "one", "The cat. The cat, the CAT!\nThe cat", "a a a b\n\nb b\tc", "HTTP x_y 12:30 ok?", "é ß\nß é é", "x" * 300,
    "line one\nline one\nline two\n", "(a) [b] {c} \"d\" 'e' | / \\ # % .",
]


def plain_measures(text):
    raw = text.encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    lines = re.findall(rb"[^\n]+", raw)
    low = [w.lower() for w in words]  # A-Z only: bytes
    sizes = [len(w) for w in words]
    n, m = max(len(words), 1), max(len(lines), 1)
    mean = sum(sizes) / n
    histogram = Counter(raw)
    size = max(len(raw), 1)
    out = [
        math.log1p(len(raw)),
        math.log1p(len(words)),
        math.log1p(len(lines)),
        mean,
        math.sqrt(max(sum(s * s for s in sizes) / n - mean**2, 0)),
        max(sizes, default=0),
        len(set(low)) / n,
        max(Counter(low).values(), default=0) / n,
        sum(a == b for a, b in zip(low, low[1:])) / n,
        len(set(lines)) / m,
        max(Counter(lines).values(), default=0) / m,
        len(words) / m,
        sum(w[:1].isupper() and w[min(1, len(w) - 1) :][:1].isupper() for w in words) / n,
        sum(bool(_MARK[w[-1]]) for w in words) / n,
        -sum(c / size * math.log2(c / size) for c in histogram.values()),
    ]
    return out + [sum(histogram[b] for b in chars) / size for chars in _CLASSES.values()]


def slice_of(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def random_texts(seed, n=40):
    rng = random.Random(seed)
    stock = ["The", "cat", "CAT", "sat.", "on", "#tag", "12", "mat,", "é", "(x)", "\n", "\n", "\t"]
    return [" ".join(rng.choice(stock) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_measures_equal_plain_ones():
    texts = TEXTS + random_texts(1)
    got = measure_slice(*slice_of(texts))
    assert got.shape == (len(texts), len(MEASURES))
    for text, row in zip(texts, got):
        assert row.tolist() == pytest.approx(plain_measures(text), abs=1e-9), text


def test_scores_are_sums_of_table_entries():
    texts = TEXTS + random_texts(2, 200)
    x = measure_slice(*slice_of(texts))
    rng = np.random.default_rng(3)
    y = ((x[:, 1] + rng.normal(0, 0.5, len(x))) > np.median(x[:, 1])).astype(float)
    model = AdditiveModel(x, y)
    for row, score in zip(x.tolist(), model.score(x).tolist()):
        f = model.constant
        for edges, table, v in zip(model.edges, model.tables, row):
            f += table[bisect.bisect_right(edges.tolist(), v)]
        for a, b, table in model.pairs:
            f += table[bisect.bisect_right(model.coarse[a].tolist(), row[a])][bisect.bisect_right(model.coarse[b].tolist(), row[b])]
        assert score == pytest.approx(1 / (1 + math.exp(-f)), rel=1e-9)
    assert np.mean((model.score(x) >= 0.5) == (y > 0)) > 0.9
