"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import pytest

from wavesym.llm import phrases
from wavesym.llm.phrases import Mining, collocations
from wavesym.llm.store import Work

DOCS = "doc_id long, lang string, text string, key string, k string, n string, phrase string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "y", "z") for r in rows], DOCS)


def plain(rows, spec):
    f, totals = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, spec.longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= spec.least}
    out = {}
    for (lang, p), a in candidates.items():
        held = any(
            lg == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * b >= spec.within * a
            for (lg, q), b in candidates.items()
        )
        if not held:
            n = totals[lang]
            cuts = [(1000 * a * n // (f[lang, p[:c]] * f[lang, p[c:]]), c, f[lang, p[:c]], f[lang, p[c:]]) for c in range(1, len(p))]
            score, _, left, right = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right, n))
    rows = []
    for lang, own in out.items():
        for rank, (score, a, p, left, right, n) in enumerate(sorted(own)[: spec.top], 1):
            rows.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(rows)


def texts(seed, n=150):
    rng = random.Random(seed)
    stock = "alpha Beta gamma É delta the of straße x".split()
    runs = ["one two three four five six", "rare pair", "New York City", "a  b\tc d"]
    rows = []
    for k in range(n):
        words = [rng.choice(stock) if rng.random() < 0.7 else rng.choice(runs) for _ in range(rng.randrange(40))]
        rows.append((k, rng.choice(["en", "de", None, ""]), "".join(w + rng.choice([" ", " ", "  ", ". ", "\n", ", ", "\r"]) for w in words)))
    # a text that the sample is unlikely to hold: its phrases are found by further passes
    rows += [(9000, "en", "only here it is said " * 40), (9001, "en", "only here it is said " * 40), (9001, "en", "only here it is said " * 40)]
    return rows + [(None, "en", None), (9100, "fr", ""), (9101, "fr", " .. \n"), (9102, None, "word " * 50_000), (None, "en", "the of the of")]


@pytest.mark.parametrize(
    "spec",
    [Mining(least=6, share=2), Mining(least=6, share=7, low=1.0, top=10), Mining(least=4, share=1000), Mining(least=5, share=3, within=60, longest=4)],
    ids=["half", "seventh", "hardly_any", "shorter"],
)
def test_rows_equal_plain_counting(spark, spec):
    rows = texts(3)
    got = sorted(tuple(r) for r in collocations(table(spark, rows), spec).collect())
    assert got == plain(rows, spec)


def test_a_failed_border_leads_to_more_passes(spark):
    """Nothing is proposed when the sample is empty; every phrase comes from a border."""
    rows = texts(5)
    spec = Mining(least=6, share=10**6)
    passes = []
    original = phrases.count_keys

    def counted(texts, spec, maps, *more):
        passes.append(len(maps))
        return original(texts, spec, maps, *more)

    phrases.count_keys = counted
    try:
        got = phrases.frequent_phrases(table(spark, rows), spec, Work(spark))
        assert passes == [0, 1, 2, 3, 4, 5]
        assert got.groupBy("lang", "phrase").count().filter("count > 1").isEmpty()
    finally:
        phrases.count_keys = original


def test_a_tiny_bitmap_only_counts_more(spark, monkeypatch):
    rows = texts(7)
    spec = Mining(least=6, share=4)
    monkeypatch.setattr(phrases, "LEAST_BITS", 4)
    monkeypatch.setattr(phrases, "MOST_BITS", 4)
    monkeypatch.setattr(phrases, "STRIPE", 4)
    assert phrases.MOST_BITS == 4
    got = sorted(tuple(r) for r in collocations(table(spark, rows), spec).collect())
    assert got == plain(rows, spec)


def test_empty_table_and_wide_numbers(spark):
    assert collocations(table(spark, [])).collect() == []
    rows = [(1, "en", "a b " * 30_000), (2, "en", "c " * 30_000)]
    got = collocations(table(spark, rows)).collect()
    assert [tuple(r) for r in got] == plain(rows, Mining())
