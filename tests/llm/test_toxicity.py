"""The toxicity models against plain Kneser-Ney counts, and the lookups by shuffle against plain ones."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavesym.llm import toxicity as tx
from wavesym.llm.store import Work

DISCOUNT = 0.75


def plain_grams(word):
    whole = word.lower() + b" "
    out = []
    for j in range(len(whole)):
        head = whole[max(0, j - 7) : j + 1].rjust(8) if j < 8 else whole[j - 4 : j + 1]
        out.append(int.from_bytes(head, "big"))
    return out


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def plain_ratios(texts, groups):
    """gram or context -> log ratio of the model of all labels, from dictionaries of counts."""
    counts = defaultdict(Counter)
    for text, group in zip(texts, groups):
        for word in words_of(text):
            for g in plain_grams(word):
                counts[g][group] += 1
    n4, n3 = Counter(g & 0xFFFFFFFF for g in counts), Counter()
    for g4 in n4:
        n3[g4 & 0xFFFFFF] += 1
    sum3, kinds3, sum4, kinds4 = Counter(), Counter(), Counter(), Counter()
    for g3, n in n3.items():
        sum3[g3 >> 8] += n
        kinds3[g3 >> 8] += 1
    for g4, n in n4.items():
        sum4[g4 >> 8] += n
        kinds4[g4 >> 8] += 1
    p3 = {g: (max(n - DISCOUNT, 0) + DISCOUNT * kinds3[g >> 8] / 256) / sum3[g >> 8] for g, n in n3.items()}
    p4 = {g: (max(n - DISCOUNT, 0) + DISCOUNT * kinds4[g >> 8] * p3[g & 0xFFFFFF]) / sum4[g >> 8] for g, n in n4.items()}
    total, kinds = defaultdict(Counter), defaultdict(Counter)
    for g, own in counts.items():
        for c in ("ord", "tox"):
            total[g >> 8][c] += own[c]
            kinds[g >> 8][c] += own[c] > 0

    def saved(context, c):
        return DISCOUNT * kinds[context][c] / total[context][c] if total[context][c] else 1.0

    def chance(g, c):
        own = max(counts[g][c] - DISCOUNT, 0) / max(total[g >> 8][c], 1)
        return own + saved(g >> 8, c) * p4[g & 0xFFFFFFFF]

    def ratio(g):
        if g in counts and counts[g]["ord"] + counts[g]["tox"]:
            return math.log(chance(g, "tox") / chance(g, "ord"))
        context = g >> 8
        if sum(total[context].values()):
            return math.log(saved(context, "tox") / saved(context, "ord"))
        return 0.0

    return ratio


def plain_features(text, ratio):
    words = words_of(text)
    if not words:
        return [0.0] * 4
    own = [sum(ratio(g) for g in plain_grams(w)) for w in words]
    sizes = [len(w) + 1 for w in words]
    windows = [sum(own[k : k + 8]) / sum(sizes[k : k + 8]) for k in range(max(len(own) - 7, 1))]
    return [sum(own) / sum(sizes), max(windows), max(own), sum(sorted(own, reverse=True)[:5]) / 5]


def corpus(seed, n=60):
    rng = random.Random(seed)
    stock = ["alpha", "Beta", "gammadelta", "vile", "viler", "straße", "extraordinarily", "a", "of"]
    texts = [" ".join(rng.choice(stock) + rng.choice(["", "s", ",", "x9"]) for _ in range(rng.randrange(30))) for _ in range(n)]
    return texts + [None, "", " \n", "word " * 5000, "never seen before zzzz"]


@pytest.mark.parametrize("chunk,ranges", [(1, 3), (12 << 20, 17)], ids=["a_text_each", "together"])
def test_log_ratios_equal_plain_counts(spark, monkeypatch, chunk, ranges):
    monkeypatch.setattr(tx, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(tx, "BLOCK_WORDS", 50)
    texts = corpus(1)
    groups = [k % 5 if k < 60 else 4 for k in range(len(texts))]  # as in COUNTS
    work = Work(spark)
    docs = spark.createDataFrame(list(zip(range(len(texts)), texts, groups)), "doc_id long, text string, group int").repartition(3)
    grams = work.table(tx.count_grams(docs, 5), "grams")
    shards = work.table(tx._shards(tx.log_ratios(grams), ranges), "shards")
    got = tx.measure(docs, shards, ranges, ("all",), work).collect()
    ratio = plain_ratios(texts, [{0: "ord", 1: "ord", 2: "tox", 3: "tox", 4: "other"}[g] for g in groups])
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    for r in got:
        assert r["all"] == pytest.approx(plain_features(texts[r.doc_id], ratio), rel=2e-5, abs=2e-5)


def test_counts_equal_plain_counts_when_a_task_holds_little(spark, monkeypatch):
    from wavesym.llm import packed

    monkeypatch.setattr(packed, "HELD", 16)
    monkeypatch.setattr(packed.Counter.__init__, "__defaults__", (0, 16))
    texts = corpus(2)
    docs = spark.createDataFrame([(x, k % 5) for k, x in enumerate(texts)], "text string, group int")
    got = {r.gram: [r[c] for c in tx.COUNTS] for r in tx.count_grams(docs, 3).collect()}
    want = defaultdict(lambda: [0] * 5)
    for k, text in enumerate(texts):
        for word in words_of(text):
            for g in plain_grams(word):
                want[g][k % 5] += 1
    assert got == dict(want)


def test_the_scoring_table_keeps_every_key(spark):
    n = 40_000
    key = F.when(F.col("id") < n, (F.col("id") + 1) * 1_000_003).otherwise(-(F.col("id") - n) * 77 - 1)
    table = spark.range(2 * n).select(key.alias("key"), *(F.col("id").cast("float").alias(m) for m in tx.MODELS))
    grams = (np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(1_000_003)
    unseen = (np.arange(n, dtype=np.uint64) * np.uint64(77) << np.uint64(8)) | np.uint64(255)
    unseen = unseen[~np.isin(unseen, grams)]
    seen = 0
    for row in tx._shards(table, 7).collect():
        keys, ratios = tx.unpack(bytes(row.packed), row.n, "<f4", 3)
        own = grams[(grams >> np.uint64(8)) % np.uint64(7) == row["range"]]
        assert (tx.look_up(own, keys, ratios)[:, 0] == own // np.uint64(1_000_003) - np.uint64(1)).all()
        more = unseen[(unseen >> np.uint64(8)) % np.uint64(7) == row["range"]]
        assert (tx.look_up(more, keys, ratios)[:, 0] == (more >> np.uint64(8)) // np.uint64(77) + np.uint64(n)).all()
        seen += len(own)
    assert seen == n


def test_shared_model_is_made_once(spark):
    """Contexts need no shared model, and grams that no label teaches none of the joins by class."""
    rows = [(97 + 256 * k, 1, 0, k % 2, 0, 1) for k in range(9)] + [(98 + 256 * k, 0, 0, 0, 0, 5) for k in range(9)]
    grams = spark.createDataFrame(rows, "gram long, " + ", ".join(f"{c} long" for c in tx.COUNTS))
    ratios = tx.log_ratios(grams)
    plan = ratios._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 5
    assert {r.key for r in ratios.collect()} == {g for g, *_ in rows[:9]} | {-(g >> 8) - 1 for g, *_ in rows[:9]}
