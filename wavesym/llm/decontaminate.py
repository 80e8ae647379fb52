"""Benchmark passages in documents, by a random-walk embedding of edit distance and bit sampling.

The walk reads a sequence of words: at each step it writes the word it stands on and moves on or stays, as a
random bit of that word says. Two sequences a few edits apart write outputs that agree in most places. So some
places of the output, sampled, make a key, and windows of documents that share a key with an item are compared
with it exactly. Keys of several walks and samples reach the recall.

Windows are only embedded where a run of three words of an item occurs: an item of n words with at most n // 5
edits keeps such a run, so nothing is lost. Items come in blocks of bounded size, each a pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavesym.llm.text import U64, mix, slices, word_bounds, word_hashes

WALKS, SAMPLES, PLACES = 6, 8, 3
RUN = 3
BLOCK_BYTES = 8 << 20
_END = U64(0xD1B54A32D192ED03)
_RUN_PLACE = mix(np.arange(11, 11 + RUN, dtype=np.uint64)) | U64(1)
FOUND = "doc_id long, item_id long, start long, end long, edits long, n_words long"


def most_edits(n: int) -> int:
    """A similarity of 0.8; short items must be met exactly."""
    return n // 5 if n >= 6 else 0


def window_size(n: int) -> int:
    """The words of an item that are embedded: the next lower of 3, 4, 6, 8, 12, 16, 24, ..."""
    size, step = RUN, 0
    while True:
        power = 4 << (step // 2)
        following = power if step % 2 == 0 else power * 3 // 2
        if following > n:
            return size
        size, step = following, step + 1


def _places(size: int) -> np.ndarray:
    """[walks, samples, places] of the output that make a key."""
    steps = max(PLACES, size * 3 // 2)
    random = np.random.default_rng(size)
    return np.stack([[np.sort(random.choice(steps, PLACES, replace=False)) for _ in range(SAMPLES)] for _ in range(WALKS)])


def walk_keys(words: np.ndarray, starts: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """Keys [walks * samples, windows] of the windows that begin at `starts`; words[last] is the end mark."""
    places = _places(size)
    steps = int(places.max()) + 1
    coefficient = mix(np.arange(101, 101 + PLACES, dtype=np.uint64)) | U64(1)
    out = np.zeros((WALKS * SAMPLES, len(starts)), np.uint64)
    for walk in range(WALKS):
        wanted: dict[int, list[tuple[int, int]]] = {}
        for sample in range(SAMPLES):
            for k, place in enumerate(places[walk, sample].tolist()):
                wanted.setdefault(place, []).append((walk * SAMPLES + sample, k))
        at = starts.copy()
        for step in range(steps):
            if step % 64 == 0:
                bits = mix(words ^ U64(0xA5A5 + 1009 * walk + step))
            here = words[at]
            for row, k in wanted.get(step, ()):
                out[row] += here * coefficient[k]
            at += ((bits[at] >> U64(step % 64)) & U64(1)).astype(np.int64)
            np.minimum(at, last, out=at)
    tag = mix(np.arange(WALKS * SAMPLES, dtype=np.uint64) + U64(1 + size * 1000))
    return mix(out ^ tag[:, None])


def _runs(words: np.ndarray) -> np.ndarray:
    n = len(words) - RUN + 1
    return mix(sum(words[k : n + k] * _RUN_PLACE[k] for k in range(RUN))) if n > 0 else np.zeros(0, np.uint64)


def closest(item: list[int], text: list[int]) -> tuple[int, int]:
    """(edits, end) of the part of `text` closest to `item`, the first such end; by bit vectors."""
    n = len(item)
    mask: dict[int, int] = {}
    for k, word in enumerate(item):
        mask[word] = mask.get(word, 0) | 1 << k
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, edits = full, 0, n
    best, end = n, 0
    for k, word in enumerate(text):
        eq = mask.get(word, 0)
        x = eq | minus
        d = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (~(d | plus) & full)
        down = plus & d
        if up & top:
            edits += 1
        elif down & top:
            edits -= 1
        up = up << 1 & full
        down = down << 1 & full
        plus = down | (~(x | up) & full)
        minus = up & x
        if edits < best:
            best, end = edits, k + 1
    return best, end


def first_word(item: list[int], text: list[int], end: int, edits: int) -> int:
    """The start of the part that ends at `end`: the longest one with so many edits."""
    other = text[max(0, end - len(item) - edits) : end][::-1]
    item = item[::-1]
    row = list(range(len(other) + 1))
    for i, word in enumerate(item):
        new = [i + 1]
        for j, w in enumerate(other):
            new.append(min(row[j] + (w != word), row[j + 1] + 1, new[j] + 1))
        row = new
    return end - max(j for j, d in enumerate(row) if d == min(row))


class Items:
    """A block of items: their runs and keys, ready to be looked up."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        texts = pa.array([t for _, t in rows], pa.string())
        self.ids, self.words = [i for i, _ in rows], []
        for _, _, data, bounds in slices(texts):
            starts, ends, owner = word_bounds(data, bounds)
            hashes = word_hashes(data, starts, ends, fold=True)
            cuts = np.searchsorted(owner, np.arange(len(bounds)))
            self.words += [hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        long = [k for k, w in enumerate(self.words) if len(w) >= RUN]
        self.whole: dict[bytes, list[int]] = {}  # items of fewer words count only as whole texts
        for k, w in enumerate(self.words):
            if 0 < len(w) < RUN:
                self.whole.setdefault(w.tobytes(), []).append(k)
        self.runs = np.unique(np.concatenate([_runs(self.words[k]) for k in long])) if long else np.zeros(0, np.uint64)
        self.near = np.zeros(1 << 20, bool)
        self.near[(self.runs >> U64(44)).astype(np.int64)] = True
        self.sizes = sorted({window_size(len(self.words[k])) for k in long})
        self.reach, self.keys, self.owners = {}, {}, {}
        for size in self.sizes:
            own = [k for k in long if window_size(len(self.words[k])) == size]
            self.reach[size] = max(len(self.words[k]) + most_edits(len(self.words[k])) for k in own)
            ended = [np.append(self.words[k], _END) for k in own]
            starts = np.cumsum([0, *map(len, ended)])
            keys = walk_keys(np.concatenate(ended), starts[:-1].copy(), starts[1:] - 1, size)
            flat, owner = keys.reshape(-1), np.tile(np.array(own), len(keys))
            order = np.argsort(flat, kind="stable")
            self.keys[size], self.owners[size] = flat[order], owner[order]

    def candidates(self, words: np.ndarray, first: np.ndarray, last: np.ndarray) -> set[tuple[int, int, int]]:
        """(row, item, start) of windows that share a key; rows are words[first:last], words[last] is the end mark."""
        runs = _runs(words)
        hit = np.flatnonzero(self.near[(runs >> U64(44)).astype(np.int64)])
        if len(hit) and len(self.runs):
            at = np.minimum(np.searchsorted(self.runs, runs[hit]), len(self.runs) - 1)
            hit = hit[self.runs[at] == runs[hit]]
        if not len(hit):
            return set()
        row = np.searchsorted(first, hit, "right") - 1
        out: set[tuple[int, int, int]] = set()
        for size in self.sizes:
            mark = np.zeros(len(words) + 1, np.int32)
            np.add.at(mark, np.maximum(hit - self.reach[size], first[row]), 1)
            np.add.at(mark, hit + 1, -1)
            starts = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
            owner = np.searchsorted(first, starts, "right") - 1
            for low in range(0, len(starts), 200_000):
                part, own = starts[low : low + 200_000], owner[low : low + 200_000]
                keys = walk_keys(words, part, last[own], size)
                for line in keys:
                    a = np.searchsorted(self.keys[size], line)
                    same = np.flatnonzero(self.keys[size][np.minimum(a, len(self.keys[size]) - 1)] == line)
                    for k in same.tolist():
                        place = int(a[k])
                        while place < len(self.keys[size]) and self.keys[size][place] == line[k]:
                            out.add((int(own[k]), int(self.owners[size][place]), int(part[k])))
                            place += 1
        return out

    def matches(self, data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, start, end, edits): the closest part of a text for each item it holds."""
        n = len(bounds) - 1
        starts, ends, rows = word_bounds(data, bounds)
        hashes = word_hashes(data, starts, ends, fold=True)
        counts = np.bincount(rows, minlength=n)
        last = np.cumsum(counts + 1) - 1
        words = np.full(len(hashes) + n, _END, np.uint64)
        words[np.arange(len(hashes)) + rows] = hashes
        first = last - counts
        spots: dict[tuple[int, int], list[int]] = {}
        for row, item, start in self.candidates(words, first, last):
            spots.setdefault((row, item), []).append(start)
        out = []
        for (row, item), places in sorted(spots.items()):
            own = self.words[item].tolist()
            allowed = most_edits(len(own))
            best = (allowed + 1, 0, 0)
            places.sort()
            k = 0
            while k < len(places):  # windows that overlap are searched together
                low = high = places[k]
                while k < len(places) and places[k] <= high + len(own):
                    high = places[k]
                    k += 1
                begin = max(int(first[row]), low - len(own) // 2)
                part = words[begin : min(int(last[row]), high + len(own) + len(own) // 2 + 1)].tolist()
                edits, end = closest(own, part)
                if edits < best[0]:
                    best = (edits, begin - int(first[row]) + first_word(own, part, end, edits), begin - int(first[row]) + end)
            if best[0] <= allowed:
                out.append((row, item, best[1], best[2], best[0]))
        for row in np.flatnonzero((counts > 0) & (counts < RUN)) if self.whole else ():
            for item in self.whole.get(words[first[row] : last[row]].tobytes(), ()):
                out.append((int(row), item, 0, int(counts[row]), 0))
        return out


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end (words), edits, n_words: each item that a document holds, where it is closest.

    A document holds an item when some run of its words is at most n // 5 word edits away from the item's n
    words (none for fewer than 6); an item of one or two words only counts when it is the whole text. A-Z count
    as a-z. Null and empty texts hold nothing and are held by nothing; null ids are carried along; repeated rows
    each have their own result. Empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = int(total // BLOCK_BYTES) + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = []
    for k in range(blocks):
        rows = [(r.item_id, r.text) for r in items.filter(block == k).collect()]  # about BLOCK_BYTES
        if not rows:
            continue
        shared = spark.sparkContext.broadcast(rows)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = None
            for batch in batches:
                own = own or Items(shared.value)
                names = batch.column("doc_id").to_pylist()
                for low, high, data, bounds in slices(batch.column("text")):
                    hits = own.matches(data, bounds)
                    if hits:
                        columns = zip(*((names[low + r], own.ids[i], a, b, e, len(own.words[i])) for r, i, a, b, e in hits))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "start", "end", "edits", "n_words"]
                        )

        found.append(texts.mapInArrow(scan, FOUND))
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], FOUND)
