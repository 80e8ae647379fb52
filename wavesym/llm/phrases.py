"""Collocations by Toivonen's method: a sample proposes, full passes count exactly.

One text in `share` is counted whole; phrases that reach a lowered threshold there are the proposal S. A full pass
counts every phrase whose parts of one word less are in S: these are S itself and its negative border, the least
phrases outside of S; words are all counted. If a phrase of the border turns out frequent, the sample has failed
there: it joins S, and another pass counts what the larger S adds to the border. When no pass finds such a phrase,
every frequent phrase has been counted, because all parts of a frequent phrase are frequent.

S decides only what is counted, never a count. Tasks test it in a bitmap of at most 64 MB, whatever its size: a
false hit makes a task count a phrase that need not be, and as every task makes the same decision for a phrase, it
is counted wholly or not at all. These passes count phrases by 64-bit keys, packed by range, which travel at a few
bytes each; where two phrases share a key the count can only be too high. A last pass counts the phrases found by
language and text, and so gives the exact counts and drops what a shared key has brought in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavesym.llm.packed import HELD, PACKED, Counter, merged, range_of
from wavesym.llm.store import Work, filesystem_of
from wavesym.llm.text import U64, mix, slices, word_bounds, word_hashes

STRIPE = 16  # bits of a place within a stripe of the bitmap, which travel as two bytes
LEAST_BITS, MOST_BITS = 20, 29
SALTS, TOP_SALTS = 8, 64
TOGETHER = 300_000  # rows of phrases that a task holds
NAMED = pa.schema([("key", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int64()), ("n", pa.int64())])
FEW_LANGS = 100_000

_SPLIT = np.zeros(256, bool)
_SPLIT[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_GAPS = _SPLIT.copy()
_GAPS[[9, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_PLACES = np.random.default_rng(104729).integers(1, 2**64, 8, dtype=np.uint64) | U64(1)


@dataclass(frozen=True)
class Mining:
    least: int = 100  # occurrences of a candidate
    longest: int = 5  # words, 7 at most
    share: int = 10  # one text in so many is in the sample
    low: float = 0.4  # of the occurrences expected in the sample, what proposes a phrase
    within: int = 100  # per cent of a phrase's occurrences in a longer one that drop it
    top: int = 2000  # phrases a language

    @property
    def proposing(self) -> int:
        return max(1, int(self.low * self.least / self.share))


class Bitmap:
    """The proposed phrases of a pass, two places a key; read whole by a task and dropped at its end."""

    def __init__(self, folder: str, bits: int):
        import pyarrow.parquet as pq

        self.mask = U64((1 << bits) - 1)
        self.data = np.zeros(1 << (bits - 3), np.uint8)
        filesystem, path = filesystem_of(folder)
        table = pq.read_table(path, filesystem=filesystem)
        size = 1 << (STRIPE - 3)
        for stripe, raw in zip(table.column("stripe").to_pylist(), table.column("raw").to_pylist()):
            self.data[stripe * size : (stripe + 1) * size] = np.frombuffer(raw, np.uint8)

    def _bit(self, place: np.ndarray) -> np.ndarray:
        return (self.data[place >> U64(3)] >> (place & U64(7)).astype(np.uint8)) & 1 == 1

    def has(self, keys: np.ndarray) -> np.ndarray:
        return self._bit((keys >> U64(3)) & self.mask) & self._bit((keys >> U64(32)) & self.mask)


def write_bitmap(keys: DataFrame, folder: str, count: int) -> int:
    """Writes the bitmap of `keys` (key long) in stripes; returns its bits."""
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * count).bit_length()))
    mask = (1 << bits) - 1

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def send() -> pa.RecordBatch:
            places = np.sort(np.concatenate(held))
            held.clear()
            stripes = places >> U64(STRIPE)
            cuts = np.flatnonzero(np.concatenate([[True], stripes[1:] != stripes[:-1]]))
            within = (places & U64((1 << STRIPE) - 1)).astype("<u2")
            raw = [own.tobytes() for own in np.split(within, cuts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(stripes[cuts].astype(np.int64)), pa.array(raw, pa.binary())], ["stripe", "raw"])

        for batch in batches:
            own = batch.column("key").to_numpy().view(np.uint64)
            held += [(own >> U64(k)) & U64(mask) for k in (3, 32)]
            if sum(map(len, held)) >= HELD:
                yield send()
        if sum(map(len, held)):
            yield send()

    def fill(table: pa.Table) -> pa.Table:
        own = np.zeros(1 << STRIPE, np.uint8)
        for raw in table.column("raw"):
            own[np.frombuffer(raw.as_buffer(), "<u2")] = 1
        raw = np.packbits(own, bitorder="little").tobytes()
        return pa.table({"stripe": table.column("stripe").slice(0, 1), "raw": pa.array([raw], pa.binary())})

    kind = "stripe long, raw binary"
    keys.select("key").mapInArrow(split, kind).groupBy("stripe").applyInArrow(fill, kind).write.parquet(folder)
    return bits


def _salts(langs: list[str]) -> np.ndarray:
    known = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


class Words:
    """The words of a slice, and the keys of the phrases that begin at them."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, salts: np.ndarray):
        self.data = data
        self.starts, self.ends, self.rows = word_bounds(data, bounds, _GAPS)
        splits = np.cumsum(_SPLIT[data], dtype=np.int32)
        n = len(self.starts)
        self.follows = np.zeros(n, bool)  # is the next word in the same piece?
        if n:
            same = splits[self.starts[1:]] == splits[self.ends[:-1] - 1]
            self.follows[:-1] = (self.rows[1:] == self.rows[:-1]) & same
        self.hashes = mix(word_hashes(data, self.starts, self.ends, fold=True) ^ salts[self.rows])

    def keys(self, at: np.ndarray, k: int) -> np.ndarray:
        total = self.hashes[at] * _PLACES[0]
        for j in range(1, k):
            total += self.hashes[at + j] * _PLACES[j]
        return (mix(total) & ~U64(7)) | U64(k)  # the last bits say how many words

    def phrases(self, longest: int, maps: list[Bitmap]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """k, places and keys of the phrases to count, all whose parts are in the last map but not in an earlier one.

        Without maps all phrases; with one map also all words.
        """
        every = np.arange(len(self.starts))
        key = self.keys(every, 1)
        if len(maps) < 2:
            yield 1, every, key
        inside = [m.has(key) for m in maps]  # is the phrase of k words from here in the map, with all its parts?
        open_ = np.ones(len(every), bool)
        for k in range(2, longest + 1):
            open_ = open_ & _moved(self.follows, k - 2)
            wanted = [x & _moved(x, 1) & open_ for x in inside] or [open_]
            now = wanted[-1]
            for old in wanted[:-1]:
                now = now & ~old
            anywhere = np.flatnonzero(np.logical_or.reduce(wanted))
            if not len(anywhere):
                return
            key = self.keys(anywhere, k)
            some = now[anywhere]
            yield k, anywhere[some], key[some]
            if k < longest:
                inside = []
                for x, m in zip(wanted, maps):
                    own = x[anywhere]
                    place = anywhere[own]
                    hit = np.zeros(len(every), bool)
                    hit[place[m.has(key[own])]] = True
                    inside.append(hit)


def _moved(x: np.ndarray, by: int) -> np.ndarray:
    """x[i + by], False beyond the end."""
    out = np.zeros(len(x), bool)
    if by < len(x):
        out[: len(x) - by] = x[by:]
    return out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, a place of each, and their counts."""
    codes, different = pd.factorize(keys)
    place = np.empty(len(different), np.int64)
    place[codes] = np.arange(len(codes))
    return different, place, np.bincount(codes, minlength=len(different))


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """data[start:end] of each pair."""
    size = ends - starts
    stop = np.cumsum(size)
    take = np.arange(int(size.sum())) + np.repeat(starts - (stop - size), size)
    offsets = np.concatenate([[0], stop]).astype(np.int32)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data[take].tobytes()))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")


def _ranges(docs: DataFrame) -> int:
    return 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def count_keys(texts: DataFrame, spec: Mining, maps: list[tuple[str, int]], longest: int, least: int) -> DataFrame:
    """key, n of the phrases that `Words.phrases` gives for the maps, where n reaches `least`."""
    ranges = _ranges(texts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps, counter = [Bitmap(*m) for m in maps], Counter(ranges, 1)
        for batch in batches:
            salts = _salts(batch.column("lang").to_pylist())
            for first, last, data, bounds in slices(batch.column("text")):
                for _, _, keys in Words(data, bounds, salts[first:last]).phrases(longest, bitmaps):
                    different, _, counts = _distinct(keys)
                    yield from counter.add(different, counts)
        yield from counter.flush()

    return merged(texts.mapInArrow(count, PACKED), ["n"], least)


def _summed(parts: list[pa.Table]) -> pa.Table:
    """One row per language and phrase; equal keys of different phrases stay apart."""
    table = pa.concat_tables(parts).combine_chunks()
    summed = table.group_by(["key", "lang", "phrase"], use_threads=False).aggregate([("k", "min"), ("n", "sum")])
    return summed.rename_columns({"k_min": "k", "n_sum": "n"}).select(NAMED.names)


def count_phrases(texts: DataFrame, spec: Mining, known: tuple[str, int]) -> DataFrame:
    """lang, phrase, k, n: exact counts of the phrases of a map, and of all words together (k = 0, phrase empty).

    A task adds up the phrases it meets and sends them in packed tables, by range of keys.
    """
    ranges = _ranges(texts)

    def found(words: Words, bitmap: Bitmap, names: pa.Array, salts: np.ndarray) -> Iterator[pa.Table]:
        per_row = np.bincount(words.rows, minlength=len(names))
        some = np.flatnonzero(per_row)
        empty = pa.array([""] * len(some), pa.string())
        zero = np.zeros(len(some), np.int64)
        yield pa.table([pa.array(salts[some].view(np.int64)), names.take(pa.array(some)), empty, zero, per_row[some]], NAMED)
        size = words.ends - words.starts
        begin = np.cumsum(size + 1) - (size + 1)
        spaced = np.full(int(size.sum()) + len(size), 32, np.uint8)  # the words, a space after each
        take = np.arange(int(size.sum())) + np.repeat(words.starts - (np.cumsum(size) - size), size)
        spaced[take + np.repeat(begin - words.starts, size)] = _FOLD[words.data[take]]
        for k, at, keys in words.phrases(spec.longest, [bitmap]):
            hit = bitmap.has(keys)
            different, place, counts = _distinct(keys[hit])
            at = at[hit][place]
            if len(at):
                phrases = _strings(spaced, begin[at], begin[at + k - 1] + size[at + k - 1])
                own = names.take(pa.array(words.rows[at]))
                yield pa.table([pa.array(different.view(np.int64)), own, phrases, np.full(len(at), k), counts], NAMED)

    def send(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        table = _summed(parts)
        of = range_of(table.column("key").to_numpy().view(np.uint64), ranges, 0)
        order = np.argsort(of, kind="stable")
        table, cuts = table.take(pa.array(order)), np.searchsorted(of[order], np.arange(ranges + 1))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            sink = pa.BufferOutputStream()
            own = table.slice(cuts[k], cuts[k + 1] - cuts[k]).combine_chunks()
            with pa.ipc.new_stream(sink, NAMED, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(own)
            row = {"range": [k], "n": [len(own)], "packed": pa.array([sink.getvalue().to_pybytes()], pa.binary())}
            yield pa.RecordBatch.from_pydict(row)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, parts, size = Bitmap(*known), [], 0
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            salts, names = _salts(langs), pa.array(langs, pa.string())
            for first, last, data, bounds in slices(batch.column("text")):
                words = Words(data, bounds, salts[first:last])
                if not len(words.starts):
                    continue
                parts += found(words, bitmap, names[first:last], salts[first:last])
                size += sum(map(len, parts[-spec.longest :]))
                if size > TOGETHER:
                    parts = [_summed(parts)]
                    size = len(parts[0])
                    if size > TOGETHER // 2:
                        yield from send(parts)
                        parts, size = [], 0
        if parts:
            yield from send(parts)

    def merge(table: pa.Table) -> pa.Table:
        parts = [pa.ipc.open_stream(raw.as_buffer()).read_all() for raw in table.column("packed")]
        whole = _summed(parts)
        kept = pc.or_(pc.equal(whole.column("k"), 0), pc.greater_equal(whole.column("n"), spec.least))
        return whole.filter(kept).select(["lang", "phrase", "k", "n"])

    packed = texts.mapInArrow(count, PACKED)
    return packed.groupBy("range").applyInArrow(merge, "lang string, phrase string, k long, n long")


def frequent_keys(docs: DataFrame, spec: Mining, work: Work) -> DataFrame:
    """key of every phrase that occurs `least` times, words included."""
    sampled = docs.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(17)), F.lit(spec.share)) == 0)
    proposed = count_keys(_texts(sampled), spec, [], spec.longest - 1, spec.proposing).select("key")
    proposed = work.table(proposed, "proposed")
    texts, maps, tables = _texts(docs), [], []
    while True:
        folder = work.folder("bitmap")
        maps.append((folder, write_bitmap(proposed, folder, proposed.count())))
        found = work.table(count_keys(texts, spec, maps, spec.longest, spec.least).select("key"), "frequent")
        tables.append(found)
        parts = found.filter(F.col("key").bitwiseAND(7) < spec.longest)  # the longest are part of nothing
        failed = work.table(parts.join(proposed, "key", "left_anti"), "failed")
        if failed.isEmpty():
            break
        proposed = work.table(proposed.union(failed), "proposed")
    out = tables[0]
    for table in tables[1:]:
        out = out.union(table)
    return out


def frequent_phrases(docs: DataFrame, spec: Mining, work: Work) -> DataFrame:
    """lang, phrase, k, n of all words and phrases that occur `least` times, and of all words (k = 0)."""
    keys = frequent_keys(docs, spec, work)
    folder = work.folder("bitmap")
    known = folder, write_bitmap(keys, folder, keys.count())
    return work.table(count_phrases(_texts(docs), spec, known), "phrases")


def collocations(docs: DataFrame, spec: Mining = Mining(), work: Work | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` candidates of each language.

    Reads doc_id, lang and text of `docs`, no other column. A null lang is `und`, a null text is empty; texts
    without a word and empty tables give no rows. Repeated rows count as often as they are there. Of cuts with
    equal scores the one after the fewest words counts; equal scores rank by occurrences, then by the phrase.
    """
    work = work or Work(docs.sparkSession)
    frequent = frequent_phrases(docs, spec, work)
    totals = frequent.filter("k = 0").select("lang", F.col("n").alias("n"))
    totals = F.broadcast(totals) if totals.count() <= FEW_LANGS else totals
    phrases = frequent.filter("k > 0").select("lang", "phrase", "k", F.col("n").alias("a"))
    candidates = phrases.filter("k > 1")

    words = F.split("phrase", " ", -1)
    shorter = candidates.filter("k > 2").select(
        "lang",
        F.explode(F.array(F.array_join(F.slice(words, F.lit(1), F.col("k").cast("int") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("k").cast("int") - 1), " "))).alias("phrase"),
        "a",
    )
    longer = shorter.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < spec.within * F.col("a"))
    )
    cut = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k").cast("int") - 1)))
    cut = cut.select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("cut") + 1, F.col("k").cast("int") - F.col("cut")), " ").alias("right"),
        F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    # a frequent word begins many phrases
    salted = phrases.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = salted.select("lang", F.col("phrase").alias("left"), "salt", F.col("a").alias("l"))
    right = salted.select("lang", F.col("phrase").alias("right"), "salt", F.col("a").alias("r"))
    cut = cut.join(left, ["lang", "left", "salt"]).join(right, ["lang", "right", "salt"]).join(totals, "lang")
    wide = "decimal(19,0)"
    above = F.col("a").cast(wide) * F.col("n").cast(wide) * F.lit(1000).cast("decimal(4,0)")
    cut = cut.withColumn("above", above).withColumn("below", F.col("l").cast(wide) * F.col("r").cast(wide))
    score = F.expr("cast(above div below as long)")
    best = cut.groupBy("lang", "phrase").agg(
        F.min(F.struct(score.alias("score"), F.col("cut"), F.col("l"), F.col("r"), F.col("a"), F.col("n"))).alias("best")
    )
    scored = best.select("lang", "phrase", "best.a", "best.l", "best.r", "best.n", "best.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS))).orderBy(*order)
    few = scored.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= spec.top).drop("rank")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= spec.top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
