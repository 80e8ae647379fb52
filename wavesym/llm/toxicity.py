"""Toxicity by two Kneser-Ney models of the bytes of words, one per class.

A byte is foretold by all bytes of its word before it, up to seven; further on in a long word by the last
four. A class model takes its counts of such grams from the labelled documents of the class, discounts them,
and gives what it saved to a distribution that both classes share: continuation counts over all documents,
labelled or not, interpolated down to single bytes. A document
is scored by the difference of the two log-likelihoods per byte, over the whole text and over its worst window,
and by that of its worst words; a logistic curve, fitted on a bounded sample, makes it a probability.

Each labelled document falls in one of two folds, and the sample is scored by a model of the other fold, so
that no document is scored by counts it took part in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavesym.llm.packed import PACKED, Counter, add_up, merged, pack, unpack
from wavesym.llm.store import Work, make_folder, new_file, open_read, open_write
from wavesym.llm.text import U64, slices, word_bounds, word_hashes

HEAD, ORDER = 8, 5
DISCOUNT = 0.75
SHARD = 400_000  # keys of the scoring table that a task looks up in at once, about
CHUNK_BYTES = 12 << 20  # of texts whose grams are looked up together
BLOCK_WORDS = 400_000  # of a chunk that are scored at once, one text at least
FEW_LABELS = 1_000_000  # rows of 12 bytes that may be broadcast
SAMPLE = 20_000  # labelled rows that the logistic curve is fitted on
WINDOW = 8  # words
COUNTS = ("ord0", "ord1", "tox0", "tox1", "other")
MODELS = {"all": ("0", "1"), "without0": ("1",), "without1": ("0",)}

_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += U64(32)


def word_grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The grams of words as numbers, and the word each is of; a word ends in a space.

    A gram has HEAD bytes, spaces before the word, where it reaches the start of the word, and ORDER elsewhere.
    """
    sizes = ends - starts + 1
    word = np.repeat(np.arange(len(starts)), sizes)
    nth = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = nth + starts[word]
    grams = np.zeros(len(word), np.uint64)
    low, high = starts[word], ends[word]
    for back in range(HEAD - 1, -1, -1):
        place = at - back
        inside = (place >= low) & (place < high)
        byte = np.where(inside, _FOLD[data[np.where(inside, place, 0)]], U64(32))
        grams = (grams << U64(8)) | byte
    return np.where(nth < HEAD, grams, grams & U64((1 << 8 * ORDER) - 1)), word


def _distinct(hashes: np.ndarray):
    codes, keys = pd.factorize(hashes)
    some = np.empty(len(keys), np.int64)
    some[codes] = np.arange(len(codes))
    return codes, some


def count_grams(texts: DataFrame, ranges: int) -> DataFrame:
    """gram and its counts by `group` (index into COUNTS); tasks send their counts packed, by range of grams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranges, len(COUNTS), shift=24)  # neighbours stay together
        for batch in batches:
            groups = batch.column("group").to_numpy(zero_copy_only=False)
            for first, last, data, bounds in slices(batch.column("text")):
                starts, ends, rows = word_bounds(data, bounds)
                if not len(starts):
                    continue
                codes, some = _distinct(word_hashes(data, starts, ends, fold=True))
                group = groups[first:last][rows]
                table = np.bincount(codes * len(COUNTS) + group, minlength=len(some) * len(COUNTS)).reshape(-1, len(COUNTS)).astype(np.int32)
                grams, word = word_grams(data, starts[some], ends[some])
                yield from counter.add(*add_up(grams, table[word]))
        yield from counter.flush()

    return merged(texts.select("text", "group").mapInArrow(count, PACKED), list(COUNTS)).withColumnRenamed("key", "gram")


def shared_model(grams: DataFrame, wanted: DataFrame) -> DataFrame:
    """`wanted` (some of `grams`) with `shared`: the continuation probability of the last byte of a gram after the three
    before it, over all documents."""
    four = grams.groupBy(F.col("gram").bitwiseAND(0xFFFFFFFF).alias("g4")).agg(F.count("*").alias("n"))
    three = four.groupBy(F.col("g4").bitwiseAND(0xFFFFFF).alias("g3")).agg(F.count("*").alias("n3"))
    after2 = three.groupBy(F.shiftright("g3", 8).alias("h2")).agg(F.sum("n3").alias("sum3"), F.count("*").alias("kinds3"))
    lower = three.withColumn("h2", F.shiftright("g3", 8)).join(after2, "h2")
    p3 = (F.greatest(F.col("n3") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("kinds3") / 256) / F.col("sum3")
    lower = lower.select("g3", p3.alias("p3"))
    after3 = four.groupBy(F.shiftright("g4", 8).alias("h3")).agg(F.sum("n").alias("sum4"), F.count("*").alias("kinds4"))
    upper = four.withColumn("h3", F.shiftright("g4", 8)).withColumn("g3", F.col("g4").bitwiseAND(0xFFFFFF)).join(after3, "h3").join(lower, "g3")
    p4 = (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("kinds4") * F.col("p3")) / F.col("sum4")
    upper = upper.select("g4", p4.alias("shared"))
    return wanted.withColumn("g4", F.col("gram").bitwiseAND(0xFFFFFFFF)).join(upper, "g4").drop("g4")


def log_ratios(grams: DataFrame) -> DataFrame:
    """key and a log ratio per model: of grams that a class has seen, and of contexts for unseen grams.

    What a class saved by discounts it spreads by `shared`, the same for both; so for a gram that neither class
    has seen the ratio is that of the saved shares, which depends on the context alone. Keys of contexts are
    negative.
    """
    columns = {(kind, m): sum(F.col(f"{kind}{f}") for f in folds) for m, folds in MODELS.items() for kind in ("ord", "tox")}
    weight = F.col("ord_all") + F.col("tox_all")
    context = F.shiftrightunsigned("gram", 8).alias("context")
    # grams that no label teaches count in the shared model alone
    seen = grams.select("gram", context, *(c.alias(f"{k}_{m}") for (k, m), c in columns.items())).filter(weight > 0)
    totals = [
        x
        for k, m in columns
        for x in (F.sum(f"{k}_{m}").alias(f"sum_{k}_{m}"), F.count(F.when(F.col(f"{k}_{m}") > 0, 1)).alias(f"kinds_{k}_{m}"))
    ]
    contexts = seen.groupBy("context").agg(*totals)

    def saved(k: str, m: str) -> Column:
        return F.when(F.col(f"sum_{k}_{m}") > 0, DISCOUNT * F.col(f"kinds_{k}_{m}") / F.col(f"sum_{k}_{m}")).otherwise(1.0)

    def chance(k: str, m: str) -> Column:
        own = F.greatest(F.col(f"{k}_{m}") - DISCOUNT, F.lit(0.0)) / F.greatest(F.col(f"sum_{k}_{m}"), F.lit(1))
        return own + saved(k, m) * F.col("shared")

    own = shared_model(grams, seen).join(contexts, "context")
    own = own.select(
        F.col("gram").alias("key"), *(F.log(chance("tox", m) / chance("ord", m)).cast("float").alias(m) for m in MODELS)
    )
    unseen = contexts.select(
        (-F.col("context") - 1).alias("key"), *(F.log(saved("tox", m) / saved("ord", m)).cast("float").alias(m) for m in MODELS)
    )
    return own.union(unseen)


FEATURES, WORST = 4, 5
WANTED = "path string, range long, n long, packed binary"


def _shards(ratios: DataFrame, ranges: int) -> DataFrame:
    """The scoring table in packed rows, one per range of contexts; a gram lies with its context."""
    context = F.when(F.col("key") >= 0, F.shiftrightunsigned("key", 8)).otherwise(-(F.col("key") + 1))

    def shard(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_numpy().view(np.uint64)
        values = np.stack([table.column(m).to_numpy() for m in MODELS], axis=1)
        order = np.argsort(keys)
        packed = pack(keys[order], values[order].astype("<f4"))
        return pa.table({"range": [table.column("range")[0].as_py()], "n": [len(keys)], "packed": pa.array([packed], pa.binary())})

    ranged = ratios.withColumn("range", F.pmod(context, F.lit(ranges).cast("long")))
    return ranged.groupBy("range").applyInArrow(shard, "range long, n long, packed binary")


def look_up(grams: np.ndarray, keys: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """The ratios of grams by their own keys, else by those of their contexts, else 0; `keys` ascend."""
    out = np.zeros((len(grams), ratios.shape[1]), np.float32)
    if not len(keys):
        return out

    def find(x: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
        return np.where(keys[at] == x, at, -1)

    at = find(grams)
    unseen = np.flatnonzero(at < 0)
    contexts, place = np.unique(grams[unseen] >> U64(8), return_inverse=True)
    at[unseen] = find((-contexts.view(np.int64) - 1).view(np.uint64))[place]
    hit = at >= 0
    out[hit] = ratios[at[hit]]
    return out


def _ordered_grams(sizes: np.ndarray, words: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of words side by side: the distinct grams by range and gram, the start of each range that has one, the place
    of each word's grams among them, and the first gram of each word."""
    ends = np.cumsum(sizes)
    grams, word = word_grams(words, ends - sizes, ends)
    distinct, place = np.unique(grams, return_inverse=True)
    of = ((distinct >> U64(8)) % U64(ranges)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    cuts = np.searchsorted(of[order], np.arange(ranges + 1))
    return distinct[order], cuts, back[place], np.flatnonzero(np.diff(word, prepend=-1))


class Chunk:
    """Texts that are scored together: of each its words, as numbers of the distinct words of the chunk."""

    def __init__(self):
        self.names: list[pa.Array] = []
        self.per_text: list[np.ndarray] = []
        self.codes: list[np.ndarray] = []
        self.hashes: list[np.ndarray] = []
        self.words: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, names: pa.Array, data: np.ndarray, bounds: np.ndarray) -> None:
        starts, ends, rows = word_bounds(data, bounds)
        hashes = word_hashes(data, starts, ends, fold=True)
        codes, some = _distinct(hashes)
        sizes = (ends - starts)[some]
        take = np.arange(int(sizes.sum())) + np.repeat(starts[some] - (np.cumsum(sizes) - sizes), sizes)
        self.names.append(names)
        self.per_text.append(np.bincount(rows, minlength=len(names)))
        self.codes.append(codes.astype(np.int32))
        self.hashes.append(hashes[some])
        self.words.append((sizes, data[take]))
        self.size += len(data)

    def write(self, folder: str) -> tuple[str, np.ndarray, np.ndarray]:
        """Path, sizes and bytes of the distinct words."""
        offset = np.cumsum([0, *map(len, self.hashes)])
        code, some = _distinct(np.concatenate(self.hashes))
        sizes = np.concatenate([s for s, _ in self.words])
        data = np.concatenate([d for _, d in self.words])
        begin = (np.cumsum(sizes) - sizes)[some]
        sizes = sizes[some]
        words = data[np.arange(int(sizes.sum())) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)]
        codes = np.concatenate([code[o + c] for o, c in zip(offset, self.codes)]).astype("<i4")
        path = new_file(folder, "texts", ".chunk")
        names = pa.concat_arrays(self.names)
        columns = {
            "names": pa.array([names.to_pylist()], pa.list_(pa.int64())),
            "per_text": [np.concatenate(self.per_text).astype("<i8").tobytes()],
            "codes": [np.ascontiguousarray(codes.view(np.uint8).reshape(-1, 4).T).tobytes()],
            "sizes": [sizes.astype("<i8").tobytes()],
            "words": [words.tobytes()],
        }
        packer = zstandard.ZstdCompressor(level=3)
        with open_write(path) as out, packer.stream_writer(out, closefd=False) as packed:
            table = pa.table(columns)
            with pa.ipc.new_stream(packed, table.schema) as writer:
                writer.write_table(table)
        return path, sizes, words


def _read_chunk(path: str) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    with open_read(path) as file:
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(file.read())
    row = pa.ipc.open_stream(raw).read_all()
    numbers = {c: np.frombuffer(row.column(c)[0].as_py(), "<i8") for c in ("per_text", "sizes")}
    codes = np.frombuffer(row.column("codes")[0].as_py(), np.uint8).reshape(4, -1)
    codes = np.ascontiguousarray(codes.T).view("<i4").reshape(-1)
    words = np.frombuffer(row.column("words")[0].as_py(), np.uint8)
    return row.column("names").combine_chunks().flatten(), numbers["per_text"], codes, numbers["sizes"], words


def _features(per_word: np.ndarray, sizes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """FEATURES of texts whose words, with their log ratios and sizes, lie between the cuts."""
    n = len(cuts) - 1
    out = np.zeros((n, FEATURES))
    full = np.flatnonzero(np.diff(cuts))
    if not len(full):
        return out
    first = cuts[:-1][full]
    rows = np.repeat(np.arange(n), np.diff(cuts))
    out[full, 0] = np.add.reduceat(per_word, first) / np.add.reduceat(sizes, first)
    sums, bytes_ = (np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)]) for x in (per_word, sizes))
    stop = np.minimum(np.arange(len(rows)) + WINDOW, cuts[rows + 1])
    begin = np.maximum(stop - WINDOW, cuts[rows])
    out[full, 1] = np.maximum.reduceat((sums[stop] - sums[begin]) / (bytes_[stop] - bytes_[begin]), first)
    out[full, 2] = np.maximum.reduceat(per_word, first)
    worst = np.lexsort((-per_word, rows))  # rows stay in place, the worst words first
    among = np.arange(len(rows)) - cuts[rows] < WORST
    out[:, 3] = np.bincount(rows[among], per_word[worst][among], n) / WORST
    return out


def _score_chunk(path: str, found: list[np.ndarray], ranges: int, models: int) -> Iterator[pa.RecordBatch]:
    names, per_text, codes, sizes, words = _read_chunk(path)
    if len(sizes):
        _, _, place, edges = _ordered_grams(sizes, words, ranges)
        ratios = np.concatenate(found)
        per_word = [np.add.reduceat(ratios[place, k].astype(np.float64), edges) for k in range(models)]
    cuts = np.concatenate([[0], np.cumsum(per_text)])
    first = 0
    while first < len(names):
        last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + BLOCK_WORDS, "right")) - 1)
        own = codes[cuts[first] : cuts[last]]
        if len(own):
            size = (sizes[own] + 1).astype(np.float64)
            columns = [_features(x[own], size, cuts[first : last + 1] - cuts[first]) for x in per_word]
        else:
            columns = [np.zeros((last - first, FEATURES))] * models
        lists = [pa.array(x.tolist(), pa.list_(pa.float64())) for x in columns]
        yield pa.RecordBatch.from_arrays([names[first:last], *lists], ["doc_id", *(f"m{k}" for k in range(models))])
        first = last


def measure(texts: DataFrame, shards: DataFrame, ranges: int, models: tuple[str, ...], work: Work) -> DataFrame:
    """doc_id and FEATURES log ratios for each model: per byte of the whole text and of the worst window; of the
    worst word; mean of the WORST worst words.

    Texts are read once: a chunk of them becomes a file of word numbers, and its distinct grams go to the ranges of
    the scoring table, packed. Every range is read once, and what it has for a chunk goes back to that chunk.
    """
    folder = work.folder("chunks")
    make_folder(folder)
    chosen = [list(MODELS).index(m) for m in models]

    def want(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(chunk: Chunk) -> Iterator[pa.RecordBatch]:
            path, sizes, words = chunk.write(folder)
            own = [(-1, 0, b"")]  # says that there is a chunk, if it has no word
            if len(sizes):
                grams, cuts, _, _ = _ordered_grams(sizes, words, ranges)
                nothing = np.zeros((len(grams), 0), np.uint8)
                own += [(k, int(b - a), pack(grams[a:b], nothing[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            columns = [[path] * len(own), *map(list, zip(*own))]
            yield pa.RecordBatch.from_pydict(dict(zip(["path", "range", "n", "packed"], columns)))

        chunk = Chunk()
        for batch in batches:
            for first, last, data, bounds in slices(batch.column("text")):
                chunk.add(batch.column("doc_id")[first:last], data, bounds)
                if chunk.size >= CHUNK_BYTES:
                    yield from close(chunk)
                    chunk = Chunk()
        if chunk.names:
            yield from close(chunk)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, keys, ratios = None, np.zeros(0, np.uint64), np.zeros((0, len(MODELS)), np.float32)
        for batch in batches:
            out: list[tuple] = []
            for path, of, n, raw in zip(*(batch.column(c).to_pylist() for c in ("path", "range", "n", "packed"))):
                if path is None:
                    current = of
                    keys, ratios = unpack(raw, n, "<f4", len(MODELS))
                    continue
                if of != current:  # no label has taught anything here
                    current, keys, ratios = of, keys[:0], ratios[:0]
                grams, _ = unpack(raw, n, np.uint8, 0)
                out.append((path, of, n, look_up(grams, keys, ratios[:, chosen]).astype("<f4").tobytes()))
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(["path", "range", "n", "packed"], map(list, zip(*out)))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, found = None, []
        for batch in batches:
            for path, n, raw in zip(*(batch.column(c).to_pylist() for c in ("path", "n", "packed"))):
                if path != current:
                    if current is not None:
                        yield from _score_chunk(current, found, ranges, len(chosen))
                    current, found = path, []
                if n:
                    found.append(np.frombuffer(raw, "<f4").reshape(n, len(chosen)))
        if current is not None:
            yield from _score_chunk(current, found, ranges, len(chosen))

    wanted = work.table(texts.select("doc_id", "text").mapInArrow(want, WANTED), "wanted", "uncompressed")
    asked = wanted.filter("range >= 0").select(F.lit(1).alias("kind"), "path", "range", "n", "packed")
    held = shards.select(F.lit(0).alias("kind"), F.lit(None).cast("string").alias("path"), "range", "n", "packed")
    met = held.union(asked).repartition("range").sortWithinPartitions("range", "kind")
    answers = met.select("path", "range", "n", "packed").mapInArrow(answer, WANTED)
    there = wanted.filter("range < 0").select("path", "range", "n", "packed")
    by_chunk = there.union(answers).repartition("path").sortWithinPartitions("path", "range")
    columns = ", ".join(f"m{k} array<double>" for k in range(len(chosen)))
    scored = by_chunk.mapInArrow(score, f"doc_id long, {columns}")
    return work.table(scored.select("doc_id", *(F.col(f"m{k}").alias(m) for k, m in enumerate(models))), "measured")


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (the last is the constant), means and scales, by Newton steps with a small penalty."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - y) + 1e-2 * w
        bend = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def toxicity(docs: DataFrame, labels: DataFrame, work: Work | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Labels (doc_id, toxic) count only where crc32(doc_id) mod 5 is not 0; null ids and null labels teach
    nothing, of several labels of one id the greatest counts. A null text is empty; empty texts have the score
    of log ratios of 0. Without any label of one of the classes every score is the share of toxic labels, or 0
    without labels. Other columns of `docs` and `labels` are not read.
    """
    work = work or Work(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    taught = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        (F.pmod(crc, F.lit(5)) != 0) & F.col("toxic").isNotNull()
    )
    taught = taught.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    group = F.coalesce(F.when(F.col("toxic") > 0, 2 + fold).otherwise(F.when(F.col("toxic").isNotNull(), fold)), F.lit(4))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    taught = work.table(taught, "taught")
    side = F.broadcast(taught) if taught.count() <= FEW_LABELS else taught
    grams = work.table(count_grams(texts.join(side, "doc_id", "left").withColumn("group", group), 4 * partitions), "grams", "zstd")
    ratios = work.table(log_ratios(grams), "ratios")
    work.drop(grams)
    ranges = max(ratios.count() // SHARD, 2 * partitions) | 1  # odd: bytes of contexts spread over all ranges
    shards = work.table(_shards(ratios, ranges), "shards", "uncompressed")
    work.drop(ratios)

    order = F.xxhash64("doc_id")
    sampled = texts.select("doc_id").join(side, "doc_id").orderBy(order, "doc_id").limit(SAMPLE).select("doc_id").distinct()
    sampled = work.table(sampled, "sampled")  # SAMPLE ids at most
    measured = measure(texts, shards, ranges, ("all",), work)
    known = texts.join(F.broadcast(sampled), "doc_id")
    without = measure(known, shards, ranges, ("without0", "without1"), work)
    other = F.when(fold == 0, F.col("without0")).otherwise(F.col("without1"))
    sample = without.join(side, "doc_id").select(other.alias("x"), "toxic", order.alias("order"), "doc_id")
    rows = sample.orderBy("order", "doc_id", "x").limit(SAMPLE).select("x", "toxic").toArrow()  # bounded
    y = np.array(rows.column("toxic").to_pylist(), np.float64) > 0
    remainder = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5))
    if y.all() or not y.any():
        score = F.lit(float(y.mean()) if len(y) else 0.0)
    else:
        w, mean, scale = fit_logistic(np.array(rows.column("x").to_pylist()), y.astype(np.float64))
        line = F.lit(float(w[-1] - (w[:-1] * mean / scale).sum()))
        for k in range(FEATURES):
            line = line + float(w[k] / scale[k]) * F.col("all")[k]
        score = 1 / (1 + F.exp(-line))
    return measured.select("doc_id", (remainder == 0).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
