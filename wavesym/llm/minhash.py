"""Near duplicates by one-permutation MinHash.

One hash of the shingles splits its range into bins; a bin's least value is its entry of the signature, and an
empty bin takes the entry of a filled one that its own probe sequence finds (optimal densification). Bands of
entries name buckets. A bucket links its members to one centre, a star, and links are confirmed on the full
sets. A member that the centre turns down may still be linked to another member, so a bucket whose members have
not come together goes on with another centre. After FIRST_ROUNDS the members of buckets still open are joined
on their rare shingles, which finds every linked pair among them: of two sets that are linked, each has one of
the common shingles among its rarest, so many of them as the other may lack and one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavesym.llm.components import components
from wavesym.llm.store import Work
from wavesym.llm.text import U64, mix, shingle_hashes, slices, word_bounds, word_hashes


@dataclass(frozen=True)
class MinHash:
    """Linked when `den` * intersection >= `num` * union; `bands` * `rows` bins."""

    num: int = 85
    den: int = 100
    bands: int = 32
    rows: int = 6

    @property
    def bins(self) -> int:
        return self.bands * self.rows


PROBES = 64
FIRST_ROUNDS = 2
BLOCK = 1000  # holders of a shingle that meet in one place; more are dealt in blocks, and blocks meet by two


class Signer:
    def __init__(self, spec: MinHash):
        bins = spec.bins
        self.spec, self.bins = spec, bins
        self.edges = (np.arange(bins, dtype=np.uint64) * U64(2**64 // bins)).astype(np.uint64)
        self.place = mix(np.arange(1, spec.rows + 1, dtype=np.uint64)) | U64(1)
        self.band = mix(np.arange(1001, 1001 + spec.bands, dtype=np.uint64))
        self.probe_tables: list[np.ndarray] = []

    def _probes(self, k: int) -> np.ndarray:
        while len(self.probe_tables) <= k:
            at = np.arange(self.bins * PROBES, dtype=np.uint64) + U64(len(self.probe_tables) * self.bins * PROBES + 7)
            self.probe_tables.append((mix(at * U64(0x9E3779B97F4A7C15)) % U64(self.bins)).astype(np.int64).reshape(self.bins, PROBES))
        return self.probe_tables[k]

    def signature(self, ordered: np.ndarray) -> np.ndarray:
        """Of a set given as ascending distinct hashes."""
        first = np.searchsorted(ordered, self.edges)
        full = np.diff(first, append=len(ordered)) > 0
        entries = ordered[np.minimum(first, len(ordered) - 1)]
        empty = np.flatnonzero(~full)
        if len(empty) == self.bins - 1:
            entries[:] = ordered[0]
            return entries
        k, source = 0, np.arange(self.bins)
        while len(empty):
            probes = self._probes(k)[empty]
            hits = full[probes]
            found = hits.any(axis=1)
            source[empty[found]] = probes[found, hits[found].argmax(axis=1)]
            empty, k = empty[~found], k + 1
        return entries[source]

    def buckets(self, ordered: np.ndarray) -> np.ndarray:
        parts = self.signature(ordered).reshape(self.spec.bands, self.spec.rows)
        return mix((parts * self.place).sum(axis=1, dtype=np.uint64) ^ self.band)


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Ascending distinct shingle hashes of each text; A-Z count as a-z."""
    starts, ends, rows = word_bounds(data, bounds)
    hashes, first = shingle_hashes(word_hashes(data, starts, ends, fold=True), rows, len(bounds) - 1)
    return [np.unique(hashes[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def signatures(texts: DataFrame, spec: MinHash) -> DataFrame:
    """doc_id, n_shingles, digest of the set (null if empty), buckets."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(spec)
        for batch in batches:
            names = batch.column("doc_id")
            for low, high, data, bounds in slices(batch.column("text")):
                sets = shingle_sets(data, bounds)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                buckets = [signer.buckets(s).view(np.int64) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [names[low:high], pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(buckets, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "digest", "buckets"],
                )

    return texts.mapInArrow(sign, "doc_id long, n_shingles long, digest binary, buckets array<long>")


def _sets(texts: DataFrame) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in slices(batch.column("text")):
                found = [s.view(np.int64) for s in shingle_sets(data, bounds)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[low:high], pa.array(found, pa.list_(pa.int64()))], ["rep", "shingles"]
                )

    return texts.mapInArrow(sets, "rep long, shingles array<long>")


def _confirm(pairs: DataFrame, sets: DataFrame, spec: MinHash) -> DataFrame:
    """a, b, linked: by the full sets."""
    one = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    linked = spec.den * both >= spec.num * (F.size("sa") + F.size("sb") - both)
    return pairs.join(one, "a").join(two, "b").select("a", "b", linked.alias("linked")).groupBy("a", "b").agg(F.max("linked").alias("linked"))


def _rare_pairs(sets: DataFrame, spec: MinHash, work: Work) -> DataFrame:
    """a, b: pairs of different components of sets (rep, shingles, component), every linked pair among them.

    Shingles are ranked by the number of sets that have them, rarest first, ties by value: one order for all
    sets. Of sizes n and m a linked pair has `least` shingles in common, so the first of these has at most
    n - least shingles before it in one set and m - least in the other.
    """
    set_of = F.xxhash64("shingles").alias("set")  # tells apart the texts of one id
    each = sets.select("rep", "component", set_of, F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("shingle"))
    held = each.groupBy("shingle").agg(F.count("*").alias("held"))
    rank = F.row_number().over(Window.partitionBy("rep", "set").orderBy("held", "shingle")) - 1
    # the smallest partner allowed has num / den of the n shingles, all of them common
    ranked = each.join(held.filter("held > 1"), "shingle", "left").fillna(1, ["held"]).withColumn("rank", rank)
    early = work.table(ranked.filter((F.col("held") > 1) & (spec.den * F.col("rank") <= (spec.den - spec.num) * F.col("n"))), "early", "zstd")
    several = early.groupBy("shingle").agg(F.count("*").alias("held"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    several = several.filter("lo < hi").select("shingle", F.ceil(F.col("held") / BLOCK).alias("blocks"))
    early = early.join(several, "shingle").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    early = early.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    first, second = F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second")
    dealt = work.table(early.select("shingle", first, second, "own", "rep", "component", "n", "rank"), "rare", "zstd")
    key = ["shingle", "first", "second"]
    one = dealt.select(*key, *(F.col(c).alias(f"{c}_a") for c in ("own", "rep", "component", "n", "rank")))
    two = dealt.select(*(F.col(c).alias(f"{c}_b") for c in (*key, "own", "rep", "component", "n", "rank")))
    n, m = F.col("n_a"), F.col("n_b")
    room = F.least(n - F.col("rank_a"), m - F.col("rank_b"))  # common shingles there can be from here on
    meet = F.expr("shingle = shingle_b and first = first_b and second = second_b and rep_a < rep_b and component_a <> component_b")
    meet &= (F.col("first") == F.col("second")) | (F.col("own_a") != F.col("own_b"))
    meet &= spec.den * F.least(n, m) >= spec.num * F.greatest(n, m)
    meet &= (spec.num + spec.den) * room >= spec.num * (n + m)
    return one.join(two, meet).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def _shared(spread: DataFrame) -> DataFrame:
    """Rows (rep, n, bucket) of the buckets that two representatives share."""
    several = spread.groupBy("bucket").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi")
    return spread.join(several.select("bucket"), "bucket")


def _links(reps: DataFrame, texts: DataFrame, spec: MinHash, work: Work) -> DataFrame:
    """node, component of the representatives (rep, n, buckets) that are linked with others."""
    active = work.table(_shared(reps.select("rep", "n", F.explode("buckets").alias("bucket"))), "members")
    active = active.withColumn("component", F.col("rep"))
    members = active.select(F.col("rep").alias("doc_id")).distinct()
    sets = work.table(_sets(texts.join(members, "doc_id")), "sets", "zstd")
    found = tried = None
    for rounds in range(FIRST_ROUNDS):
        # one centre for each bucket, another one each round
        order = F.struct((F.xxhash64("rep", F.lit(rounds)) if rounds else F.col("rep")).alias("order"), "rep", "n", "component")
        stars = work.table(active.groupBy("bucket").agg(F.min(order).alias("c")), "centres")
        near = active.join(stars, "bucket").filter("component <> c.component").filter(
            spec.den * F.least("n", "c.n") >= spec.num * F.greatest("n", "c.n")
        )
        pairs = near.select(F.least("rep", "c.rep").alias("a"), F.greatest("rep", "c.rep").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        done = work.table(_confirm(pairs, sets, spec), "tried")
        tried = done.select("a", "b") if tried is None else tried.union(done.select("a", "b"))
        found = _joined(found, done.filter("linked").select("a", "b"), work)
        used = stars.select("bucket", F.col("c.rep").alias("rep"))
        rest = active.drop("component").join(used, ["bucket", "rep"], "left_anti").join(found.withColumnRenamed("node", "rep"), "rep", "left")
        rest = work.table(rest.withColumn("component", F.coalesce("component", "rep")), "members")
        still = rest.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("bucket")
        active = work.table(rest.join(still, "bucket").select("rep", "n", "bucket", "component"), "members")
        work.drop(rest)
        if active.isEmpty():
            return found
    # two that share an open bucket are both among its members
    open_sets = sets.join(active.select("rep", "component").distinct(), "rep")
    pairs = _rare_pairs(open_sets, spec, work).join(tried, ["a", "b"], "left_anti")
    done = work.table(_confirm(pairs, sets, spec), "tried")
    return _joined(found, done.filter("linked").select("a", "b"), work)


def _joined(found: DataFrame | None, links: DataFrame, work: Work) -> DataFrame:
    """node, component with the links (a, b) added."""
    if found is None:
        return components(links, work)
    if links.isEmpty():
        return found
    return components(links.union(found.select(F.col("node").alias("a"), F.col("component").alias("b"))), work)


def near_duplicates(docs: DataFrame, spec: MinHash = MinHash(), work: Work | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    A null or empty text has no shingles and is linked with nothing. Rows that share an id are one document
    with several texts. A row without an id has no component and is kept. Other columns of `docs` are not read;
    an empty table gives no rows.
    """
    work = work or Work(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = work.table(signatures(texts, spec), "signatures", "zstd")
    known = signed.filter("digest is not null and doc_id is not null")
    classes = known.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n"), F.any_value("buckets").alias("buckets")
    )
    classes = work.table(classes, "classes", "zstd")
    found = _links(classes, texts, spec, work)
    named = classes.select("digest", "rep")
    several = known.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).filter("lo < hi")
    shared = known.join(several.select("doc_id"), "doc_id").join(named, "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    if not shared.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(shared), work)
    found = found.withColumnRenamed("node", "rep")
    whole = named.join(found, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "digest").join(whole, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
