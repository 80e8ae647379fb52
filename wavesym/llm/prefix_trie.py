"""The trie of conversation prefixes, built as a burst trie over shards.

A conversation is a sequence of turn ids (16 bytes each, a digest of role and text). Sequences start in one
container under the root. A container that holds too many turns bursts: what its sequences have in common, up to
the first turn where they part, becomes a chain of trie heads, and the sequences go on to containers by their
next turn id. The containers that remain are dealt out over tasks, sorted, and swept level by level into nodes;
sums over subtrees that cross heads are added up along the short path of bursts above each container.

Equal sequences are one entry with a weight, so copies of a conversation, however many, never make a container
burst. A conversation is one row of 20 bytes per turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavesym.llm.store import Work

ID = 16  # bytes of a turn id
CONTAINER = 50_000  # turns of an ordinary container
FEW_BURSTS = 50_000  # rows of 60 bytes that may be broadcast
SALTS = 16
CHUNK = 1 << 16  # characters of joined ids in a row
NOTHING = hashlib.sha256(b"").hexdigest()

SEQUENCES = "conv_id long, seq binary, sizes array<int>"
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends string, path array<binary>"
)


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, items: the turns in order as structs (id in hex, bytes of the text).

    Ordered by turn, null first; rows of one turn by role, then by id. Null roles and texts are empty. Rows
    without conv_id belong to no conversation and are left out. Other columns are not read.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn_id = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    item = F.struct(F.col("turn").alias("turn"), role.alias("role"), turn_id.alias("id"), F.octet_length(text).alias("bytes"))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), item.alias("item"))
    ordered = F.sort_array(F.collect_list("item"))  # nulls first
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda x: F.struct(x["id"].alias("id"), x["bytes"].alias("bytes"))).alias("items"))


def branch_from_base(sequences: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Conversation c with its first h turns taken from conversation c - c % family; h = crc32(c) % most."""
    base_id = F.col("conv_id") - F.col("conv_id") % family
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    own = sequences.select("conv_id", "items", base_id.alias("base_id"), h.alias("h"))
    bases = sequences.filter(F.col("conv_id") % family == 0)
    bases = bases.select(F.col("conv_id").alias("base_id"), F.slice("items", 1, most - 1).alias("first"))
    first = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.slice("items", 1, 0))
    later = F.slice("items", F.col("h") + 1, F.greatest(F.size("items") - F.col("h"), F.lit(0)))
    return own.join(bases, "base_id", "left").select("conv_id", F.concat(first, later).alias("items"))


def _digests(members: DataFrame, work: Work) -> DataFrame:
    """skey, ends: SHA-256 of the ids of each key, ascending; the ids stream through in pieces of CHUNK."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        key, held, length = None, [], 0

        def row():
            return pa.RecordBatch.from_pydict(
                {"skey": pa.array([key], pa.binary()), "part": [part], "number": [number], "ids": [",".join(held)]}
            )

        for batch in batches:
            for k, c in zip(batch.column("skey").to_pylist(), batch.column("conv_id").to_pylist()):
                if held and (k != key or length > CHUNK):
                    yield row()
                    number, held, length = number + 1, [], 0
                key = k
                held.append(str(c))
                length += len(held[-1]) + 1
        if held:
            yield row()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for k, ids in zip(batch.column("skey").to_pylist(), batch.column("ids").to_pylist()):
                if k != key:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_pydict({"skey": pa.array([d[0] for d in done], pa.binary()), "ends": [d[1] for d in done]})
        if state is not None:
            yield pa.RecordBatch.from_pydict({"skey": pa.array([key], pa.binary()), "ends": [state.hexdigest()]})

    ranged = members.repartitionByRange("skey", "conv_id").sortWithinPartitions("skey", "conv_id")
    joined = ranged.mapInArrow(pieces, "skey binary, part long, number long, ids string")
    dealt = joined.repartition("skey").sortWithinPartitions("skey", "part", "number")
    return work.table(dealt.mapInArrow(digest, "skey binary, ends string"), "digests")


def distinct_sequences(sequences: DataFrame, work: Work) -> DataFrame:
    """seq, sizes, conv_id (smallest), n, ends (digest of all its conversations): a row per different sequence."""
    packed = sequences.select(
        "conv_id",
        F.coalesce(F.unhex(F.array_join("items.id", "")), F.lit(b"")).alias("seq"),
        F.transform("items.bytes", lambda x: x.cast("int")).alias("sizes"),
    )
    packed = work.table(packed.withColumn("skey", F.unhex(F.md5("seq"))), "sequences")
    groups = packed.groupBy("skey", "seq", "sizes").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    groups = work.table(groups, "distinct")
    repeated = groups.filter("n > 1").select("skey")
    digests = _digests(packed.select("skey", "conv_id").join(repeated, "skey", "left_semi"), work)
    single = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    return groups.join(digests, "skey", "left").select("seq", "sizes", "conv_id", "n", F.coalesce("ends", single).alias("ends"))


def _common(table: pa.Table) -> tuple[list[int], list[list[int]], list[str | None]]:
    """Of each container: turns its least and greatest sequence share, bytes of the turns from its top, digest."""
    stops, chains, ends = [], [], []
    for depth, low, high in zip(*(table.column(c).to_pylist() for c in ("depth", "low", "high"))):
        a, b = (np.frombuffer(s, f"V{ID}") for s in (low["seq"], high))
        m = min(len(a), len(b))
        apart = np.flatnonzero(a[:m] != b[:m])
        stop = int(apart[0]) if len(apart) else m
        stops.append(stop)
        chains.append(([0, *low["sizes"]])[depth : stop + 1])
        ends.append(low["ends"] if len(a) == stop else None)
    return stops, chains, ends


def burst(entries: DataFrame, limit: int, work: Work) -> tuple[DataFrame, DataFrame | None]:
    """(closed, heads): entries with their final containers, and a row per container that burst.

    A container of one sequence never bursts. Every burst takes a container to the turn where its sequences
    part, so rounds go with the number of partings above a sequence, not with its length.
    """
    open_ = entries.select(
        "*",
        F.lit(0).alias("depth"),
        F.substring("seq", 1, 0).alias("key"),  # no literal: joins on it are equi-joins
        F.array().cast("array<binary>").alias("path"),
        F.lit(None).cast("long").alias("above"),
    )
    closed, heads = [], []
    while True:
        turns = F.sum(F.size("sizes") - F.col("depth")).alias("turns")
        sizes = open_.groupBy("key").agg(turns, F.count("*").alias("seqs"), F.sum("n").alias("n"), F.min("conv_id").alias("least"))
        large = work.table(sizes.filter(f"turns > {limit} and seqs > 1").drop("turns", "seqs"), "large")
        count = large.count()
        if not count:
            closed.append(open_)
            break
        few = count <= FEW_BURSTS

        def meet(rows: DataFrame, info: DataFrame, how: str) -> DataFrame:
            if few:
                return rows.join(F.broadcast(info), "key", how)
            salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
            salted = rows.withColumn("salt", F.pmod(F.xxhash64("seq"), F.lit(SALTS)).cast("int"))
            return salted.join(info.withColumn("salt", salts), ["key", "salt"], how).drop("salt")

        closed.append(meet(open_, large.select("key"), "left_anti"))
        bursting = meet(open_, large.select("key", F.col("n").alias("members"), "least"), "inner")
        ends_of = bursting.groupBy("key").agg(
            F.min(F.struct("seq", "sizes", "ends")).alias("low"),
            F.max("seq").alias("high"),
            F.first("depth").alias("depth"),
            F.first("path").alias("path"),
            F.first("above").alias("above"),
            F.first("members").alias("n"),
            F.first("least").alias("conv_id"),
        )

        def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                stops, sizes, ends = _common(batch)
                kept = ["key", "depth", "path", "above", "n", "conv_id"]
                columns = [batch.column(c) for c in kept]
                more = [pa.array(stops, pa.int32()), pa.array(sizes, pa.list_(pa.int32())), pa.array(ends, pa.string())]
                yield pa.RecordBatch.from_arrays(columns + more, [*kept, "stop", "chain", "ends"])

        schema = "key binary, depth int, path array<binary>, above long, n long, conv_id long, stop int, chain array<int>, ends string"
        head = work.table(ends_of.mapInArrow(chains, schema), "heads")
        heads.append(head)
        going = meet(open_, head.select("key", "stop", F.col("conv_id").alias("parent")), "inner").filter(F.size("sizes") > F.col("stop"))
        first = F.col("depth") * ID + 1
        between = F.substring(F.col("seq"), first, (F.col("stop") + 1 - F.col("depth")) * ID)
        open_ = work.table(
            going.select(
                "seq",
                "sizes",
                "conv_id",
                "n",
                "ends",
                (F.col("stop") + 1).alias("depth"),
                F.unhex(F.md5(F.concat("key", between))).alias("key"),
                F.array_append("path", F.col("key")).alias("path"),
                F.col("parent").alias("above"),
            ),
            "open",
        )
    whole = closed[0]
    for more in closed[1:]:
        whole = whole.unionByName(more)
    every = None
    for more in heads:
        every = more if every is None else every.unionByName(more)
    return whole, every


def sweep(rows: pa.Table) -> pa.RecordBatch:
    """The nodes of whole containers, whose sequences lie side by side in order."""
    keys = rows.column("key").to_pylist()
    depth = rows.column("depth").to_numpy().astype(np.int64)
    sizes = rows.column("sizes").combine_chunks() if isinstance(rows.column("sizes"), pa.ChunkedArray) else rows.column("sizes")
    flat = sizes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    length = np.fromiter((len(s) // ID for s in rows.column("seq").to_pylist()), np.int64, len(keys))
    ids = np.frombuffer(b"".join(rows.column("seq").to_pylist()), np.uint64).reshape(-1, 2)
    first = np.cumsum(length) - length
    weight = rows.column("n").to_numpy()
    conv = rows.column("conv_id").to_numpy()

    n = len(keys)
    top = np.array([k == 0 or keys[k] != keys[k - 1] for k in range(n)])
    shared = np.full(n, -1, np.int64)  # turns in common with the row before; -1 at the start of a container
    m = np.minimum(length[1:], length[:-1])
    at = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
    here, before = at + np.repeat(first[1:], m), at + np.repeat(first[:-1], m)
    apart = np.where((ids[here] == ids[before]).all(axis=1), np.repeat(m, m), at)
    some = np.flatnonzero(m)
    shared[1:] = 0
    if len(some):
        shared[some + 1] = np.minimum.reduceat(apart, (np.cumsum(m) - m)[some])
    shared[top] = -1

    levels: list[dict] = []
    group = np.zeros(n, np.int64)
    for d in range(int(depth.min()), int(length.max()) + 1):
        at = np.flatnonzero((depth <= d) & (length >= d))
        if not len(at):
            levels.append({})
            continue
        new = (shared[at] < d) | (top[at])
        starts = np.flatnonzero(new)
        lead = at[starts]
        has_parent = depth[lead] < d
        parent = np.where(has_parent, group[lead], -1)
        members = np.add.reduceat(weight[at], starts)
        last = flat[first[lead] + d - 1] if d else np.zeros(len(lead), np.int64)
        of = np.cumsum(new) - 1
        group[at] = of
        ending = length[at] == d
        ends = np.full(len(lead), -1, np.int64)
        ends[of[ending]] = at[ending]
        least = np.minimum.reduceat(conv[at], starts)
        levels.append(
            {"lead": lead, "parent": parent, "n": members, "conv": least, "saved": (members - 1) * last, "ends": ends, "depth": d}
        )
    below = None
    for level in reversed(levels):
        if not level:
            below = None
            continue
        count = len(level["lead"])
        children, leaves = np.zeros(count, np.int64), np.zeros(count, np.int64)
        if below is not None:
            inner = np.flatnonzero(below["parent"] >= 0)
            up = below["parent"][inner]
            children = np.bincount(up, minlength=count)
            np.add.at(leaves, up, below["leaves"][inner])
            np.add.at(level["saved"], up, below["saved"][inner])
        level["children"], level["leaves"] = children, np.where(children == 0, 1, leaves)
        below = level
    parents, above = [], rows.column("above").to_pylist()
    tops, paths, digests = [], rows.column("path").to_pylist(), rows.column("ends").to_pylist()
    previous = None
    for level in levels:
        if not level:
            previous = None
            continue
        is_top = level["parent"] < 0
        lead = level["lead"].tolist()
        inner = previous["conv"][np.maximum(level["parent"], 0)].tolist() if previous is not None else lead
        parents += [above[row] if t else c for row, t, c in zip(lead, is_top.tolist(), inner)]
        tops += [paths[row] if t else None for row, t in zip(lead, is_top.tolist())]
        previous = level
    full = [level for level in levels if level]

    def joined(name: str) -> pa.Array:
        return pa.array(np.concatenate([level[name] for level in full]), pa.int64())

    ends = np.concatenate([level["ends"] for level in full]).tolist()
    return pa.RecordBatch.from_arrays(
        [
            joined("conv"),
            pa.array(np.concatenate([np.full(len(level["lead"]), level["depth"], np.int64) for level in full])),
            pa.array(parents, pa.int64()),
            joined("n"),
            joined("children"),
            joined("leaves"),
            joined("saved"),
            pa.array([digests[e] if e >= 0 else None for e in ends], pa.string()),
            pa.array(tops, pa.list_(pa.binary())),
        ],
        [c.split()[0] for c in NODES.split(", ")],
    )


def _sweep_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers come in one piece; some of them are swept at a time."""
    held: list[pa.RecordBatch] = []
    turns = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        turns += batch.column("sizes").flatten().__len__()
        if turns < CONTAINER:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column("key").to_pylist()
        cut = len(keys) - 1
        while cut and keys[cut - 1] == keys[-1]:
            cut -= 1
        if cut:
            yield sweep(table.slice(0, cut))
        rest = table.slice(cut).combine_chunks()
        held, turns = rest.to_batches(), len(rest.column("sizes").combine_chunks().flatten())
    if held:
        yield sweep(pa.Table.from_batches(held).combine_chunks())


def _head_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in NODES.split(", ")][:-1]
    kinds = [pa.int64()] * 7 + [pa.string()]
    for batch in batches:
        out: list[tuple] = []
        for row in batch.to_pylist():
            saved, nodes = row["saved"], []
            for k in range(len(row["chain"]) - 1, -1, -1):
                last = k == len(row["chain"]) - 1
                saved += (row["n"] - 1) * row["chain"][k]
                parent = row["conv_id"] if k else row["above"]
                children = row["children"] if last else 1
                nodes.append((row["conv_id"], row["depth"] + k, parent, row["n"], children, row["leaves"], saved, row["ends"] if last else None))
            out += nodes
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)


def prefix_trie(sequences: DataFrame, work: Work | None = None, limit: int = CONTAINER) -> DataFrame:
    """The nodes of the trie of all prefixes of `sequences` (conv_id, items).

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves (childless
    nodes of the subtree), saved_tokens (over the subtree, members but one times the bytes of the last text),
    ends_sha256 (of the ids that end here, ascending, joined by commas). Sequences without turns are members of
    the root. Without any sequence there is no node. A conv_id is one sequence.
    """
    work = work or Work(sequences.sparkSession)
    entries = work.table(distinct_sequences(sequences, work), "entries")
    closed, heads = burst(entries, limit, work)
    swept = closed.select("key", "seq", "sizes", "conv_id", "n", "ends", "depth", "path", "above").repartition("key")
    nodes = work.table(swept.sortWithinPartitions("key", "seq").mapInArrow(_sweep_all, NODES), "nodes")
    out = nodes.drop("path")
    if heads is not None:
        own = F.aggregate("chain", F.lit(0).cast("long"), lambda a, x: a + x.cast("long")) * (F.col("n") - 1)
        parts = nodes.filter(F.size("path") > 0).select("path", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
        parts = parts.union(heads.filter(F.size("path") > 0).select("path", F.lit(0).cast("long"), own))
        by_path = parts.groupBy("path").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.count("*").alias("children"))
        each = by_path.select(F.posexplode("path").alias("place", "key"), F.size("path").alias("long"), "leaves", "saved", "children")
        direct = F.when(F.col("place") == F.col("long") - 1, F.col("children")).otherwise(0)
        sums = each.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.sum(direct).alias("children"))
        spread = heads.join(sums, "key").select("conv_id", "depth", "above", "n", "chain", "ends", "leaves", "saved", "children")
        out = out.union(spread.mapInArrow(_head_nodes, NODES.rsplit(",", 1)[0]))
    return out.withColumn("ends_sha256", F.coalesce("ends", F.lit(NOTHING))).drop("ends")
