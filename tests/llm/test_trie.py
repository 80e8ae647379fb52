"""The prefix trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from wavesym.llm.prefix_trie import branch_from_base, prefix_trie, turn_sequences

TURNS = "conv_id long, turn long, role string, text string, path string, key string, ends string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "y") for r in rows], TURNS)


def plain(rows):
    """Nodes by a dictionary of all prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(r, x) for _, _, r, _, x in sorted(t)] for c, t in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    for node, own_members in members.items():
        stack, leaves, saved = [node], 0, 0
        while stack:
            x = stack.pop()
            leaves += not children[x]
            saved += (len(members[x]) - 1) * len(x[-1][1].encode()) if x else 0
            stack += children[x]
        ids = ",".join(map(str, sorted(ends[node])))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ids.encode()).hexdigest()
        out.append((min(own_members), len(node), parent, len(own_members), len(children[node]), leaves, saved, digest))
    return sorted(out, key=repr)


def random_rows(seed, convs=120):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 2 * convs), convs):
        text = [("hot", "hello"), ("user", "é")] if rng.random() < 0.5 else []
        text += [(rng.choice(["user", None, ""]), rng.choice(["a", "bb", "", None])) for _ in range(rng.randrange(7))]
        rows += [(c, k if rng.random() < 0.9 else None, r, x) for k, (r, x) in enumerate(text)]
    rows += [(500 + 5 * k, t, "user", f"same {t}") for k in range(40) for t in range(30)]  # copies of a long one
    rows += [(900 + 5 * k, t, "user", f"trunk {t}" if t < 20 + k % 3 else f"own {k}") for k in range(30) for t in range(24)]
    return rows + [(3, 1, "user", "tie"), (3, 1, "user", "tie"), (3, 1, "a", "tie"), (None, 1, "user", "nobody")]


@pytest.mark.parametrize("limit", [1, 12, 50_000])
def test_nodes_equal_a_plain_trie(spark, limit):
    rows = random_rows(limit)
    got = prefix_trie(branch_from_base(turn_sequences(table(spark, rows))), limit=limit)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=repr) == plain(rows)


def test_empty_table_and_one_long_conversation(spark):
    assert prefix_trie(branch_from_base(turn_sequences(table(spark, [])))).collect() == []
    rows = [(5, t, "user", "word " * (2000 if t == 7 else 1)) for t in range(3000)] + [(10, t, "user", "word ") for t in range(1500)]
    got = prefix_trie(turn_sequences(table(spark, rows)), limit=100)
    assert got.count() == 3001 + 1500 - 7
    assert got.filter("n_children = 2").select("depth", "n_convs", "n_leaves").collect() == [(7, 2, 2)]
    root = got.filter("depth = 0").first()
    assert (root.conv_id, root.parent_conv_id, root.n_convs, root.saved_tokens) == (5, None, 2, 7 * 5)
