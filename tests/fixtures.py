"""Small inputs and plain Python versions of the operators, for brute-force comparison."""

from __future__ import annotations

import math
import random


def series(seed: int, shape: dict[str, list[int]]) -> list[tuple[str, str, str, list[float]]]:
    """Records (label, id, sid, values): for each id the lengths of its records."""
    rng = random.Random(seed)
    out = []
    for ident, lengths in shape.items():
        for k, n in enumerate(lengths):
            values = [round(rng.gauss(50, 20), 3) for _ in range(n)]
            out.append((str(len(ident) % 2), ident, f"s{k:03d}", values))
    return out


SHAPE = {"hot": [7, 300, 1, 2, 45, 16, 17, 3], "b": [5], "cc": [6, 7], "dd": [120]}


def smoothed(records, lookback=16):
    """{(id, sid, pos): mean} over the points of an id in order of sid and pos."""
    by_id: dict[str, list] = {}
    for _, ident, sid, values in sorted(records, key=lambda r: (r[1], r[2])):
        by_id.setdefault(ident, []).extend((sid, p, v) for p, v in enumerate(values))
    out = {}
    for ident, points in by_id.items():
        for j, (sid, pos, _) in enumerate(points):
            frame = [v for _, _, v in points[max(0, j - lookback) : j + 1]]
            out[ident, sid, pos] = sum(frame) / len(frame)
    return out


def quantiles(records, probs=(0.2, 0.4, 0.6, 0.8)):
    """{id: cuts}: the smallest value with at least p * n values up to it."""
    by_id: dict[str, list] = {}
    for (ident, _, _), mean in smoothed(records).items():
        by_id.setdefault(ident, []).append(mean)
    return {
        ident: [sorted(v)[max(math.ceil(p * len(v) - 1e-9), 1) - 1] for p in probs]
        for ident, v in by_id.items()
    }


def letters(records):
    """{(id, sid): string}."""
    cuts = quantiles(records)
    return {
        (ident, sid): "".join("ABCDE"[sum(v >= c for c in cuts[ident])] for v in values)
        for _, ident, sid, values in records
    }


def transition_rows(text: str, a: int):
    """{prefix: [share of A..E]} of one record."""
    seen: dict[str, list[str]] = {}
    for i in range(len(text) - a + 2):
        seen.setdefault(text[i : i + a - 1], []).append(text[i + a - 1 : i + a])
    return {p: [n.count(c) / len(n) for c in "ABCDE"] for p, n in seen.items()}
