"""Secrets: known shapes, and strings that a battery of tests can't tell from random symbols.

A run of symbols is read in the smallest encoding that has them all. Three tests ask whether it could be drawn
at random from that alphabet: chi-squared for even use, runs above and below the middle, serial correlation;
Fisher's sum makes one p-value of them. Ordinary text passes too now and then, the more the shorter. So decoys
tell, for each class of length, the least p-value at which at most FALSE_SHARE of the finds are foretold to be
false: for runs with digits or signs the long runs of letters alone, read in the same alphabets, of that length or
shorter; for runs of letters, which are read in alphabets of letters, the words of each text joined to that length.
Where decoys are few a prior speaks: PRIOR of them, of which half as many pass with every HALVING characters.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavesym.llm.store import Work

# fixed values: the shapes of the base kinds
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")
# fixed values: alphabets, smallest first
ALPHABETS = (
    "0123456789",
    "0123456789abcdef",
    "0123456789ABCDEF",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "0123456789abcdefghijklmnopqrstuvwxyz",
    "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
)
# fixed values: alphabets of runs of letters alone
LETTERS = (
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
)
LEAST = 16
RUN = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST},}}")
LENGTH_STEPS = (16, 18, 20, 22, 24, 28, 32, 40, 48, 64, 96, 128)
STEPS = 100  # of a p-value
FALSE_SHARE = 0.05
LEAST_P = 0.01
PRIOR, HALVING = 20, 8
CLASSES = len(LENGTH_STEPS)  # those of letters alone come after the others
WORD = re.compile(r"[A-Za-z]{2,15}")


class _Tables:
    def __init__(self, alphabets: tuple[str, ...]):
        self.of = np.zeros(256, np.uint16)  # bit k: the byte is in alphabet k
        self.place = np.zeros((len(alphabets), 256), np.int64)
        for k, letters in enumerate(alphabets):
            for n, c in enumerate(letters):
                self.of[ord(c)] |= 1 << k
                self.place[k, ord(c)] = n
        self.size = np.array([len(a) for a in alphabets])


_MIXED, _ALONE = _Tables(ALPHABETS), _Tables(LETTERS)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True

_erfc = np.vectorize(math.erfc, otypes=[float])


def _chi_tail(x: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Upper tail of chi-squared, by the cube root that is nearly normal."""
    spread = 2 / (9 * df)
    return 0.5 * _erfc((np.cbrt(x / df) - (1 - spread)) / np.sqrt(2 * spread))


def battery(runs: list[bytes], tables: _Tables = _MIXED) -> tuple[np.ndarray, np.ndarray]:
    """The combined p-value of each run, and whether it is of letters alone; `tables` has an alphabet for each."""
    if not runs:
        return np.zeros(0), np.zeros(0, bool)
    data = np.frombuffer(b"".join(runs), np.uint8)
    n = np.array([len(r) for r in runs])
    first = np.cumsum(n) - n
    run = np.repeat(np.arange(len(runs)), n)
    letters = np.logical_and.reduceat(_LETTER[data], first)
    common = np.bitwise_and.reduceat(tables.of[data], first)
    kind = np.argmax((common[:, None] >> np.arange(len(tables.size))) & 1, axis=1)
    size = tables.size[kind]
    symbol = tables.place[kind[run], data]
    # even use, over as many equal classes of symbols as the length bears
    classes = np.minimum(np.clip(n // 5, 2, 12), size)
    own = symbol * classes[run] // size[run]
    counts = np.bincount(run * 12 + own, minlength=len(runs) * 12).reshape(-1, 12)
    edges = -(-np.arange(13)[None, :] * size[:, None] // classes[:, None])
    width = np.diff(np.minimum(edges, size[:, None]), axis=1)
    expected = np.maximum(n[:, None] * width / size[:, None], 1e-9)
    chi = np.where(width > 0, (counts - expected) ** 2 / expected, 0).sum(axis=1)
    p1 = _chi_tail(chi, classes - 1.0)
    # runs above and below the middle
    above = symbol * 2 >= size[run]
    up = np.add.reduceat(above, first, dtype=np.int64)
    change = np.concatenate([[False], above[1:] != above[:-1]])
    change[first] = False
    turns = 1 + np.add.reduceat(change, first, dtype=np.int64)
    product = 2.0 * up * (n - up)
    mean = product / n + 1
    variance = np.maximum(product * (product - n) / (n.astype(float) ** 2 * (n - 1)), 1e-9)
    p2 = np.where(product > 0, _erfc(np.abs(turns - mean) / np.sqrt(2 * variance)), 1e-12)
    # serial correlation
    centred = symbol - np.repeat(np.add.reduceat(symbol, first) / n, n)
    lagged = np.concatenate([[0.0], centred[1:] * centred[:-1]])
    lagged[first] = 0
    power = np.add.reduceat(centred**2, first)
    r = np.add.reduceat(lagged, first) / np.maximum(power, 1e-9)
    p3 = np.where(power > 0, _erfc(np.abs(r * n + 1) / np.sqrt(2 * n)), 1e-12)
    log = sum(np.log(np.clip(p, 1e-12, 1)) for p in (p1, p2, p3))
    half = -log  # Fisher's sum is twice this, chi-squared with 6 degrees
    return np.exp(log) * (1 + half + half**2 / 2), letters


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), ordered."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def joined_words(text: str) -> list[bytes]:
    """For each class of length the ordinary words of a text from some place on, joined to that length; classes
    begin at places spread over the text, those that it can't fill are left out."""
    words = WORD.findall(text)
    out = []
    for k, size in enumerate(LENGTH_STEPS):
        at = len(words) * k // CLASSES
        some, length = [], 0
        while at < len(words) and length < size:
            some.append(words[at])
            length += len(words[at])
            at += 1
        if length >= size:
            out.append("".join(some)[:size].encode())
    return out


def _codes(runs: list[bytes], p: np.ndarray) -> np.ndarray:
    """Class of length and step of the p-value, as one number."""
    step = np.minimum((p * STEPS).astype(np.int64), STEPS - 1)
    length = np.searchsorted(LENGTH_STEPS, [len(r) for r in runs], "right") - 1
    return length * STEPS + step


def _find(docs: DataFrame) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            base, runs, owner, places = [], [], [], []
            words, of = [], []
            for row, text in enumerate(texts):
                text = text or ""
                spans = base_spans(text)
                base.append(spans)
                for m in RUN.finditer(text):
                    if not any(a < m.end() and m.start() < b for a, _, b in spans):
                        runs.append(m[0].encode())
                        owner.append(row)
                        places.append(m.span())
                own = joined_words(text)
                words += own
                of += [row] * len(own)
            p, letters = battery(runs)
            code = _codes(runs, p)
            alone = np.flatnonzero(letters)
            q = np.zeros(len(runs))
            some = [runs[k] for k in alone]
            q[alone] = battery(some, _ALONE)[0]
            alike = np.where(letters, q, p)
            own = code.copy()
            own[alone] = _codes(some, q[alone]) + CLASSES * STEPS
            more: list[list] = [[] for _ in texts]
            tested: list[list] = [[] for _ in texts]
            decoys: list[list] = [[] for _ in texts]
            for k, row in enumerate(owner):
                tested[row].append(int(own[k]))
                if letters[k]:
                    decoys[row].append(int(code[k]))
                if alike[k] >= LEAST_P:
                    step = {"length": int(own[k]) // STEPS, "step": int(own[k]) % STEPS}
                    more[row].append({"start": places[k][0], "end": places[k][1], **step})
            for row, c in zip(of, (_codes(words, battery(words, _ALONE)[0]) + CLASSES * STEPS).tolist() if words else []):
                decoys[row].append(c)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([[{"start": a, "kind": k, "end": b} for a, k, b in s] for s in base], _BASE),
                    pa.array(more, _MORE),
                    pa.array(tested, pa.list_(pa.int32())),
                    pa.array(decoys, pa.list_(pa.int32())),
                ],
                ["doc_id", "base", "more", "tested", "decoys"],
            )

    _BASE = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    _MORE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("length", pa.int32()), ("step", pa.int32())]))
    schema = (
        "doc_id long, base array<struct<start int, kind int, end int>>, "
        "more array<struct<start int, end int, length int, step int>>, tested array<int>, decoys array<int>"
    )
    return docs.mapInArrow(find, schema)


def thresholds(tested: np.ndarray, decoys: np.ndarray) -> np.ndarray:
    """Per class the step that a run needs (STEPS: none passes), from counts [class, step] of runs and decoys."""
    out = np.full(len(tested), STEPS)
    pooled = decoys.copy()
    pooled[:CLASSES] = np.cumsum(decoys[:CLASSES], axis=0)  # shorter runs are the harder decoys
    spare = 1 - np.arange(STEPS) / STEPS
    for k in range(len(tested)):
        prior = PRIOR * 0.5 ** (LENGTH_STEPS[k % CLASSES] / HALVING) * spare
        found = tested[k][::-1].cumsum()[::-1]
        false = (pooled[k][::-1].cumsum()[::-1] + prior) / (pooled[k].sum() + PRIOR)
        ok = (found > 0) & (tested[k].sum() * false <= FALSE_SHARE * found)
        ok[: int(LEAST_P * STEPS)] = False
        if ok.any():
            out[k] = int(ok.argmax())
    return out


def secrets(docs: DataFrame, work: Work | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (start, kind, end in code points) of every row.

    A null text is empty: no spans, the digest of the empty string. Ids may be null or repeat; other columns are
    not read. The counts that set the thresholds are of all documents, and bounded: length classes by steps.
    """
    work = work or Work(docs.sparkSession)
    found = work.table(_find(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "secret-spans")
    tested, decoys = (np.zeros((2 * CLASSES, STEPS)) for _ in range(2))
    for name, counts in (("tested", tested), ("decoys", decoys)):
        for row in found.select(F.explode(name).alias("code")).groupBy("code").count().collect():  # classes x steps
            counts[row["code"] // STEPS, row["code"] % STEPS] = row["count"]
    least = thresholds(tested, decoys).tolist()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = [[(s["start"], s["kind"], s["end"]) for s in spans] for spans in batch.column("base").to_pylist()]
            more = [
                [(s["start"], 3, s["end"]) for s in spans if s["step"] >= least[s["length"]]]
                for spans in batch.column("more").to_pylist()
            ]
            count = [[sum(k == kind for _, k, _ in spans) for spans in base] for kind in range(3)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(c, pa.int64()) for c in count),
                    pa.array([hashlib.sha256(written(s).encode()).hexdigest() for s in base]),
                    pa.array([written(sorted(a + b)) for a, b in zip(base, more)]),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return found.mapInArrow(finish, schema)
