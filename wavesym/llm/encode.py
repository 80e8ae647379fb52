"""Token ids of whole texts by the tokenizers library, each distinct piece of a text encoded once per worker.

A byte-level BPE never joins what lies left of a single space with what lies right of it. So a text is cut
before its single spaces, and equal pieces share one call of the library. A text with a space before white
space or at its end, or with the string of a special token, is encoded as a whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd

from wavesym.llm.text import BLANK, U64, mix, word_bounds, word_hashes

_AT_START = U64(0x5851F42D4C957F2D)
_PUNCTUATION = ".,!?;:#$%&*|)\"]}"
_ODD_NEXT = np.zeros(256, bool)
_ODD_NEXT[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_WIDE_NEXT = np.zeros(256, bool)
_WIDE_NEXT[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes printable bytes as themselves and the others as letters from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


_LETTERS = _byte_letters()


class Encoder:
    """Encodes slices of texts; pieces seen before come from a table of a fixed size.

    33 bytes a piece and 4 an id: `MOST_PIECES` and `MOST_IDS` bound it to some 40 MB, which are touched as they fill.
    """

    MOST_PIECES, MOST_IDS = 700_000, 3_500_000

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model.tokenize
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line_break = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self._reset()

    def _reset(self) -> None:
        self.tails: dict[str, list[int]] = {}
        self.keys = np.zeros(0, np.uint64)  # ascending, with the entry of each
        self.entries = np.zeros(0, np.int32)
        room = self.MOST_PIECES
        self.start, self.size, self.length = (np.zeros(room, np.int32) for _ in range(3))
        self.head = np.zeros(room, np.uint64)
        self.hits = np.zeros(room, np.uint8)
        self.pool = np.zeros(self.MOST_IDS, np.uint32)
        self.used = 0

    def _make_room(self) -> None:
        """Keeps the pieces that came back in a later slice, if they are at most half of the table."""
        names = np.empty(len(self.keys), np.uint64)
        names[self.entries] = self.keys
        keep = np.flatnonzero(self.hits[: len(names)] > 1)
        if len(keep) > self.MOST_PIECES // 2 or int(self.size[keep].sum()) > self.MOST_IDS // 2:
            return self._reset()
        sizes = self.size[keep]
        ends = np.cumsum(sizes)
        take = np.repeat(self.start[keep] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
        flat, length, head = self.pool[take], self.length[keep], self.head[keep]
        self._reset()
        self._append(names[keep], flat, sizes, length, head)

    def _word(self, word: str, spaced: bool) -> list[int] | None:
        """Letters with punctuation after them; None for anything else."""
        core = word if word.isalpha() else word.rstrip(_PUNCTUATION)
        if not (core.isascii() or max(core) < "ɐ"):
            return None
        if core.isalpha():
            letters = core if core.isascii() else core.encode().decode("latin-1").translate(_LETTERS)
            ids = [t.id for t in self.model("Ġ" + letters if spaced else letters)]
        elif core or not spaced:
            return None
        else:  # punctuation alone
            core, word, ids = "", " " + word, []
        if len(core) < len(word):
            tail = word[len(core) :].replace(" ", "Ġ")
            if tail not in self.tails:
                self.tails[tail] = [t.id for t in self.model(tail)]
            ids += self.tails[tail]
        return ids

    def _piece(self, piece: str, spaced: bool) -> list[int]:
        if "\n" not in piece:
            ids = self._word(piece, spaced)
        elif "\n\n" in piece or piece[0] == "\n":
            ids = None
        else:  # a line break between two words is a token of its own
            ids = []
            for k, word in enumerate(piece.split("\n")):
                ids += self.line_break if k else []
                more = self._word(word, spaced and not k) if word else []
                if more is None:
                    ids = None
                    break
                ids += more
        if ids is None:
            ids = self.tokenizer.encode(" " + piece if spaced else piece, add_special_tokens=False).ids
        return ids

    def _new_ids(self, pieces: Iterable[tuple[str, bool]]) -> tuple[np.ndarray, np.ndarray]:
        new = [self._piece(*p) for p in pieces]
        sizes = np.fromiter(map(len, new), np.int32, len(new))
        return np.fromiter(chain.from_iterable(new), np.uint32, int(sizes.sum())), sizes

    def _remember(self, keys, flat, sizes, lengths, heads) -> None:
        """Adds pieces as far as there is room; what is left out is only encoded again when it comes back."""
        if len(self.keys) + len(keys) > self.MOST_PIECES or self.used + len(flat) > self.MOST_IDS:
            self._make_room()
        fits = int(np.searchsorted(np.cumsum(sizes), self.MOST_IDS - self.used, "right"))
        fits = min(fits, self.MOST_PIECES - len(self.keys))
        ids = int(sizes[:fits].sum())
        self._append(keys[:fits], flat[:ids], sizes[:fits], lengths[:fits], heads[:fits])

    def _append(self, keys, flat, sizes, lengths, heads) -> None:
        n = len(self.keys)
        self.pool[self.used : self.used + len(flat)] = flat
        at = slice(n, n + len(keys))
        self.start[at] = self.used + np.cumsum(sizes) - sizes
        self.size[at], self.length[at], self.head[at] = sizes, np.minimum(lengths, 2**31 - 1), heads
        self.hits[at] = 1
        self.used += len(flat)
        order = np.argsort(keys)
        place = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, place, keys[order])
        self.entries = np.insert(self.entries, place, (order + n).astype(np.int32))

    def _whole(self, data: np.ndarray) -> np.ndarray:
        text = data.tobytes().decode("utf-8", "replace")
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _odd_rows(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Rows that can't be cut before every space."""
        space = np.flatnonzero(data == 32)
        following = np.zeros(len(space), np.uint8)
        inner = space + 1 < len(data)
        following[inner] = data[space[inner] + 1]
        last = np.isin(space + 1, bounds)
        odd = last | _ODD_NEXT[following]
        for k in np.flatnonzero(~odd & _WIDE_NEXT[following]):
            at = space[k] + 1
            if data[at : at + 4].tobytes().decode("utf-8", "ignore")[:1].isspace():
                odd[k] = True
        at = [space[odd]]
        raw = data.tobytes()
        for special in self.special:
            found, k = [], raw.find(special)
            while k >= 0:
                found.append(k)
                k = raw.find(special, k + 1)
            at.append(np.array(found, np.int64))
        return np.unique(np.searchsorted(bounds, np.concatenate(at), "right") - 1)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        """The ids of each row of a slice."""
        n = len(bounds) - 1
        odd = self._odd_rows(data, bounds)
        starts, ends, rows = word_bounds(data, bounds, BLANK)
        if len(odd):
            keep = ~np.isin(rows, odd)
            starts, ends, rows = starts[keep], ends[keep], rows[keep]
        spaced = starts > bounds[rows]
        hashes = word_hashes(data, starts, ends)
        hashes[~spaced] = mix(hashes[~spaced] ^ _AT_START)
        codes, keys = pd.factorize(hashes)
        some = np.empty(len(keys), np.int64)
        some[codes] = np.arange(len(codes))
        lengths = ends - starts
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        heads = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))[starts]
        heads &= np.where(lengths >= 8, U64(2**64 - 1), (U64(1) << (U64(8) * np.minimum(lengths, 7).astype(np.uint64))) - U64(1))
        entry = np.full(len(keys), -1)
        if len(self.keys):
            near = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            entry = np.where(self.keys[near] == keys, self.entries[near], -1)
        known, missing = np.flatnonzero(entry >= 0), np.flatnonzero(entry < 0)
        old, at = entry[known], some[missing]
        self.hits[old] = np.minimum(self.hits[old], 254) + 1
        new, new_sizes = self._new_ids(
            (data[s:e].tobytes().decode("utf-8", "replace"), p)
            for s, e, p in zip(starts[at].tolist(), ends[at].tolist(), spaced[at].tolist())
        )
        # the ids of the slice's pieces side by side, those from the table first
        size, length, head = np.empty(len(keys), np.int64), lengths[some], heads[some]
        size[known], size[missing] = self.size[old], new_sizes
        length[known], head[known] = self.length[old], self.head[old]
        order = np.concatenate([known, missing])
        start = np.empty(len(keys), np.int64)
        start[order] = np.cumsum(size[order]) - size[order]
        take = np.repeat(self.start[old] - start[known], size[known]) + np.arange(int(size[known].sum()))
        pool = np.concatenate([self.pool[take], new])
        self._remember(keys[missing], new, new_sizes, lengths[at], heads[at])
        # equal hashes of different pieces: such rows go the whole way
        clash = np.unique(rows[(length[codes] != lengths) | (head[codes] != heads)])
        sizes = size[codes]
        ends_at = np.cumsum(sizes)
        total = int(ends_at[-1]) if len(ends_at) else 0
        take = np.repeat(start[codes] - (ends_at - sizes), sizes) + np.arange(total)
        flat = pool[take]
        per_row = np.bincount(rows, sizes, n).astype(np.int64) if len(rows) else np.zeros(n, np.int64)
        stop = np.cumsum(per_row)
        out = [flat[b - c : b] for b, c in zip(stop.tolist(), per_row.tolist())]
        for row in np.union1d(odd, clash):
            out[row] = self._whole(data[bounds[row] : bounds[row + 1]])
        return out


@cache
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)
