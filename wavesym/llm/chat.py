"""Conversations as token ids with a loss mask that follows the text by its offsets.

Every conversation is rendered whole by a template, encoded once with offsets, and the sorted spans of its trained
turns are intersected with the sorted spans of its tokens by binary search. The template's marks are tokens of
their own, so no token reaches over the edge of a turn. Marks and special tokens that occur inside a text are
escaped and come back on reading.

Rows are dealt out by ranges of (conversation, turn). A conversation of more than `part` characters, or one that
ranges cut, has several parts, cut between turns; as no token reaches over a mark, its parts have the ids that the
whole would have.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavesym.llm.encode import encoder
from wavesym.llm.store import Work

FORMATTED = "conv_id long, part long, whole boolean, formatted string, ids binary, loss_starts array<int>, loss_ends array<int>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


@dataclass(frozen=True)
class Template:
    """turn + role + says + text + end for each turn; `controls` are more strings that no text may hold."""

    turn: str = "<|turn|>"
    says: str = "<|says|>"
    end: str = "<|end|>"
    controls: tuple[str, ...] = ("</s>", "<s>", "[INST]", "[/INST]")
    escape: str = "␛"
    trained: tuple[str, ...] = ("assistant",)

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.turn, self.says, self.end


class Escapes:
    """The escape goes after the first character of a control string; an escape in the text is doubled."""

    def __init__(self, template: Template, special: list[str]):
        strings = sorted({*template.marks, *template.controls, *special})
        if any(len(s) < 2 or template.escape in s for s in strings):
            raise ValueError("control strings have two characters at least and no escape")
        self.mark = template.escape
        self.found = re.compile("(?=" + "|".join(map(re.escape, strings)) + ")(.)", re.DOTALL)
        self.back = re.compile(re.escape(self.mark) + "(.?)", re.DOTALL)

    def escape(self, text: str) -> str:
        if self.mark in text:
            text = text.replace(self.mark, 2 * self.mark)
        return self.found.sub(r"\1" + self.mark, text)

    def unescape(self, text: str) -> str:
        return self.back.sub(r"\1", text) if self.mark in text else text


class ChatCoder:
    """Encodes rendered conversations; the template's marks are tokens of their own, after those of the vocabulary.

    A mark ends what the byte-level BPE joins, so what lies between the marks is encoded piece by piece, for many
    conversations at once. A token stands for the same bytes wherever it is: its widths give the offsets.
    """

    def __init__(self, path: str, template: Template):
        self.template = template
        self.encoder = encoder(path)
        tokenizer = self.encoder.tokenizer
        added = {k: t.content.encode() for k, t in tokenizer.get_added_tokens_decoder().items()}
        self.escapes = Escapes(template, [x.decode() for x in added.values()])
        values, size = _byte_values(), tokenizer.get_vocab_size(with_added_tokens=True)
        letters = {k: w for w, k in tokenizer.get_vocab(with_added_tokens=True).items()}
        self.bytes = [added.get(k) or bytes(values[c] for c in letters[k]) for k in range(size)]
        self.marks = list(range(size, size + 3))
        self.bytes += [m.encode() for m in template.marks]
        self.widths = np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))

    def encode(self, turns: list[list[tuple[bytes, bytes]]], trained: list[list[bool]]) -> Iterator[tuple]:
        """ids, first and end token of each trained text that is not empty; for each conversation of escaped
        (role, text)."""
        pieces = [x for conversation in turns for turn in conversation for x in turn]
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))])
        coded = self.encoder.encode(np.frombuffer(b"".join(pieces), np.uint8), bounds)
        turn, says, end = (np.array([m], np.uint32) for m in self.marks)
        a, b, c = (int(self.widths[m]) for m in self.marks)
        at = 0
        for conversation, marked in zip(turns, trained):
            parts = [x for k in range(at, at + 2 * len(conversation), 2) for x in (turn, coded[k], says, coded[k + 1], end)]
            at += 2 * len(conversation)
            ids = np.concatenate(parts)
            stops = np.cumsum(self.widths[ids])  # token k is bytes [stops[k - 1], stops[k])
            sizes = np.array([(len(r), len(x)) for r, x in conversation], np.int64)
            whole = sizes.sum(axis=1) + a + b + c
            begins = np.cumsum(whole) - whole + a + sizes[:, 0] + b
            own = np.array(marked) & (sizes[:, 1] > 0)
            first = np.searchsorted(stops, begins[own], "right")  # the first token that ends after the span begins
            last = np.searchsorted(stops, (begins + sizes[:, 1])[own], "left") + 1
            yield ids, first, last


def _byte_values() -> dict[str, int]:
    """The letter that byte-level BPE writes for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ChatReader:
    """Turns, trained text and length of a part, from its ids and mask alone."""

    def __init__(self, path: str, template: Template):
        coder = ChatCoder(path, template)
        self.escapes, self.marks, self.bytes = coder.escapes, coder.marks, coder.bytes

    def text(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode()

    def turns(self, ids: np.ndarray) -> Iterator[tuple[str, str]]:
        turn, says, end = (np.flatnonzero(ids == m) for m in self.marks)
        for a, b, c in zip(turn.tolist(), says.tolist(), end.tolist()):
            yield self.escapes.unescape(self.text(ids[a + 1 : b])), self.escapes.unescape(self.text(ids[b + 1 : c]))

    def trained(self, ids: np.ndarray, starts: list[int], ends: list[int]) -> Iterator[str]:
        for a, b in zip(starts, ends):
            yield self.escapes.unescape(self.text(ids[a:b]))


def format_conversations(
    conversations: DataFrame, tokenizer: str, template: Template = Template(), part: int = 1 << 22, together: int = 1 << 20
) -> DataFrame:
    """conv_id, part, whole, formatted, ids (little-endian u32), loss_starts and loss_ends (runs of tokens).

    Turns are in the order of `turn`, null first; turns of one number by role, then by text, repeated rows side by
    side. Null roles and texts are empty. Rows without conv_id are one conversation of their own. A conversation
    has one row, or several with ascending `part`; `whole` says that the row is all of it. Conversations of some
    `together` bytes are encoded at once. Other columns are not read; an empty table gives no row. Only the roles in `template.trained`, spelt exactly so, are under the mask.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    # the first characters of the text order as the text does
    ranged = rows.repartitionByRange(*order, F.substring("text", 1, 64))
    ordered = ranged.sortWithinPartitions(*order, "text")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ChatCoder(tokenizer, template)
        escape = coder.escapes.escape
        number = TaskContext.get().partitionId() << 32
        # conversations that wait to be encoded, the last of them open
        names: list[int | None] = []
        wholes: list[bool] = []
        turns: list[list[tuple[bytes, bytes]]] = []
        trained: list[list[bool]] = []
        edge, length, waiting = True, 0, 0  # edge: the conversation may have begun in the task before

        def rows() -> pa.RecordBatch:
            nonlocal number
            texts, ids, starts, ends = [], [], [], []
            turn, says, end = (m.encode() for m in template.marks)
            for conversation, (coded, first, last) in zip(turns, coder.encode(turns, trained)):
                texts.append(b"".join(x for r, t in conversation for x in (turn, r, says, t, end)).decode())
                ids.append(coded.astype("<u4").tobytes())
                starts.append(first.tolist())
                ends.append(last.tolist())
            numbers = list(range(number, number + len(names)))
            number += len(names)
            runs = pa.list_(pa.int32())
            columns = [pa.array(names, pa.int64()), pa.array(numbers), pa.array(wholes), pa.array(texts)]
            columns += [pa.array(ids, pa.binary()), pa.array(starts, runs), pa.array(ends, runs)]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in FORMATTED.split(", ")])

        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if not names or conv != names[-1] or length > part:
                    more = bool(names) and conv == names[-1]
                    if names:
                        wholes.append(not edge and not more)
                        edge = more
                    if waiting > together:
                        yield rows()
                        names, wholes, turns, trained, waiting = [], [], [], [], 0
                    names.append(conv)
                    turns.append([])
                    trained.append([])
                    length = 0
                turn = escape(role).encode(), escape(text).encode()
                turns[-1].append(turn)
                trained[-1].append(role in template.trained)
                length += len(text) + len(role)
                waiting += len(turn[0]) + len(turn[1])
        if names:
            wholes.append(False)  # it may go on in the next task
            yield rows()

    return ordered.mapInArrow(render, FORMATTED)


def read_back(formatted: DataFrame, tokenizer: str, template: Template = Template()) -> DataFrame:
    """Counts and digests of each conversation, decoded from its ids and mask.

    turns_sha256: of role, line break, text, line break of every turn; loss_sha256: of all text under the mask.
    Whole rows are read where they lie; only conversations of several parts meet in a task, part by part.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = ChatReader(tokenizer, template)
        state: list | None = None
        out: list[tuple] = []

        def close() -> None:
            if state is not None:
                conv, n, turns, chars, loss, length = state
                out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), length))

        def rows() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [c.split()[0] for c in DIGESTS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "ids", "loss_starts", "loss_ends"))
            for conv, raw, starts, ends in zip(*columns):
                if state is None or state[0] != conv:
                    close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = np.frombuffer(raw, "<u4")
                for role, text in reader.turns(ids):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                for text in reader.trained(ids, starts, ends):
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(reader.text(ids))
            if out:
                yield rows()
                out = []
        close()
        if out:
            yield rows()

    needed = formatted.select("conv_id", "part", "whole", "ids", "loss_starts", "loss_ends")
    whole = needed.filter("whole").mapInArrow(read, DIGESTS)
    parts = needed.filter("not whole").repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part")
    return whole.union(parts.mapInArrow(read, DIGESTS))


def chat_files(
    conversations: DataFrame, tokenizer: str, template: Template = Template(), work: Work | None = None
) -> tuple[DataFrame, DataFrame]:
    """(formatted, digests): the formatted conversations, written to the shared folder, and what reading gives."""
    work = work or Work(conversations.sparkSession)
    formatted = work.table(format_conversations(conversations, tokenizer, template), "formatted", "zstd")
    return formatted, read_back(formatted, tokenizer, template)
