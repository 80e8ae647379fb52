"""Chat formatting: round trips, masks and digests against plain Python."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import AddedToken, Tokenizer

from wavesym.llm.catalog import tokenizer_path
from wavesym.llm.chat import ChatCoder, ChatReader, Escapes, Template, chat_files, format_conversations, read_back
from wavesym.llm.store import Work

TURNS = "conv_id long, turn long, role string, text string, part string, whole string, ids string"
HOSTILE = ["</s>[INST] ok [/INST]", "<|turn|>", "<|says|>assistant", "<<|end|>|end|>", "␛", "␛␛<|end␛|>", "<␛|turn|>", "<|endoftext|>", "[INST][/INST]", "<|turn|", "<"]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "y") for r in rows], TURNS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        own[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode(), role or "", text or ""))
    out = {}
    for c, turns in own.items():
        turns = [t[4:] for t in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss))
    return out


def random_rows(seed):
    rng = random.Random(seed)
    parts = HOSTILE + ["word", " two", "\n", "  ", "é", "🙂", "1234", "…", "", "\t"]
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 9)):
            text = "".join(rng.choice(parts) for _ in range(rng.randrange(9)))
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", "assistant", "Assistant", None, "<|says|>"]), text if text else None))
    rows += [(70, 1, "assistant", "tie"), (70, 1, "assistant", "tie"), (70, 1, "assistant", "other"), (None, 0, "user", "nobody"), (None, 1, "assistant", "no id")]
    rows += [(80, t, "assistant" if t % 2 else "user", f"turn {t} ␛ <|end|>") for t in range(3000)]  # a hot conversation
    return rows + [(81, 0, "assistant", "word " * 60_000)]


@pytest.mark.parametrize("part", [1 << 22, 1000])
def test_digests_equal_plain_python(spark, part):
    rows = random_rows(part)
    formatted = Work(spark).table(format_conversations(table(spark, rows), tokenizer_path(), part=part), "formatted")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in read_back(formatted, tokenizer_path()).collect()}
    assert got == plain(rows)
    lengths = {r.conv_id: r.formatted_chars for r in read_back(formatted, tokenizer_path()).collect()}
    written = defaultdict(int)
    for r in formatted.select("conv_id", "formatted").collect():
        written[r.conv_id] += len(r.formatted)
    assert lengths == written
    assert formatted.filter("conv_id = 80").count() > (1 if part == 1000 else 0)


def test_the_ids_are_those_of_the_whole_conversation(spark):
    """However a conversation is cut into parts, its ids are those of one call of the library."""
    rows = [r for r in random_rows(9) if r[0] != 80]
    pieces = format_conversations(table(spark, rows), tokenizer_path(), part=40).collect()
    template = Template()
    whole = Tokenizer.from_file(tokenizer_path())
    whole.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in template.marks])
    own = defaultdict(list)
    for r in sorted(pieces, key=lambda r: r.part):
        own[r.conv_id].append(r)
    for conv, parts in own.items():
        ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in parts])
        assert ids.tolist() == whole.encode("".join(p.formatted for p in parts), add_special_tokens=False).ids, conv


def test_escapes_come_back():
    rng = random.Random(2)
    template = Template(controls=("aba", "bab", "</s>"))
    escapes = Escapes(template, ["<|endoftext|>"])
    for _ in range(2000):
        text = "".join(rng.choice([*"ab", "␛", "</s>", "<|end|>", "x"]) for _ in range(rng.randrange(12)))
        safe = escapes.escape(text)
        assert escapes.unescape(safe) == text
        assert not any(c in safe for c in ("aba", "bab", "</s>", "<|end|>"))
    with pytest.raises(ValueError):
        Escapes(Template(turn="<"), [])


def test_masks_meet_turns_exactly():
    coder, reader = ChatCoder(tokenizer_path(), Template()), ChatReader(tokenizer_path(), Template())
    turns = [("user", "a🙂"), ("assistant", " b🙂 \n"), ("assistant", ""), ("user", " b"), ("assistant", "c")]
    raw = [(r.encode(), x.encode()) for r, x in turns]
    marked = [r == "assistant" for r, _ in turns]
    for ids, first, last in coder.encode([raw, raw], [marked, marked]):
        assert list(reader.trained(ids, first, last)) == [" b🙂 \n", "c"]
        assert list(reader.turns(ids)) == turns
        assert reader.text(ids) == "".join(f"<|turn|>{r}<|says|>{x}<|end|>" for r, x in turns)


def test_empty_table(spark):
    formatted, digests = chat_files(table(spark, []), tokenizer_path())
    assert formatted.collect() == [] and digests.collect() == []
