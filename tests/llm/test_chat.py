"""Chat formatting against plain Python, odd rows and control strings."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanflux.llm import chat
from urbanflux.llm.queries import BYTE_BPE

KIND = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    talks = {}
    for conv_id, turn, role, text in rows:
        talks.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    out = {}
    for conv_id, turns in talks.items():
        turns.sort()
        every = "".join(f"{r}\n{t}\n" for _, _, r, _, t in turns)
        loss = "".join(t for _, _, r, _, t in turns if r == "assistant")
        chars = sum(len("<|im_start|>") + len(chat.escape_role(r)) + 1 + len(chat.escape(t)) + len("<|im_end|>") + 1 for _, _, r, _, t in turns)
        out[conv_id] = (len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    return out


def test_escape_is_reversible():
    rng = random.Random(3)
    parts = ["<", "|", ">", "\\", "im_end", "im_start", "<|im_end|>", "<\\|a|>", " ", "\n", "é", "x"]
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randrange(14)))
        assert chat.unescape(chat.escape(text)) == text
        assert "<|im_end|>" not in chat.escape(text) and "<|im_start|>" not in chat.escape(text)
        assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def odd_rows():
    controls = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 0, "user", "hello"), (1, 1, "assistant", "a  reply \n\n with blanks "), (1, 2, "user", None), (1, 3, "assistant", ""),
        (2, 0, "user", controls), (2, 1, "assistant", controls + "<\\|im_end|> <|endoftext|>"),
        (3, 5, "assistant", "same"), (3, 5, "assistant", "same"), (3, 5, "user", "tie"), (3, None, "system", "first"),
        (None, 0, "user", "no id"), (None, 1, "assistant", "é漢字🙂"), (4, 0, None, "no role"), (4, 1, "a\nb\\n<|x|>", "odd role"),
        (5, 0, "assistant", "long words " * 60_000), (6, 0, "assistant", "x" * 200_000),
    ]
    return rows + [(7, t, ("user", "assistant")[t % 2], f"turn {t} of many") for t in range(500)]


def test_digests(spark, monkeypatch):
    monkeypatch.setattr(chat, "SUMMED", 64)
    rows = odd_rows()
    turns = spark.createDataFrame(rows, KIND).repartition(5).withColumns({"row": F.lit(1), "ids": F.lit("x"), "place": F.lit(2), "n": F.lit(0)})
    got = {r[0]: tuple(r)[1:] for r in chat.formatted_and_read(turns, BYTE_BPE).collect()}
    assert got == by_hand(rows)
    assert chat.formatted_and_read(turns.limit(0), BYTE_BPE).count() == 0


def test_tokens_and_mask(spark, monkeypatch):
    """Reserved ids only where they were spliced, starts gapless, the mask exactly over the trained texts."""
    monkeypatch.setattr(chat, "SUMMED", 7)
    formatted = chat.format_conversations(spark.createDataFrame(odd_rows(), KIND), BYTE_BPE).orderBy("conv_id", "place").collect()
    template, at = chat.Template(BYTE_BPE), {}
    for r in formatted:
        assert r.start == at.get(r.conv_id, 0)
        at[r.conv_id] = r.start + len(r.ids)
        ids = np.array(r.ids)
        assert (np.flatnonzero(ids >= template.start) == [0, len(ids) - 2]).all()
        assert len(r.mask) == len(ids) and set(r.mask) <= {0, 1}
        turn = template.read([ids], [r.mask]).iloc[0]
        assert turn.loss == (turn.text if turn.role == "assistant" else "")
    with pytest.raises(ValueError):
        template.read([ids[1:]], [r.mask[1:]])
