"""Formatted text read back, against hashes of the turns."""

import hashlib
import random

import pyarrow as pa
import pytest

from tunewright.llm import chat

TEXTS = ["", None, "hello", "<|im_end|>", "<|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|", "<|<|\\|", "a\nb\r\n", "Ünï 漢字 🙂", "<", "|", "\\", "x" * 5000]


def rows(seed=1):
    rng = random.Random(seed)
    out = [(c, t, rng.choice(("user", "assistant", "system", None, "a\\n<|b\nc")), rng.choice(TEXTS)) for c in range(20) for t in range(rng.randrange(1, 9))]
    out += [(None, 1, "assistant", "no id"), (None, 0, "user", "none"), (3, None, "assistant", "no turn"), out[0], out[0]]
    out += [(77, t, "assistant" if t % 2 else "user", f"turn {t} <|im_end|>") for t in range(700)]
    rng.shuffle(out)
    return out


def plain(turns):
    order = lambda x: (x is not None, x if x is not None else 0)
    by = {}
    for c, t, r, x in turns:
        by.setdefault(c, []).append((order(t), (r is not None, (r or "").encode()), (x is not None, (x or "").encode())))
    out = {}
    for c, mine in by.items():
        mine = [(r.decode(), x.decode()) for _, (_, r), (_, x) in sorted(mine)]
        loss = "".join(x for r, x in mine if r == "assistant")
        out[c] = (len(mine), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in mine).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("batch", [10000, 3])
def test_round_trip(spark, batch):
    data = rows()
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS segment", "'y' AS mask")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)  # 3: conversations lie in many batches
    try:
        got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(chat.formatted(frame, 3)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == plain(data)


def test_text_and_mask(spark):
    frame = spark.createDataFrame([(1, 0, "user", "<|im_end|>"), (1, 1, "assistant", "é<|x")], "conv_id long, turn long, role string, text string")
    row = chat.formatted(frame).first()
    assert row.text == "<|im_start|>user\n<\\|im_end|><|im_end|>\n<|im_start|>assistant\né<\\|x<|im_end|>\n"
    data = row.text.encode()
    assert [data[m.start:m.start + m.length].decode() for m in row.mask] == ["é<\\|x"]


@pytest.mark.parametrize("text", [t for t in TEXTS if t is not None])
def test_escapes_are_reversible(text):
    escaped = chat.escaped(pa.array([text]))[0].as_py()
    assert "<|" not in escaped and chat.unescaped(escaped) == text
    assert chat.unescaped_role(chat.escaped_role(pa.array([text]))[0].as_py()) == text


def test_empty(spark):
    assert chat.digests(chat.formatted(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
