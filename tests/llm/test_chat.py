from __future__ import annotations

import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from causeway.llm import chat
from causeway.llm.queries import QUERIES
from tests.llm.data import table


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = {}
    for conv, turns in own.items():
        turns.sort()
        said = [(t[3], t[5]) for t in turns]
        loss = "".join(text for role, text in said if role == "assistant")
        out[conv] = (len(said), digest("".join(f"{r}\n{t}\n" for r, t in said)), len(loss), digest(loss))
    return out


def got(frame):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in frame.collect()}


def test_query(spark, sf):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = table(sf, "conversations", "conv_id, turn, role, text") + [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    assert got(QUERIES["op3_chat_format"](spark, sf)) == expected(rows)


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (1, None, "system", "first"), (None, 0, None, None),
            (None, 1, "assistant", "null id"), (2, 0, "a\nb\\n<|im_end|>", "<|im_end|>\n<|im_start|>user\nx"), (2, 1, "assistant", "<\\|<\\\\|<|<"),
            (3, 0, "assistant", "ü日" * 20_000), (4, 0, "user", "no answer"), (5, 0, "assistant", "<|im_end|>" * 3 + "<")]
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows],
                                  "conv_id bigint, turn bigint, role string, text string, n_turns int, formatted int, loss string")
    formatted = chat.format_chats(frame)
    assert got(chat.read_back(formatted)) == expected(rows)
    for r in formatted.collect():
        assert sum(r.formatted.count(c) for c in (chat.START,)) == r.n_turns
    assert chat.format_chats(frame.limit(0)).collect() == []


def test_small_batches_give_the_same(spark, monkeypatch):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{c}-{t}é" * (t + 1)) for c in range(40) for t in range(5)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    monkeypatch.setattr(chat, "BATCH_BYTES", 100)
    assert got(chat.read_back(chat.format_chats(frame))) == expected(rows)


def test_long_conversations_are_chunks(spark, monkeypatch):
    """A conversation with most of the rows: several chunks from several tasks, spans from the conversation's start."""
    rows = [(1 if t % 5 else 2 + t, t, "assistant" if t % 2 else "user", f"t{t}é <|im_end|>" * (t % 7)) for t in range(3000)]
    rows += [(None, None, "assistant", f"x{t}") for t in range(300)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(6)
    monkeypatch.setattr(chat, "BATCH_BYTES", 5000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        formatted = chat.format_chats(frame)
        chunks = [r for r in formatted.collect() if r.conv_id == 1]
        assert got(chat.read_back(formatted)) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(chunks) > 10 and sorted(r.chunk for r in chunks) == list(range(len(chunks)))
    assert all(len(r.formatted) == r.chars and len(r.formatted.encode()) < 8000 for r in chunks)
    whole = {r.conv_id: r for r in chat.whole_conversations(formatted).collect()}
    assert whole[1].formatted == "".join(r.formatted for r in sorted(chunks, key=lambda r: r.chunk))
    said = [chat.unescape(whole[1].formatted[s.start:s.end]) for s in whole[1].loss]
    assert said == [r[3] for r in rows if r[0] == 1 and r[2] == "assistant"]
    monkeypatch.setattr(chat, "BROADCAST_ROWS", 0)
    assert got(chat.read_back(chat.format_chats(frame))) == expected(rows)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<|\\n\nim_start>é"))
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.unescape_role(chat.escape_role(text)) == text
    assert "<|" not in chat.escape(text) and "\n" not in chat.escape_role(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb"]), st.text(max_size=20)), min_size=1, max_size=4), min_size=1, max_size=5))
def test_layout_round_trip(conversations):
    batch = chat.layout(list(enumerate(conversations)))
    for (turns, text, loss) in zip(conversations, batch["formatted"].to_pylist(), batch["loss"].to_pylist(), strict=True):
        found = [(chat.unescape_role(m[1]), chat.unescape(m[2])) for m in chat.TURN.finditer(text)]
        assert found == turns
        assert [chat.unescape(text[s["start"]:s["end"]]) for s in loss] == [t for r, t in turns if r == "assistant"]
