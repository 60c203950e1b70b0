"""Chat formatting: turns of a conversation as one text with loss spans.

    <|im_start|>role\\n text <|im_end|>\\n        (per turn, without the blanks)

Control strings inside roles and texts are escaped reversibly: ``<|`` becomes ``<\\|``, and every
``<\\\\...|`` gains one backslash. A role's backslashes and newlines are written ``\\\\`` and ``\\n``.

Formatting is columnar: lengths of all segments of a batch, cumulative offsets, and one
preallocated buffer into which headers and contents are scattered; it becomes the Arrow column
without another copy.

A conversation is one or more chunk rows of bounded size. Rows are ranged by conversation and turn, so a very long
one is laid out by many tasks; how many characters come before a chunk is a prefix sum over chunks, and only
chunks of conversations that have several are moved by it. Readers take one chunk after the other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from causeway.llm.common import stored
from causeway.session import cut_lineage

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
BATCH_BYTES = 8 << 20  # turns are laid out together until they hold so much; also the size of a chunk
BROADCAST_ROWS = 100_000  # chunks of several up to which their offsets are broadcast: a few MB

LOSS = "array<struct<start:bigint,end:bigint>>"
FORMATTED = f"conv_id bigint, n_turns bigint, formatted string, loss {LOSS}, chars bigint"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text) if "|" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def gather(starts, lengths):
    """Positions ``starts[i] .. starts[i] + lengths[i]`` of all segments, one after the other."""
    import numpy as np

    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def layout(conversations: list[tuple[int | None, list[tuple[str, str]]]]):
    """Record batch of ``FORMATTED`` for runs of turns (id, [(role, text)]); spans count from the run's start."""
    import numpy as np
    import pyarrow as pa

    turns = [t for _, own in conversations for t in own]
    n_turns = np.asarray([len(own) for _, own in conversations], np.int64)
    trained = np.asarray([role == TRAINED_ROLE for role, _ in turns], bool)
    texts = [escape(text) for _, text in turns]
    kinds: dict[str, int] = {}
    kind = np.asarray([kinds.setdefault(role, len(kinds)) for role, _ in turns], np.int64)
    headers = [START + escape_role(role) + "\n" for role in kinds]
    footer = (END + "\n").encode()

    def packed(parts: list[str]):
        """The parts' bytes in one array, where each begins and how many bytes it has."""
        raw = [p.encode() for p in parts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        return np.frombuffer(b"".join(raw), np.uint8), np.cumsum(sizes) - sizes, sizes

    head_bytes, head_at, head_size = packed(headers)
    text_bytes, text_at, text_size = packed(texts)
    # three segments a turn: header, content, footer
    sizes = np.empty((len(turns), 3), np.int64)
    sizes[:, 0], sizes[:, 1], sizes[:, 2] = head_size[kind], text_size, len(footer)
    ends = np.cumsum(sizes.ravel())
    starts = (ends - sizes.ravel()).reshape(-1, 3)
    out = np.empty(int(ends[-1]) if len(turns) else 0, np.uint8)
    out[gather(starts[:, 0], sizes[:, 0])] = head_bytes[gather(head_at[kind], sizes[:, 0])]
    out[gather(starts[:, 1], sizes[:, 1])] = text_bytes[gather(text_at, text_size)]
    out[gather(starts[:, 2], sizes[:, 2])] = np.tile(np.frombuffer(footer, np.uint8), len(turns))
    # a conversation's text runs from its first turn to the next conversation's
    bounds = np.zeros(len(conversations) + 1, np.int64)
    turn_end = np.concatenate([[0], np.cumsum(n_turns)])
    bounds[1:] = np.concatenate([[0], ends[2::3]])[turn_end[1:]]
    formatted = pa.Array.from_buffers(pa.large_string(), len(conversations), [None, pa.py_buffer(bounds), pa.py_buffer(out)])
    # loss spans in code points from the conversation's start
    chars = np.empty((len(turns), 3), np.int64)
    chars[:, 0] = np.fromiter(map(len, headers), np.int64, len(headers))[kind]
    chars[:, 1] = np.fromiter(map(len, texts), np.int64, len(texts))
    chars[:, 2] = len(footer)
    char_end = np.cumsum(chars.ravel())
    conversation = np.repeat(np.arange(len(conversations)), n_turns)
    char_start = (char_end - chars.ravel()).reshape(-1, 3)
    base = np.concatenate([[0], char_end[2::3]])[turn_end[:-1]][conversation]
    first, last = (char_start[:, 1] - base)[trained], (char_start[:, 1] + chars[:, 1] - base)[trained]
    spans = pa.StructArray.from_arrays([pa.array(first), pa.array(last)], ["start", "end"])
    of = np.concatenate([[0], np.cumsum(np.bincount(conversation[trained], minlength=len(conversations)))])
    turn_chars = np.concatenate([[0], char_end[2::3]])[turn_end]
    return pa.RecordBatch.from_arrays([
        pa.array([c for c, _ in conversations], pa.int64()), pa.array(n_turns), formatted.cast(pa.string())
        if len(out) < 1 << 31 else formatted, pa.ListArray.from_arrays(pa.array(of, pa.int32()), spans), pa.array(np.diff(turn_chars)),
    ], ["conv_id", "n_turns", "formatted", "loss", "chars"])


def format_chats(conversations: DataFrame) -> DataFrame:
    """Chunk rows (conv_id, chunk, n_turns, formatted, loss, chars) whose texts, by ``chunk`` from 0, are the conversation.

    ``loss`` are code-point spans [start, end) from the conversation's start, ``chars`` the chunk's length.
    Rows go by turn, nulls first; ties by role, then text, so repeated rows stand side by side and each
    counts. Null texts and roles are empty strings; rows with a null conv_id form one conversation.
    Texts may be empty or long: a chunk has ``BATCH_BYTES`` or ends with the turn that reaches them, so
    no task holds a whole long conversation. Other columns are not read. An empty table gives no rows.
    """
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0

        def rows() -> Iterator[tuple]:
            for batch in batches:
                texts = batch["text"]
                for i, (conv, role) in enumerate(zip(batch["conv_id"].to_pylist(), batch["role"].to_pylist(), strict=True)):
                    yield conv, role, texts[i].as_py()

        def laid():
            nonlocal made
            batch = layout(ready)
            numbers = [pa.array([part] * batch.num_rows, pa.int32()), pa.array(range(made, made + batch.num_rows), pa.int64())]
            made += batch.num_rows
            return pa.RecordBatch.from_arrays([*batch.columns, *numbers], [*batch.schema.names, "_part", "_seq"])

        ready: list = []
        held = 0
        for conv, role, text in rows():
            if held >= BATCH_BYTES:
                yield laid()
                ready, held = [], 0
            if not ready or conv != ready[-1][0]:
                ready.append((conv, []))
            ready[-1][1].append((role or "", text or ""))
            held += 3 * len(text or "") + 64
        if ready:
            yield laid()

    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
    # the first characters of a text keep the order of whole texts, and range bounds small
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 16))
    placed = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
    chunks = stored(placed.mapInArrow(run, FORMATTED + ", _part int, _seq bigint"), "chat-chunks")
    each = Window.partitionBy("conv_id")
    order = each.orderBy("_part", "_seq")  # chunk rows of one conversation, without their texts
    facts = chunks.select("conv_id", "_part", "_seq", "chars").withColumns({
        "_n": F.count(F.lit(1)).over(each), "_chunk": (F.row_number().over(order) - 1).cast("int"), "_before": F.sum("chars").over(order) - F.col("chars")})
    several = cut_lineage(facts.filter("_n > 1").select("_part", "_seq", "_chunk", "_before"))
    few = several.count() <= BROADCAST_ROWS
    joined = chunks.join(F.broadcast(several) if few else several, ["_part", "_seq"], "left")
    before = F.coalesce("_before", F.lit(0))
    moved = F.transform("loss", lambda s: F.struct((s["start"] + before).alias("start"), (s["end"] + before).alias("end")))
    return joined.select("conv_id", F.coalesce("_chunk", F.lit(0)).alias("chunk"), "n_turns", "formatted", moved.alias("loss"), "chars")


def whole_conversations(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, formatted, loss): chunks put together, for conversations that fit a string."""
    parts = formatted.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"), F.array_sort(F.collect_list(F.struct("chunk", "formatted", "loss"))).alias("_c"))
    return parts.select("conv_id", "n_turns", F.array_join(F.col("_c.formatted"), "").alias("formatted"), F.flatten("_c.loss").alias("loss"))


TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse formatted conversations: turn count, digest of all turns, digest of the text under the loss mask.

    Digests go on from chunk to chunk, one of which is held at a time.
    """
    def run(batches):
        import hashlib

        import pyarrow as pa

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        now, done = None, []

        def finished():
            conv, turns, masked, count, chars, size = now
            return conv, count, turns.hexdigest(), chars, masked.hexdigest(), size

        def batch_of(rows):
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for i, (conv, chunk) in enumerate(zip(batch["conv_id"].to_pylist(), batch["chunk"].to_pylist(), strict=True)):
                if chunk == 0:
                    if now is not None:
                        done.append(finished())
                    now = [conv, hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                text, loss = batch["formatted"][i].as_py(), batch["loss"][i].as_py()
                at = 0
                for m in TURN.finditer(text):
                    if m.start() != at:
                        raise ValueError(f"conversation {conv} doesn't parse at {now[5] + at}")
                    now[1].update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
                    at = m.end()
                    now[3] += 1
                if at != len(text):
                    raise ValueError(f"conversation {conv} doesn't parse at {now[5] + at}")
                for span in loss:
                    own = unescape(text[span["start"] - now[5]:span["end"] - now[5]])
                    now[2].update(own.encode())
                    now[4] += len(own)
                now[5] += len(text)
            yield batch_of(done)
            done = []
        if now is not None:
            yield batch_of([finished()])

    rows = formatted.select("conv_id", "chunk", "formatted", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return rows.mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
