"""Chat formatting: turn-aligned windows under a token budget, with a loss mask.

A turn reads ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a line break.  Inside
roles and texts every ``<``, then backslashes, then ``|`` gets one more backslash, so no text can
form a control string and the escape is undone exactly; line breaks in roles become ``\\n``.

Windows: with ``P`` the prefix sums of turn tokens, a window takes the longest run of new turns
whose difference in ``P`` fits what the budget leaves, at least one turn.  Before them it repeats
the system turn (the first turn, if its role is ``system``) and the last turns before the run, as
far as ``history`` tokens and ``history_turns`` allow.  Repeated turns carry no loss: the mask covers
each assistant text once over all windows.  A single turn above the budget stays whole and is marked
``over_budget``.

At scale: turns are numbered per block of turn values and shifted by the sizes of earlier blocks.
A conversation is cut into chunks of ``CHUNK`` turns, the unit of the shuffle; a chunk also gets the
system turn and the tail of the chunk before.  So a conversation of any length spreads over tasks.

NULL roles and texts are empty.  Turns are ordered by turn, then role, then text; a NULL turn comes
first, and repeated rows stay repeated.  NULL conversation ids form one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.common import map_texts

START, END = "<|im_start|>", "<|im_end|>"
CHUNK = 2048
TURN_BLOCK = 4096  # turn values per numbering block
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.DOTALL)


def format_turn(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the escaped text of a turn, the escaped text, and what stands behind it."""
    return f"{START}{escape_role(role)}\n", escape(text), f"{END}\n"


def parse(window: str) -> list[tuple[str, str, int, int]]:
    """Role, text and the place of the escaped text of every turn of a window."""
    turns, at = [], 0
    while at < len(window):
        if not window.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        line = window.index("\n", at)
        end = window.index(END, line)
        turns.append(
            (unescape_role(window[at + len(START) : line]), unescape(window[line + 1 : end]), line + 1, end)
        )
        at = end + len(END) + 1
    return turns


def plan(tokens: np.ndarray, first: int, system: int, budget: int, history: int, history_turns: int):
    """Turn spans of one chunk: ``(history start, new start, new end, tokens)`` per window.

    ``tokens`` are those of consecutive turns, of which the first ``first`` came in earlier
    windows; ``system`` counts the tokens of the retained turn.
    """
    prefix = np.r_[0, np.cumsum(tokens)]
    start, total = first, len(tokens)
    while start < total:
        back = int(np.searchsorted(prefix, prefix[start] - history))
        back = max(back, start - history_turns, 0)
        kept = prefix[start] - prefix[back]
        if system + kept + tokens[start] > budget:  # the new turn matters more than the past
            back, kept = start, 0
        room = budget - system - kept
        end = int(np.searchsorted(prefix, prefix[start] + room, side="right")) - 1
        end = max(end, start + 1)
        yield back, start, end, int(system + kept + prefix[end] - prefix[start])
        start = end


def token_counter(path: str | None):
    """A function from texts to token counts: a tokenizer file, or a quarter of the bytes."""
    if path is None:
        return lambda texts: [-(-len((t or "").encode()) // 4) for t in texts]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(path)
    return lambda texts: [
        len(e) for e in encoder.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
    ]


def numbered_turns(turns: DataFrame) -> DataFrame:
    """Adds ``pos``, the 0-based place of each row in its conversation, and ``size``, its turns."""
    order = ["turn", "role", "text"]
    blocked = turns.withColumn("_block", F.coalesce(F.floor(F.col("turn") / TURN_BLOCK), F.lit(-(1 << 60))))
    by_block = Window.partitionBy("conv_id").orderBy("_block")
    starts = (
        blocked.groupBy("conv_id", "_block").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("size", F.sum("_n").over(Window.partitionBy("conv_id")))
        .withColumnRenamed("conv_id", "_conv").withColumnRenamed("_block", "_b")
    )
    inside = F.row_number().over(Window.partitionBy("conv_id", "_block").orderBy(*order)) - 1
    return (
        blocked.withColumn("_inside", inside)
        .join(starts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_block") == F.col("_b")))
        .select("conv_id", *order, (F.col("_before") + F.col("_inside")).alias("pos"), "size")
    )


def format_windows(
    conversations: DataFrame, tokenizer_path: str | None = None, budget: int = 1024,
    history: int = 192, history_turns: int = 4, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per window: ``conv_id``, ``start`` (place of the first new turn), ``n_turns`` (new),
    ``n_repeated``, ``text``, ``loss`` (array of start and end), ``n_tokens`` and ``over_budget``."""
    turns = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    conv_type = turns.schema["conv_id"].dataType.simpleString()
    placed = numbered_turns(turns)
    chunk = F.floor(F.col("pos") / CHUNK)
    last = F.floor((F.col("size") - 1) / CHUNK)
    is_system = (F.col("pos") == 0) & (F.col("role") == "system")
    is_tail = (F.col("pos") % CHUNK >= CHUNK - history_turns) & (chunk < last)
    chunks = (
        F.when(is_system, F.sequence(F.lit(0).cast("long"), last))
        .when(is_tail, F.array(chunk, chunk + 1))
        .otherwise(F.array(chunk))
    )
    dealt = placed.select("conv_id", F.explode(chunks).alias("chunk"), "pos", "role", "text")

    def setup():
        count = token_counter(tokenizer_path)

        def work(turns):
            # A turn ends in a line break, which no token spans: those of a window are those of its turns.
            cut = [turn.partition(":") for turn in turns]
            return [count(["".join(format_turn(rest[: int(n)], rest[int(n) :])) for n, _, rest in cut])]

        return work

    both = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    counted = map_texts(
        dealt.withColumn("_counted", both), setup, "tokens long",
        ["conv_id", "chunk", "pos", "role", "text"], "_counted",
    )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.null()

        def rows():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield from zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True)

        def cut(turns):
            """Windows of one chunk; ``turns`` are its rows by place."""
            conv, chunk = turns[0][0], turns[0][1]
            system = []
            if turns[0][2] == 0 and turns[0][3] == "system":
                system = turns[:1]
                turns = turns[1:]
            first = sum(1 for t in turns if t[2] < chunk * CHUNK)
            held = system[0][5] if system else 0
            own_system = bool(system) and chunk == 0
            spans = list(
                plan(np.array([t[5] for t in turns], np.int64), first, held, budget, history, history_turns)
            )
            if own_system and not spans:
                spans = [(0, 0, 0, held)]
            for back, start, end, size in spans:
                new_system = own_system and start == first
                repeated = turns[back:start] if new_system else [*system, *turns[back:start]]
                new = [*system, *turns[start:end]] if new_system else turns[start:end]
                parts, loss, at = [], [], 0
                for k, (_, _, _, role, text, _) in enumerate([*repeated, *new]):
                    head, body, foot = format_turn(role, text)
                    parts += [head, body, foot]
                    at += len(head)
                    if role == "assistant" and k >= len(repeated):
                        loss.append({"start": at, "end": at + len(body)})
                    at += len(body) + len(foot)
                yield (conv, new[0][2], len(new), len(repeated), "".join(parts), loss, size, size > budget)

        names = ["conv_id", "start", "n_turns", "n_repeated", "text", "loss", "n_tokens", "over_budget"]
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

        def batch_of(found):
            types = [kind, pa.int64(), pa.int64(), pa.int64(), pa.string(), spans, pa.int64(), pa.bool_()]
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

        waiting, size = [], 0
        for _, group in groupby(rows(), key=lambda row: row[:2]):
            for window in cut(list(group)):
                waiting.append(window)
                size += len(window[4])
                if size >= 1 << 22:
                    yield batch_of(waiting)
                    waiting, size = [], 0
        if waiting:
            yield batch_of(waiting)

    return (
        counted.repartition("conv_id", "chunk")
        .sortWithinPartitions("conv_id", "chunk", "pos")
        .mapInArrow(
            windows,
            f"conv_id {conv_type}, start long, n_turns long, n_repeated long, text string, "
            "loss array<struct<start: long, end: long>>, n_tokens long, over_budget boolean",
        )
    )


def digest(windows: DataFrame) -> DataFrame:
    """Turns and loss text read back from formatted windows, as one row of digests per conversation.

    A SHA-256 needs its bytes in order, so the windows of a conversation pass one task, one window
    at a time; nothing is collected.
    """
    conv_type = windows.schema["conv_id"].dataType.simpleString()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.null()

        def rows():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield from zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True)

        done = []

        def flush():
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"],
            )

        for conv, group in groupby(rows(), key=lambda row: row[0]):
            turns_sha, loss_sha = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = n_windows = 0
            for _, _, repeated, text, loss in group:
                for role, said, _, _ in parse(text)[repeated:]:
                    turns_sha.update(f"{role}\n{said}\n".encode())
                    n_turns += 1
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    loss_sha.update(said.encode())
                    loss_chars += len(said)
                chars += len(text)
                n_windows += 1
            done.append(
                (conv, n_turns, turns_sha.hexdigest(), loss_chars, loss_sha.hexdigest(), chars, n_windows)
            )
            if len(done) >= 10_000:
                yield flush()
                done = []
        if done:
            yield flush()

    return (
        windows.select("conv_id", "start", "n_repeated", "text", "loss")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "start")
        .mapInArrow(
            fold,
            f"conv_id {conv_type}, n_turns long, turns_sha256 string, loss_chars long, "
            "loss_sha256 string, formatted_chars long, n_windows long",
        )
    )
