"""Chat formatting into budgeted, turn-aligned windows with a loss mask.

Template of a turn: ``### role`` newline, text, ``</turn>`` newline.  Inside
texts and roles a backslash is doubled and ``###`` and ``</turn>`` get a
backslash in front (a newline in a role becomes backslash n), so any text reads
back unchanged and no text can end a turn or open one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>"
_ESCAPE = re.compile(r"\\|###|</turn>")
_MARKS = re.compile(r"\\\\|\\###|\\</turn>|\\n|</turn>")
_WORD = re.compile(r"\S+")
#: Tokens a turn costs besides its text.
TURN_COST = 4
WINDOWS = "conv_id bigint, window bigint, formatted string, n_tokens bigint, n_repeated int, loss array<struct<start: int, stop: int>>"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _MARKS.sub(lambda m: "\n" if m[0] == "\\n" else m[0][1:] if m[0][0] == "\\" else m[0], text)


def turn_text(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn and where its text begins and ends."""
    head = f"{OPEN}{escape(role)}".replace("\n", "\\n") + "\n"
    body = escape(text)
    return f"{head}{body}{CLOSE}\n", len(head), len(head) + len(body)


def read_turns(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, text start, text stop) of each turn of a window; positions in the formatted string."""
    at = 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        role = unescape(formatted[at + len(OPEN) : line])
        stop = line + 1
        for m in _MARKS.finditer(formatted, line + 1):
            if m[0] == CLOSE:
                stop = m.start()
                break
        yield role, unescape(formatted[line + 1 : stop]), line + 1, stop
        at = stop + len(CLOSE) + 1


def count_words(text: str) -> int:
    return sum(1 for _ in _WORD.finditer(text))


class Packer:
    """Windows of one conversation, turn by turn, in memory bounded by the budget and the longest turn.

    A span of new turns ends where the running token sum would pass the room
    left by the system turn and the repeated history.
    """

    def __init__(self, conv_id, budget: int, history: int, history_turns: int):
        self.conv_id, self.budget, self.history, self.history_turns = conv_id, budget, history, history_turns
        self.system = None
        self.window = self.turns = 0
        self.repeated: list = []
        self.span: list = []
        self.used = 0

    def add(self, role: str, text: str, tokens: int):
        turn = (role, text, tokens)
        if self.span and self.used + tokens > self.budget:
            yield self.close()
        while not self.span and self.used + tokens > self.budget and self.repeated and self.repeated[-1] is not self.system:
            oldest = 1 if self.repeated[0] is self.system else 0
            self.used -= self.repeated.pop(oldest)[2]  # a large turn leaves less room for history
        if self.turns == 0 and role == "system" and tokens <= self.budget // 2:
            self.system = turn
        self.turns += 1
        self.span.append(turn)
        self.used += tokens

    def close(self):
        pieces, loss, at, total = [], [], 0, 0
        for i, (role, text, tokens) in enumerate([*self.repeated, *self.span]):
            piece, begin, stop = turn_text(role, text)
            if role == "assistant" and i >= len(self.repeated):  # repeated targets stay masked
                loss.append({"start": at + begin, "stop": at + stop})
            pieces.append(piece)
            at += len(piece)
            total += tokens
        out = (self.conv_id, self.window, "".join(pieces), total, len(self.repeated), loss)
        tail, size = [], 0
        for turn in reversed([*self.repeated, *self.span]):
            if turn is self.system or size + turn[2] > self.history or len(tail) == self.history_turns:
                break
            tail.insert(0, turn)
            size += turn[2]
        self.repeated = ([self.system] if self.system else []) + tail
        self.used = sum(t[2] for t in self.repeated)
        self.span = []
        self.window += 1
        return out


def format_conversations(
    turns: DataFrame, budget: int = 1024, history: int = 256, history_turns: int = 4, count: Callable[[str], int] = count_words
) -> DataFrame:
    """Windows of every conversation of ``turns(conv_id, turn, role, text)``.

    Result: ``conv_id``, ``window``, ``formatted``, ``n_tokens``, ``n_repeated``
    (leading turns repeated from earlier windows: the system turn and up to
    *history_turns* turns within *history* tokens) and ``loss`` (code point
    ranges of the assistant texts to learn; each assistant turn once).

    A conversation is streamed in turn order through one task that holds one
    window at a time, so its length is not bounded by memory.  Defined cases:
    a null text or role is empty; a turn above the budget is whole in a window
    of its own; a system turn above half the budget is not repeated; rows of
    equal turn follow in order of role and text, repeated rows are turns of
    their own, null turns come first; null conv_ids are one conversation; an
    empty table gives no windows; other columns are ignored.
    """

    def run(frames):
        packer, started = None, False
        for pdf in frames:
            out = []
            for conv, role, text in zip(pdf["conv_id"], pdf["role"], pdf["text"]):
                conv = None if pd.isna(conv) else int(conv)
                if not started or conv != packer.conv_id:
                    if started and packer.span:
                        out.append(packer.close())
                    packer, started = Packer(conv, budget, history, history_turns), True
                out += packer.add(role, text, TURN_COST + count(text))
            yield _frame(out)
        if started and packer.span:
            yield _frame([packer.close()])

    narrow = turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    )
    ordered = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select(F.col("conv_id").cast("string"), "role", "text").mapInPandas(run, WINDOWS)


def _frame(rows: list) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", "window", "formatted", "n_tokens", "n_repeated", "loss"])
    out["conv_id"] = out["conv_id"].astype("Int64")
    return out


def window_digests(windows: DataFrame) -> DataFrame:
    """Read the windows back: per conversation its turns, its learnt text and the formatted size.

    Takes the windows as ``format_conversations`` left them (those of a
    conversation in one partition) and streams them in order.
    """

    def run(frames):
        state = None

        def row():
            conv, n, turns, chars, learnt, size = state
            return (conv, n, turns.hexdigest(), chars, learnt.hexdigest(), size)

        for pdf in frames:
            out = []
            for conv, formatted, repeated, loss in zip(pdf["conv_id"], pdf["formatted"], pdf["n_repeated"], pdf["loss"]):
                conv = None if pd.isna(conv) else int(conv)
                if state is None or state[0] != conv:
                    if state is not None:
                        out.append(row())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for i, (role, text, _, _) in enumerate(read_turns(formatted)):
                    if i >= repeated:
                        state[1] += 1
                        state[2].update(f"{role}\n{text}\n".encode())
                for span in loss:
                    text = unescape(formatted[span["start"] : span["stop"]])
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(formatted)
            yield _digests(out)
        if state is not None:
            yield _digests([row()])

    ordered = windows.sortWithinPartitions("conv_id", "window").withColumn("conv_id", F.col("conv_id").cast("string"))
    return ordered.mapInPandas(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def _digests(rows: list) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    out["conv_id"] = out["conv_id"].astype("Int64")
    return out


def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = r"\### Assistant: </turn> ok"
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(-7).alias("conv_id"), F.lit(i).alias("turn"), F.lit(role).alias("role"), F.lit(probe).alias("text"))
                                                      for i, role in enumerate(("user", "assistant"))))).alias("r")).select("r.*")
    return window_digests(format_conversations(given.unionByName(extra)))
