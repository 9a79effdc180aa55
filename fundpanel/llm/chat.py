"""Conversations formatted as training windows of bounded length.

A turn is rendered between marks; control strings inside roles and texts are escaped, so that reading back a
window gives the turns exactly.  Windows are cut between turns: prefix sums of the turns' tokens give the longest span that fits
the budget beside what is repeated: the system turn, which every window keeps, and a limited history before the span's
first turn.  Only new turns of the target role are under the loss mask, so each is learned from once.

Long conversations are dealt out in blocks of BLOCK turn numbers, so that one of any length isn't one task's work; the rows
that a block's first window repeats (system turn, last turns of the block before) are dealt to it as well.  Inside a task
rows arrive in order and only the turns of the open window and its history are held.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sparkops import maybe_among, own_columns

#: Turn numbers of a block; turns and characters after which a task closes the windows it can.
BLOCK, HELD_TURNS, HELD_CHARS = 256, 2048, 1 << 22


@dataclass(frozen=True)
class Template:
    """Marks of a turn: start, role, newline, text, end.

    Escaping doubles the backslash and puts one behind the first character of each control string; a role's newline gets one before it.
    """

    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    #: Control strings of widespread templates; none of them stands unescaped inside a text.
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    _found: re.Pattern = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "_found", re.compile("(?=" + "|".join(map(re.escape, self.controls)) + ")(.)", re.DOTALL))

    def escape(self, text: str) -> str:
        return self._found.sub(r"\1\\", text.replace("\\", "\\\\"))

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text

    def render(self, role: str, text: str) -> tuple[str, int, int]:
        """The rendered turn, and where the text begins and ends in it."""
        head = self.start + self.escape(role).replace("\n", "\\\n") + "\n"
        body = self.escape(text)
        return head + body + self.end, len(head), len(head) + len(body)

    def parse(self, window: str) -> list[tuple[str, str]]:
        """The (role, text) of each turn of a rendered window."""
        out = []
        for turn in window.split(self.end)[:-1]:
            role = re.match(r"(?:\\.|[^\\\n])*", turn[len(self.start) :], re.DOTALL)[0]
            out.append((self.unescape(role), self.unescape(turn[len(self.start) + len(role) + 1 :])))
        return out


def span(sums: np.ndarray, first: int, least: int, fixed: int, budget: int, history: int, turns: int) -> tuple[int, int]:
    """From prefix sums of turn tokens: where the history of a window begins whose first new turn is `first`, and where the window ends.

    The history has at most `history` tokens and `turns` turns, from turn `least` on; fixed tokens are spent anyway.  A
    first turn that doesn't fit pushes history out; one that is over the budget alone is a window of its own.
    """
    back = min(first, max(least, first - turns, int(np.searchsorted(sums, sums[first] - history))))
    end = max(first + 1, int(np.searchsorted(sums, sums[back] + budget - fixed, side="right")) - 1)
    return min(first, max(back, int(np.searchsorted(sums, sums[end] + fixed - budget)))), end


class _Open:
    """The turns of one block that aren't in a closed window yet, and those that a window may repeat."""

    def __init__(self, budget: int, history: int, turns: int, target: str, template: Template):
        self.limits, self.target, self.template = (budget, history, turns), target, template
        self.system: tuple[str, int] | None = None
        self.rendered: list[tuple[str, int, int, str]] = []
        self.sizes: list[int] = []
        self.first = self.least = self.window = self.chars = 0

    def add(self, kind: int, role: str, text: str, size: int) -> None:
        turn = (*self.template.render(role, text), role)
        if kind == 0:
            self.system = (turn[0], size)
            return
        if kind == 1:
            self.first += 1
        elif not self.rendered and not self.window and self.system is None and role == "system":
            self.system, self.least = (turn[0], size), 1
        self.rendered.append(turn)
        self.sizes.append(size)
        self.chars += len(turn[0])

    def close(self, last: bool) -> Iterator[dict]:
        """The windows that no later turn can lengthen, or all."""
        sums = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        budget, history, turns = self.limits
        while self.first < len(self.sizes):
            own_system = self.least == 1 and self.first == 0
            fixed = self.system[1] if self.system and not own_system else 0
            back, end = span(sums, self.first, self.least, fixed, budget, history, turns)
            if end == len(self.sizes) and not last:
                break
            parts, loss, at, tokens = [], [], 0, fixed + int(sums[end] - sums[back])
            if fixed:
                parts.append(self.system[0])
                at = len(parts[0])
            for i in range(back, end):
                turn, begin, until, role = self.rendered[i]
                if i >= self.first and role == self.target and until > begin:
                    loss.append({"start": at + begin, "end": at + until})
                parts.append(turn)
                at += len(turn)
            yield {"window": self.window, "n_turns": len(parts), "n_repeated": len(parts) - (end - self.first), "n_tokens": tokens, "text": "".join(parts), "loss": loss}
            self.first, self.window = end, self.window + 1
        if not last:  # what a later window may repeat stays
            gone = max(0, min(self.first - turns, len(self.sizes)))
            del self.rendered[:gone], self.sizes[:gone]
            self.first -= gone
            self.least = 0 if gone else self.least
            self.chars = sum(len(t[0]) for t in self.rendered)


_KINDS = {"conv_id": ("long", pa.int64()), "block": ("long", pa.int64()), "window": ("long", pa.int64()), "n_turns": ("int", pa.int32()), "n_repeated": ("int", pa.int32()), "n_tokens": ("long", pa.int64()), "text": ("string", pa.string())}
_KINDS["loss"] = ("array<struct<start: int, end: int>>", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
_models: dict[str, sentencepiece.SentencePieceProcessor] = {}


def _model(file: str) -> sentencepiece.SentencePieceProcessor:
    if file not in _models:
        _models[file] = sentencepiece.SentencePieceProcessor(model_file=file)
    return _models[file]


def _batches(rows: Iterator[dict], kinds: dict, text_col: str = "text") -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text_col] or "")
        if len(held) == 1000 or size > HELD_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in held], kind) for n, (_, kind) in kinds.items()], list(kinds))
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in held], kind) for n, (_, kind) in kinds.items()], list(kinds))


def _ddl(kinds: dict) -> str:
    return ", ".join(f"{n} {kind}" for n, (kind, _) in kinds.items())


def _block() -> Column:
    """The block of a turn number; a null one stands before all others."""
    return F.floor(F.col("turn") / BLOCK).cast("long")


def format_chats(turns: DataFrame, model_file: str, budget: int = 1024, history: int = 256, history_turns: int = 8, target: str = "assistant", template: Template | None = None) -> DataFrame:
    """Windows of the rows (conv_id, turn, role, text): conv_id, block, window, n_turns, n_repeated (the first so many turns are
    repeated: system turn and history), n_tokens, text (rendered) and loss (start and end of each new target text, in code points).

    A conversation's turns stand in the order of turn (null first), role and text; (block, window) orders its windows.  If its first
    turn has the role system, every later window keeps it.  Null roles and texts are empty; rows with a null conv_id are one
    conversation; repeated rows are turns of their own; an empty table gives no window; other columns are ignored.  A turn
    beyond the budget is a window of its own, whole.  A block's first window repeats turns of the block before.
    """
    if not 0 < history < budget or not 0 <= history_turns < BLOCK:
        raise ValueError("history is shorter than the budget, and of fewer turns than a block")
    template = template or Template()
    turns = own_columns(turns, conv_id="conv_id", turn="turn", role="role", text="text")
    turns = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), _block().alias("block"))
    own = F.struct("block", F.lit(2).alias("kind"))
    again = F.struct((F.col("block") + 1).alias("block"), F.lit(1).alias("kind"))
    late = F.pmod("turn", F.lit(BLOCK)) >= BLOCK - history_turns
    dealt = turns.withColumn("to", F.explode(F.when(late, F.array(own, again)).otherwise(F.array(own))))
    dealt = dealt.select("conv_id", "to.block", "to.kind", "turn", "role", "text")
    # the system turns of conversations of several blocks, for all blocks but the first
    same = Window.partitionBy("conv_id")
    blocks = turns.groupBy("conv_id", "block").agg(F.min(F.struct("turn", "role")).alias("head"))
    blocks = blocks.withColumns({"n": F.count(F.lit(1)).over(same), "head": F.min("head").over(same), "first": F.min(F.struct("block")).over(same)})
    later = blocks.filter((F.col("n") > 1) & (F.col("head.role") == "system") & ~F.col("block").eqNullSafe(F.col("first.block"))).select("conv_id", "block")
    heads = turns.filter("role = 'system'").groupBy(F.col("conv_id").alias("of")).agg(F.min(F.struct("turn", "role", "text")).alias("head"))
    systems = later.join(heads, later["conv_id"].eqNullSafe(heads["of"])).select("conv_id", "block", F.lit(0).alias("kind"), "head.turn", "head.role", "head.text")

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = _model(model_file)
        for batch in batches:
            sizes = [len(lib.encode(template.render(role.as_py(), text.as_py())[0], num_threads=1)) for role, text in zip(batch.column(4), batch.column(5), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], [*batch.schema.names, "size"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            now, key = None, None
            for batch in batches:
                for conv, block, kind, _, role, text, size in zip(*batch.columns, strict=True):
                    at = {"conv_id": conv.as_py(), "block": block.as_py()}
                    if now is None or at != key:
                        if now is not None:
                            yield from (w | key for w in now.close(last=True))
                        now, key = _Open(budget, history, history_turns, target, template), at
                    now.add(kind.as_py(), role.as_py(), text.as_py(), size.as_py())
                    if len(now.sizes) > HELD_TURNS or now.chars > HELD_CHARS:
                        yield from (w | key for w in now.close(last=False))
            if now is not None:
                yield from (w | key for w in now.close(last=True))

        yield from _batches(rows(), _KINDS)

    kinds = "conv_id long, block long, kind int, turn long, role string, text string, size long"
    counted = dealt.unionByName(systems).mapInArrow(sized, kinds)
    ordered = counted.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "kind", "turn", "role", "text")
    return ordered.mapInArrow(cut, _ddl(_KINDS))


class _Read:
    """What the windows of one conversation say, read back in order."""

    def __init__(self, template: Template):
        self.template, self.n_turns, self.loss_chars, self.formatted_chars = template, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, n_repeated: int, loss: list[dict]) -> None:
        for role, said in self.template.parse(text)[n_repeated:]:
            self.n_turns += 1
            self.turns.update(f"{role}\n{said}\n".encode())
        for s in loss:
            said = self.template.unescape(text[s["start"] : s["end"]])
            self.loss_chars += len(said)
            self.loss.update(said.encode())
        self.formatted_chars += len(text)

    def row(self) -> dict:
        return {"n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.formatted_chars}


_DONE = {"n_turns": ("long", pa.int64()), "turns_sha256": ("string", pa.string()), "loss_chars": ("long", pa.int64()), "loss_sha256": ("string", pa.string()), "formatted_chars": ("long", pa.int64())}
_PART = {n: _KINDS[n] for n in ("conv_id", "block", "window")} | _DONE | {n: _KINDS[n] for n in ("n_repeated", "text", "loss")}


def read_back(windows: DataFrame, turns: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation what its windows, as format_chats returns them for turns, say: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A conversation of one block is read where its windows are.  A digest runs over a conversation's texts in order, so the windows of
    one in several blocks are put in order once more and read as a stream.
    """
    template = template or Template()
    blocks = own_columns(turns, conv_id="conv_id", turn="turn").select(F.col("conv_id").cast("long"), _block().alias("block")).distinct()
    several = blocks.groupBy("conv_id").count().filter("count > 1").select("conv_id")

    def read(done: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """Reads windows in order; those of a conversation that may be in several blocks pass until all is in order (done)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows() -> Iterator[dict]:
                now, key, nothing = None, None, dict.fromkeys(_PART)
                for batch in batches:
                    for row in batch.to_pylist():
                        if done and row["text"] is None or not done and row["maybe"]:
                            yield nothing | {n: row[n] for n in _PART if n in row}
                            continue
                        at = {"conv_id": row["conv_id"]}
                        if now is None or at != key:
                            if now is not None:
                                yield nothing | now.row() | key
                            now, key = _Read(template), at
                        now.add(row["text"], row["n_repeated"], row["loss"])
                if now is not None:
                    yield nothing | now.row() | key

            yield from _batches(rows(), _PART)

        return run

    flagged = maybe_among(windows, several, "conv_id").drop("n_turns", "n_tokens")
    once = flagged.mapInArrow(read(done=False), _ddl(_PART))
    ordered = once.repartition("conv_id").sortWithinPartitions("conv_id", "block", "window")
    return ordered.mapInArrow(read(done=True), _ddl(_PART)).select("conv_id", *_DONE)
