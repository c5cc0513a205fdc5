"""Chat formatting by prefix-target expansion: one example for each assistant turn.

Examples of one conversation share their prefixes, so they are kept as spans over its
formatted text instead of copies of it: example i reads the characters [0, end) and is
trained on [loss_start, loss_end). Written out, T turns make T²/2 turns of text, which a
conversation with very many turns would not survive; ``render`` writes them out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"
HEAD, HEAD_END, TAIL = "### ", ":\n", "\n</turn>\n"
PIECES = "conv_id bigint, turn_no bigint, trained boolean, piece string, start bigint, loss_start bigint, loss_end bigint"
_SPECIAL = re.compile(r"[\\#<]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_PIECE = re.compile(r"### ((?:[^\\#<:]|\\.)*):\n((?:[^\\#<]|\\.)*)\n</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    """Put a backslash before the characters that every mark of the template begins with, and before backslashes."""
    return _SPECIAL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def header(role: str) -> str:
    return HEAD + escape(role).replace(":", "\\:") + HEAD_END


def parse_piece(piece: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    found = _PIECE.fullmatch(piece)
    if found is None:
        raise ValueError("not a formatted turn")
    return unescape(found[1]), unescape(found[2])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns arrive by conversation and in order; only the running offset is held."""
    now, turn_no, at = object(), 0, 0
    for batch in batches:
        out = {k: [] for k in ("conv_id", "turn_no", "trained", "piece", "start", "loss_start", "loss_end")}
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if conv != now:
                now, turn_no, at = conv, 0, 0
            head, body = header(role or ""), escape(text or "")
            piece, trained = head + body + TAIL, role == TRAINED_ROLE
            span = (at + len(head), at + len(head) + len(body)) if trained else (None, None)
            for k, v in zip(out, (conv, turn_no, trained, piece, at, *span), strict=True):
                out[k].append(v)
            turn_no, at = turn_no + 1, at + len(piece)
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))


def format_turns(turns: DataFrame) -> DataFrame:
    """One formatted turn per row: conv_id, turn_no, trained, piece, start, loss_start, loss_end.

    Joined in order, the pieces of a conversation are its formatted text; ``start`` and the
    loss span are code points in it. Turns are sorted by conversation, turn, role and text
    inside partitions by conversation and streamed, so a conversation of any length needs
    the memory of one batch. Rows come out by conversation and in order.

    Null role: ''. Null text: empty. Null conv_id: a conversation of its own. Ties in
    ``turn`` are ordered by role and text, nulls first; repeated rows are turns of their own. Empty
    table: empty result. Other columns are ignored.
    """
    own = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
    ordered = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_format, PIECES)


def examples(pieces: DataFrame) -> DataFrame:
    """One row per assistant turn: the context is all text before it, only the reply is trained.

    ``reply`` is the trained part of the formatted text, [``loss_start``, ``loss_end``); the
    example reads [0, ``end``). Rows keep the order of ``pieces``. Assistant turns that are
    repeated rows give an example each; no assistant turn, or an empty table: no row.
    """
    within = F.col("loss_start") - F.col("start") + 1
    return pieces.filter("trained").select(
        "conv_id",
        F.col("turn_no").alias("target_turn"),
        "loss_start",
        "loss_end",
        (F.col("start") + F.length("piece")).alias("end"),
        F.col("piece").substr(within.cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int")).alias("reply"),
    )


def render(pieces: DataFrame, chosen: DataFrame) -> DataFrame:
    """Write out the texts of chosen examples: the pieces up to the target turn, joined."""
    left, right = pieces.alias("p"), chosen.alias("e")
    upto = F.col("p.conv_id").eqNullSafe(F.col("e.conv_id")) & (F.col("p.turn_no") <= F.col("e.target_turn"))
    parts = F.sort_array(F.collect_list(F.struct("p.turn_no", "p.piece")))
    return (
        left.join(right, upto)
        .groupBy("e.conv_id", "e.target_turn", "e.loss_start", "e.loss_end")
        .agg(F.array_join(F.transform(parts, lambda x: x["piece"]), "").alias("text"))
    )


class _Turns:
    """What the formatted turns of a conversation say, as they come."""

    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, formatted_chars bigint"

    def __init__(self):
        self.turns, self.digest, self.chars = 0, hashlib.sha256(), 0

    def add(self, piece: str) -> None:
        role, text = parse_piece(piece)
        self.digest.update(f"{role}\n{text}\n".encode())
        self.turns, self.chars = self.turns + 1, self.chars + len(piece)

    def row(self) -> tuple:
        return self.turns, self.digest.hexdigest(), self.chars


class _Replies:
    """What the examples of a conversation train, as they come."""

    schema = "conv_id bigint, loss_chars bigint, loss_sha256 string, n_examples bigint, example_chars bigint"

    def __init__(self):
        self.chars, self.digest, self.examples, self.example_chars = 0, hashlib.sha256(), 0, 0

    def add(self, reply: str, end: int) -> None:
        text = unescape(reply)
        self.digest.update(text.encode())
        self.chars, self.examples, self.example_chars = self.chars + len(text), self.examples + 1, self.example_chars + end

    def row(self) -> tuple:
        return self.chars, self.digest.hexdigest(), self.examples, self.example_chars


def _by_conversation(rows: DataFrame, kind: type) -> DataFrame:
    """One row for each run of rows of one conversation; one ``kind`` is held at a time, the first column being conv_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in kind.schema.split(", ")]
        types = [pa.string() if name.endswith("sha256") else pa.int64() for name in names]
        give = lambda done: pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*done, strict=True), types, strict=True)], names)
        now, state = None, None
        for batch in batches:
            done = []
            for conv, *values in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, *state.row()))
                    now, state = conv, kind()
                state.add(*values)
            if done:
                yield give(done)
        if state is not None:
            yield give([(now, *state.row())])

    return rows.mapInArrow(run, kind.schema)


def read_back(pieces: DataFrame) -> DataFrame:
    """Per conversation, what its formatted turns say and what its examples train, unescaped.

    Takes the rows as ``format_turns`` leaves them, in order: turns and ``examples`` are
    streamed by conversation, so what is held is a running digest. A conversation without assistant
    turns has no example: 0 characters, the digest of nothing. Null conv_id: one conversation. Repeated
    rows count as they are; empty table: empty result.
    """
    told = _by_conversation(pieces.select("conv_id", "piece"), _Turns)
    trained = _by_conversation(examples(pieces).select("conv_id", "reply", "end"), _Replies).withColumnRenamed("conv_id", "trained_id")
    none = F.lit(0).cast("bigint")
    return told.join(trained, F.col("conv_id").eqNullSafe(F.col("trained_id")), "left").select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.coalesce("loss_chars", none).alias("loss_chars"),
        F.coalesce("loss_sha256", F.sha2(F.lit(""), 256)).alias("loss_sha256"),
        "formatted_chars",
        F.coalesce("n_examples", none).alias("n_examples"),
        F.coalesce("example_chars", none).alias("example_chars"),
    )
