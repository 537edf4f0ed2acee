"""Chat formatting by prefix-target expansion.

Every assistant turn becomes a training example: all turns before it are its context, and only its
own text is trained on. ``expand`` writes the examples out, each with its whole context, in pieces;
``read_back`` reads turns and trained texts from them, and ``render`` puts each into one row.

A turn is formatted as ``<turn ROLE>TEXT</turn>`` and a line feed. Inside roles and texts ``&``,
``<`` and ``[`` (and ``>`` in roles) are escaped, so that neither this template's marks nor those
of other common ones can be forged by a text; ``unescape`` gives back what went in.
"""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.llm.batches import chunks

#: Character and what stands for it; ``&`` first, as the others bring new ones.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), (">", "&gt;"))
TRAINED_ROLE = "assistant"

#: Code points after which a piece of an example's text ends, with the turn.
PIECE = 1 << 20
#: Bytes of a conversation's closed pieces that a task keeps in memory.
KEPT = 16 << 20

_PIECE_NAMES = "conv_id position piece text whole target_begin target_end".split()
_PIECE_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]

_TURN = re.compile(r"<turn ([^<>]*)>([^<]*)</turn>\n")


def escape(value: Column, escapes=ESCAPES[:3]) -> Column:
    for plain, safe in escapes:
        value = F.replace(value, F.lit(plain), F.lit(safe))
    return value


def unescape(value: str) -> str:
    for plain, safe in reversed(ESCAPES):
        value = value.replace(safe, plain)
    return value


def segments(df: DataFrame) -> DataFrame:
    """(conv_id, position, trained, last, segment, begin, target_begin, target_end): the formatted
    turns in order, with their place in the conversation's formatted text, in code points from 0.

    One row per input row. Turns are ordered by number, then role and text, nulls first; repeated
    rows are turns of their own; a null role or text counts as empty; rows of a null conv_id are one
    conversation. Other columns are not read. Rows meet once, by conversation; a long conversation
    is streamed through a window, never collected.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    head = F.concat(F.lit("<turn "), escape(role, ESCAPES), F.lit(">"))
    body = escape(text)
    order = ["turn", "role", "text"]
    rows = df.select("conv_id", *order).repartition("conv_id")
    rows = rows.select(
        "conv_id",
        *order,
        (role == TRAINED_ROLE).alias("trained"),
        F.concat(head, body, F.lit("</turn>\n")).alias("segment"),
        F.char_length(head).cast("bigint").alias("head"),
        F.char_length(body).cast("bigint").alias("body"),
    )
    ordered = Window.partitionBy("conv_id").orderBy(*order)
    before = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.char_length("segment").cast("bigint")
    rows = rows.withColumns(
        {
            "position": F.row_number().over(ordered),
            "last": F.lead(F.lit(True)).over(ordered).isNull(),
            "end": F.sum(size).over(before),
        }
    )
    begin = F.col("end") - size
    return rows.select(
        "conv_id",
        "position",
        "trained",
        "last",
        "segment",
        begin.alias("begin"),
        (begin + F.col("head")).alias("target_begin"),
        (begin + F.col("head") + F.col("body")).alias("target_end"),
    )


def expand(turns: DataFrame) -> DataFrame:
    """(conv_id, position, piece, text, whole, target_begin, target_end): the training examples of
    ``segments``, written out, one for each trained turn, known by that turn's position.

    An example's text is that of its context, all turns before, and of its target; only
    target_begin..target_end of it (code points from 0, over all its pieces) is under the loss mask.
    It comes in pieces that end with a turn, in order, so neither it nor a conversation need fit a
    row. ``whole`` marks the text of a whole conversation: its last turn's example or, where that
    turn is not trained, a text without a target. Examples repeat their contexts, so a conversation
    of n turns makes n squared of text; it is streamed, and what is kept of a long one lies in a
    file of the task. Rows are in the order of conv_id, position and piece within a partition.
    """
    conv = turns.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, rows, size = _Prefix(), [], 0
        for batch in batches:
            types = [batch.schema.field(0).type, *_PIECE_TYPES]
            columns = (batch.column(i).to_pylist() for i in range(7))
            for conv_id, position, segment, trained, last, *target in zip(*columns, strict=True):
                if position == 1:
                    prefix = _Prefix()
                prefix.add(segment)
                if not (trained or last):
                    continue
                for piece, text in enumerate(prefix.pieces()):
                    rows.append((conv_id, position, piece, text, last, *target))
                    size += len(text)
                    if size >= PIECE:
                        yield _batch(rows, _PIECE_NAMES, types)
                        rows, size = [], 0
            yield _batch(rows, _PIECE_NAMES, types)
            rows, size = [], 0

    target = [F.when(F.col("trained"), F.col(c)).alias(c) for c in ("target_begin", "target_end")]
    stream = turns.sortWithinPartitions("conv_id", "position").select(
        "conv_id", "position", "segment", "trained", "last", *target
    )
    pieces = "position int, piece int, text string, whole boolean, "
    rest = T.StructType.fromDDL(pieces + "target_begin bigint, target_end bigint")
    return stream.mapInArrow(run, T.StructType([T.StructField("conv_id", conv), *rest]))


class _Prefix:
    """The formatted text of a conversation as far as it was read, in pieces."""

    def __init__(self) -> None:
        self.closed, self.sizes = tempfile.SpooledTemporaryFile(KEPT), []
        self.open, self.chars = [], 0

    def add(self, segment: str) -> None:
        self.open.append(segment)
        self.chars += len(segment)
        if self.chars >= PIECE:
            piece = "".join(self.open).encode()
            self.closed.seek(0, os.SEEK_END)
            self.closed.write(piece)
            self.sizes.append(len(piece))
            self.open, self.chars = [], 0

    def pieces(self) -> Iterator[str]:
        self.closed.seek(0)
        for size in self.sizes:
            yield self.closed.read(size).decode()
        if self.open:
            self.open = ["".join(self.open)]
            yield self.open[0]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def render(expanded: DataFrame) -> DataFrame:
    """(conv_id, position, text, target_begin, target_end): the examples, each in one row, which it
    must fit."""
    ordered = F.array_sort(F.collect_list(F.struct("piece", "text")))
    targets = [F.first(name).alias(name) for name in ("target_begin", "target_end")]
    examples = expanded.filter(F.col("target_begin").isNotNull())
    whole = examples.groupBy("conv_id", "position").agg(ordered.alias("pieces"), *targets)
    text = F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    return whole.select("conv_id", "position", text.alias("text"), "target_begin", "target_end")


class _Reader:
    """Reads the examples of one conversation back, piece by piece: the text under the loss mask of
    each, and the turns of the one that holds the whole conversation."""

    def __init__(self) -> None:
        self.turns, self.chars, self.loss_chars, self.at = 0, 0, 0, 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def take(self, piece: int, text: str, whole: bool, low: int | None, high: int | None) -> None:
        begin = self.at if piece else 0
        self.at = begin + len(text)
        if low is not None and begin <= low < self.at:
            trained = unescape(text[low - begin : high - begin])
            self.loss_chars += len(trained)
            self.loss_hash.update(trained.encode())
        if whole:
            for role, body in _TURN.findall(text):
                self.turns += 1
                self.turns_hash.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
            self.chars += len(text)

    def row(self, conv_id) -> tuple:
        digests = (self.turns_hash.hexdigest(), self.loss_hash.hexdigest())
        return conv_id, self.turns, digests[0], self.loss_chars, digests[1], self.chars


def read_back(expanded: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read from the
    texts and masks of the examples, as ``expand`` returns them and in its order: a digest needs its
    conversation's examples in order. They are streamed; only the digest's state is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, reader = None, None
        for batch in batches:
            done = []
            for part in chunks(batch, "text"):
                columns = (part.column(i).to_pylist() for i in range(6))
                for conv_id, *piece in zip(*columns, strict=True):
                    if reader is None or conv_id != current:
                        if reader:
                            done.append(reader.row(current))
                        current, reader = conv_id, _Reader()
                    reader.take(*piece)
            yield _batch(done, names, types)
        if reader:
            yield _batch([reader.row(current)], names, types)

    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars".split()
    stream = expanded.select("conv_id", "piece", "text", "whole", "target_begin", "target_end")
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    return stream.mapInArrow(run, schema + "loss_sha256 string, formatted_chars bigint")
