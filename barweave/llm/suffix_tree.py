"""Language-model scoring with a probabilistic suffix tree.

A text is read as its words (A-Z in lower case), each followed by a blank, and one end symbol, byte
by byte. The tree's states are contexts of up to ``DEPTH`` bytes. A context is kept if what follows
it differs from what follows its suffix by more than chance: the divergence of the two distributions
times the context's count must exceed half the logarithm of that count for each symbol seen. A kept
context's distribution is smoothed with that of its suffix; a byte is scored in the longest kept
suffix of what precedes it.

All training texts are counted, in tasks; the counts of each depth are summed, tested and smoothed
as tables. All that passes the test is kept. Tasks that score hold a bounded block of it
(``ENTRIES``): the contexts are ordered by their bytes, nearest byte first, and cut into ranges. A
range's block also has the contexts that are suffixes of some in the range, so it scores all places
whose context is in the range by itself, and there is one pass over the texts for each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barweave.llm.batches import LOWER, WORD, chunks, joined, ragged, span_hashes, spans
from barweave.llm.scratch import checkpointed

DEPTH = 6
#: Symbols of kept contexts in a block, about: 16 bytes each where it is held. More make more blocks.
ENTRIES = 1_000_000
#: Contexts are numbered below this, by their bytes, nearest first.
PLACES = 1 << 8 * DEPTH
#: Words whose counts every task holds; the others' counts are joined.
HELD_WORDS = 1 << 18
#: The end symbol; it cannot be part of a word.
END = 0x0A
#: Distinct keys counted in a task before they are passed on.
WAITING = 1 << 20


class Texts(NamedTuple):
    """A chunk as one byte sequence. ``real`` are the places to score (what is before them is
    padding), ``doc`` their texts; words are given by hash and text."""

    data: np.ndarray
    real: np.ndarray
    doc: np.ndarray
    words: np.ndarray
    word_doc: np.ndarray


def read(column: pa.StringArray, words: bool = True) -> Texts:
    """Without ``words`` their hashes are left out."""
    raw, starts = joined(column, 0x20)
    raw = LOWER[raw]
    begin, end = spans(raw, WORD)
    first = np.searchsorted(begin, np.append(starts, len(raw)))
    size = end - begin + 1
    stream = raw[ragged(begin, size)]
    stops = np.cumsum(size)
    stream[stops - 1] = 0x20
    edges = np.concatenate(([0], stops))[first]
    lengths = np.diff(edges) + 1
    n = len(column)
    places = np.cumsum(lengths + DEPTH) - lengths  # of each text's first symbol
    data = np.full(int(lengths.sum()) + n * DEPTH, END, np.uint8)
    data[ragged(places, lengths - 1)] = stream
    real = ragged(places, lengths)
    doc = np.repeat(np.arange(n), lengths)
    word_doc = np.repeat(np.arange(n), np.diff(first))
    hashes = span_hashes(raw, begin, end) if words else np.zeros(0, np.uint64)
    return Texts(data, real, doc, hashes, word_doc)


def keys(texts: Texts) -> np.ndarray:
    """For each place its symbol (lowest byte) and the ``DEPTH`` bytes before it, nearest lowest."""
    data = texts.data
    if not len(data):
        return np.zeros(0, np.uint64)
    # Of every place with DEPTH bytes before it: whole slices, then the places are picked once.
    out = np.zeros(len(data) - DEPTH, np.uint64)
    for back in range(DEPTH, -1, -1):
        out <<= np.uint64(8)
        out |= data[DEPTH - back : len(data) - back]
    return out[texts.real - DEPTH]


class _Sums:
    """Counts of keys, merged when many wait."""

    def __init__(self) -> None:
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, found: np.ndarray) -> None:
        self.waiting.append(np.unique(found, return_counts=True))
        self.size += len(self.waiting[-1][0])

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([k for k, _ in self.waiting] or [np.zeros(0, np.uint64)])
        counts = np.concatenate([c for _, c in self.waiting] or [np.zeros(0, np.int64)])
        found, which = np.unique(every, return_inverse=True)
        sums = np.bincount(which, counts, len(found)).astype(np.int64)
        self.waiting, self.size = [(found, sums)], len(found)
        return found, sums


def count(training: DataFrame) -> DataFrame:
    """(kind, key, count) over all training texts: kind 0 are bytes with the bytes before them,
    kind 1 words by hash, kind 2 (key 0) texts. Tasks add up before they pass on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, texts = [_Sums(), _Sums()], 0
        for batch in batches:
            for part in chunks(batch, "text", 1 << 19):
                chunk = read(part.column(0))
                texts += part.num_rows
                for kind, found in ((0, keys(chunk)), (1, chunk.words)):
                    sums[kind].add(found)
                    if sums[kind].size > WAITING and len(sums[kind].merged()[0]) > WAITING // 2:
                        yield from _rows(kind, *sums[kind].merged())
                        sums[kind] = _Sums()
        for kind in (0, 1):
            yield from _rows(kind, *sums[kind].merged())
        yield from _rows(2, np.zeros(1, np.int64), np.array([texts]))

    def _rows(kind, found, counts) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(found), 1 << 17):
            part, number = found[at : at + (1 << 17)], counts[at : at + (1 << 17)]
            kinds = np.full(len(part), kind, np.int32)
            arrays = [pa.array(kinds), pa.array(part.astype(np.int64)), pa.array(number)]
            yield pa.RecordBatch.from_arrays(arrays, ["kind", "key", "count"])

    rows = training.select("text").mapInArrow(run, "kind int, key bigint, count bigint")
    return checkpointed(rows.groupBy("kind", "key").agg(F.sum("count").alias("count")))


def levels(counted: DataFrame) -> list[DataFrame]:
    """For each depth (key, count, total, kinds, gain, own, share): symbols in contexts with the
    context's count and symbols, its divergence from its suffix in nats times its count, and the
    symbol's smoothed probability if the context is kept. Depth 0 has one context."""
    tables = [counted.where("kind = 0").select("key", "count")]
    for depth in range(DEPTH - 1, -1, -1):
        suffix = F.col("key").bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1))
        shorter = tables[-1].groupBy(suffix.alias("key")).agg(F.sum("count").alias("count"))
        tables.append(checkpointed(shorter))
    tables.reverse()
    total = tables[0].agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    n = F.col("count")
    below = tables[0].select("key", "count", F.lit(total).alias("total")).select(
        "*",
        F.lit(256).cast("bigint").alias("kinds"),
        F.lit(1e300).alias("gain"),
        (n / F.col("total")).alias("plain"),
        ((n + 0.5) / (F.col("total") + 128.0)).alias("p"),
    )
    out = [checkpointed(below)]
    context = Window.partitionBy("context")
    for depth in range(1, DEPTH + 1):
        parent = out[-1].select(
            F.col("key").alias("parent"), F.col("plain").alias("q"), F.col("p").alias("below")
        )
        suffix = F.col("key").bitwiseAND(F.lit((1 << 8 * depth) - 1))
        rows = tables[depth].withColumn("parent", suffix).join(parent, "parent")
        rows = rows.withColumn("context", F.shiftright("key", 8)).select(
            "key",
            "count",
            "below",
            F.sum("count").over(context).alias("total"),
            F.count(F.lit(1)).over(context).alias("kinds"),
            F.sum(n * F.log(n / F.col("q"))).over(context).alias("cross"),
        )
        gain = F.col("cross") - F.col("total") * F.log("total")
        weight = (F.col("kinds") + 1) / 2
        rows = rows.withColumn("gain", gain / (F.col("kinds") * F.log(F.col("total") + 1) / 2 + 2))
        smoothed = (n + weight * F.col("below")) / (F.col("total") + weight)
        rows = rows.select(
            "key",
            "count",
            "total",
            "kinds",
            "gain",
            (n / F.col("total")).alias("plain"),
            F.when(F.col("gain") > 1, smoothed).otherwise(F.col("below")).alias("p"),
        )
        out.append(checkpointed(rows))
    return out


class Model(NamedTuple):
    """By depth: sorted keys with log10 probabilities, sorted contexts with the log10 weight that
    their smoothing leaves to the suffix; and the log10 probability of a byte never seen."""

    entries: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    unseen: float


def _kept(tables: list[DataFrame]) -> DataFrame:
    """(depth, key, p, rest, low, high): the symbols of the contexts that the smoothing kept, with
    the log10 of their probability and of the weight left to the suffix, and the range of places
    that end in the context."""
    parts = []
    for depth, table in enumerate(tables):
        weight = (F.col("kinds") + 1) / 2
        low = F.lit(0).cast("bigint")
        for back in range(depth):
            byte = F.shiftright("key", 8 * (back + 1)).bitwiseAND(F.lit(255))
            low += F.shiftleft(byte, 8 * (DEPTH - 1 - back))
        kept = table.where("gain > 1").select(
            F.lit(depth).alias("depth"),
            "key",
            F.log10("p").cast("float").alias("p"),
            F.log10(weight / (F.col("total") + weight)).cast("float").alias("rest"),
            low.alias("low"),
            (low + F.lit(1 << 8 * (DEPTH - depth))).alias("high"),
        )
        parts.append(kept)
    return reduce(DataFrame.unionByName, parts)


def places(wanted: np.ndarray) -> np.ndarray:
    """The number of each key's context."""
    return (wanted >> np.uint64(8)).byteswap() >> np.uint64(64 - 8 * DEPTH)


def ranges(tables: list[DataFrame], entries: int = ENTRIES) -> list[tuple[int, int]]:
    """Ranges of places, all of them together, whose blocks hold about ``entries`` symbols."""
    kept = _kept(tables)
    blocks = max(1, -(-kept.count() // entries))
    cuts: list[int] = []
    if blocks > 1:
        shares = [number / blocks for number in range(1, blocks)]
        cuts = kept.agg(F.percentile_approx("low", shares, 32 * blocks)).first()[0]
    edges = sorted({0, PLACES, *cuts})
    return list(zip(edges, edges[1:], strict=False))


def build(tables: list[DataFrame], low: int = 0, high: int = PLACES) -> Model:
    """All kept contexts that a place from ``low`` to ``high`` can end in."""
    block = _kept(tables).where((F.col("low") < high) & (F.col("high") > low))
    table = block.select("depth", "key", "p", "rest").toArrow()
    depths, found, p, rest = (column.to_numpy() for column in table.columns)
    kept_entries, kept_contexts = [], []
    for depth in range(DEPTH + 1):
        at = np.flatnonzero(depths == depth)
        at = at[np.argsort(found[at])]
        own = found[at].view(np.uint64)
        contexts, first = np.unique(own >> np.uint64(8), return_index=True)
        kept_entries.append((own, p[at]))
        kept_contexts.append((contexts, rest[at][first]))
    total = tables[0].agg(F.coalesce(F.max("total"), F.lit(0))).first()[0]
    return Model(kept_entries, kept_contexts, float(np.log10(0.5 / (total + 128.0))))


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


def log_probabilities(model: Model, wanted: np.ndarray) -> np.ndarray:
    """log10 probability of each key's symbol in the longest kept suffix of its context."""
    out = np.zeros(len(wanted))
    open_ = np.arange(len(wanted))
    for depth in range(DEPTH, -1, -1):
        key = wanted[open_] & np.uint64((1 << 8 * (depth + 1)) - 1)
        at, hit = _find(model.entries[depth][0], key)
        if hit.any():
            out[open_[hit]] += model.entries[depth][1][at[hit]]
        open_, key = open_[~hit], key[~hit]
        if depth and len(open_):
            at, kept = _find(model.contexts[depth][0], key >> np.uint64(8))
            if kept.any():
                out[open_[kept]] += model.contexts[depth][1][at[kept]]
    out[open_] += model.unseen
    return out


def split_of(key: str):
    """The CRC-32 of the id's text modulo 5; null for a null id."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


class Words(NamedTuple):
    """Training tokens, distinct ones, texts, and the most frequent words' sorted hashes and
    counts."""

    tokens: int
    distinct: int
    texts: int
    hashes: np.ndarray
    counts: np.ndarray


def held_words(counted: DataFrame) -> tuple[Words, DataFrame]:
    """Totals and the words that every task holds, and (key, count) of the others."""
    words = counted.where("kind = 1").select("key", "count")
    texts = counted.where("kind = 2").agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    size = F.floor(F.log2("count")).alias("size")
    by_size = words.groupBy(size).agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("sum"))
    rows = {row["size"]: row for row in by_size.collect()}
    least, room = max(rows, default=0) + 1, HELD_WORDS
    while least and room >= (rows[least - 1]["n"] if least - 1 in rows else 0):
        least -= 1
        room -= rows[least]["n"] if least in rows else 0
    held = words.where(F.col("count") >= F.lit(1 << least)).toArrow()
    hashes, counts = (column.to_numpy() for column in held.columns)
    hashes = hashes.view(np.uint64)
    order = np.argsort(hashes)
    tokens = sum(row["sum"] for row in rows.values()) + texts
    distinct = sum(row["n"] for row in rows.values()) + (texts > 0)
    found = Words(
        int(tokens), int(distinct), int(texts), hashes[order], counts[order]
    )
    return found, words.where(F.col("count") < F.lit(1 << least))


def score(
    df: DataFrame, key: str = "doc_id", text: str = "text", entries: int = ENTRIES
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score).

    One row per input row, repeated rows included. Rows whose id falls into fold 1 are held out; a
    null id is neither held out nor learned from. A null or empty text has one token, its end. With
    nothing to learn from, all bytes are equally likely. Other columns are not read. A tree of more
    than one block takes one pass over the texts for each, which are checkpointed with their row
    numbers before; neither the driver nor a task holds more than one block.
    """
    spark = df.sparkSession
    frame = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    counted = count(frame.where(split_of("id") != 1).withColumn("text", F.coalesce("text", F.lit(""))))
    words, rare = held_words(counted)
    tables = levels(counted)
    parts = ranges(tables, entries)
    frame = frame.select(F.monotonically_increasing_id().alias("row"), "text", "id")
    if len(parts) > 1:
        frame = checkpointed(frame)

    def sums(tree: Model, texts: Texts, n: int, low: int, high: int) -> np.ndarray:
        """Of each text, the log10 probability of its places from ``low`` to ``high``."""
        wanted, doc = keys(texts), texts.doc
        if (low, high) != (0, PLACES):
            place = places(wanted)
            own = (place >= np.uint64(low)) & (place < np.uint64(high))
            wanted, doc = wanted[own], doc[own]
        distinct, which = np.unique(wanted, return_inverse=True)
        # Where no place is in the range, bincount makes integers whatever its weights are.
        return np.bincount(doc, log_probabilities(tree, distinct)[which], n).astype(float)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, known = shared.value
        base = np.log10(known.tokens + 0.5 * (known.distinct + 1))
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = read(part.column(1))
                n = part.num_rows
                total = sums(tree, texts, n, *parts[0])
                tokens = np.bincount(texts.word_doc, minlength=n) + 1
                names, which = np.unique(texts.words, return_inverse=True)
                at, held = _find(known.hashes, names)
                logs, held_at = np.zeros(len(names)), at[held]
                logs[held] = np.log10(known.counts[held_at] + 0.5) - base
                bases = np.bincount(texts.word_doc, logs[which], n).astype(float)
                bases += np.log10(known.texts + 0.5) - base
                seen = np.bincount(texts.word_doc, held[which], n).astype(np.int64)
                seen += known.texts > 0
                others = ~held[which]
                code = texts.word_doc[others] << 32 | which[others]
                pairs, times = np.unique(code, return_counts=True)
                rows = part.column(0)
                yield _batch(
                    [rows, part.column(2), tokens, seen, bases, total, pa.nulls(n, pa.int64())]
                )
                m = len(pairs)
                word = names[pairs & 0xFFFFFFFF].view(np.int64)
                none = pa.nulls(m, pa.float64())
                id_none = pa.nulls(m, part.column(2).type)
                rows = rows.take(pa.array(pairs >> 32))
                yield _batch([rows, id_none, times, pa.nulls(m, pa.int64()), none, none, word])

    def _batch(columns: list) -> pa.RecordBatch:
        arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, ["row", "id", "n", "seen", "base", "score", "word"])

    kind = df.schema[key].dataType.simpleString()
    schema = f"row bigint, id {kind}, n bigint, seen bigint, base double, score double, word bigint"
    shared = spark.sparkContext.broadcast((build(tables, *parts[0]), words))
    found = checkpointed(frame.mapInArrow(first, schema))
    shared.destroy()
    texts = found.where("word IS NULL")
    others = found.where("word IS NOT NULL").select("row", "n", F.col("word").alias("key"))
    counts = rare.withColumnRenamed("count", "c")
    others = others.join(counts, "key", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    base = float(np.log10(words.tokens + 0.5 * (words.distinct + 1)))
    others = others.select(
        "row",
        F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("seen"),
        (F.col("n") * (F.log10(F.col("c") + 0.5) - base)).alias("base"),
        F.lit(0.0).alias("score"),
    )
    for part in parts[1:]:
        scored = _scored(frame, tables, part, sums)
        scored = scored.selectExpr("row", "0L AS seen", "0D AS base", "score")
        others = others.unionByName(scored)
    others = others.groupBy("row").agg(
        F.sum("seen").alias("more_seen"),
        F.sum("base").alias("more_base"),
        F.sum("score").alias("more_score"),
    )
    both = texts.join(others, "row", "left")
    return both.select(
        F.col("id").alias(key),
        F.coalesce(split_of("id") == 1, F.lit(False)).alias("held_out"),
        F.col("n").alias("n_tokens"),
        (F.col("seen") + F.coalesce("more_seen", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def _scored(frame: DataFrame, tables: list[DataFrame], part: tuple[int, int], sums) -> DataFrame:
    """(row, score): what one more block adds to each text's score."""
    shared = frame.sparkSession.sparkContext.broadcast(build(tables, *part))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text"):
                texts = read(piece.column(1), words=False)
                total = sums(shared.value, texts, piece.num_rows, *part)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(total)], ["row", "score"])

    found = checkpointed(frame.select("row", "text").mapInArrow(run, "row bigint, score double"))
    shared.destroy()
    return found
