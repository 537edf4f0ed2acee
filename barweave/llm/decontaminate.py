"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton of all items' word sequences is built once per block of items. Training words stream
through it; at each word the state and the matching length say how long the longest run of words
ending there is that some item contains. A window is 13 consecutive item words, or a whole item of
fewer; every document word inside an occurrence of a window is hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.llm.batches import LOWER, byte_set, chunks, joined, spans
from barweave.llm.scratch import checkpointed

WINDOW = 13
#: Item words in one automaton, which every task holds. More items make more blocks.
BLOCK_WORDS = 100_000

#: Words are runs of ASCII digits, ASCII letters (lower-cased) and anything beyond ASCII.
WORD = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_SEPARATE = bytes(LOWER[i] if WORD[i] else 0x20 for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_SEPARATE).split()


class Automaton:
    """Generalised suffix automaton over word numbers, with the items each state's words are in."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items = [item for item, _ in items]
        holders: list[set[int]] = [set()]
        whole: dict[int, set[int]] = {}
        pairs = set()
        for number, (_, words) in enumerate(items):
            ids = [self.words.setdefault(word, len(self.words)) for word in words]
            pairs.update(a << 32 | b for a, b in zip(ids, ids[1:], strict=False))
            state = 0
            for word in ids:
                state = self._extend(state, word, holders)
                if len(ids) >= window:
                    holders[state].add(number)
            if 0 < len(ids) < window:
                whole.setdefault(state, set()).add(number)
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        for state in reversed(order):
            if self.length[self.link[state]] >= window:
                holders[self.link[state]] |= holders[state]
        self.holders = [
            tuple(sorted(h)) if self.length[s] >= window else () for s, h in enumerate(holders)
        ]
        #: The nearest state on the suffix links, itself included, that is a whole short item.
        self.short = [-1] * len(self.length)
        for state in order:
            self.short[state] = state if state in whole else self.short[self.link[state]]
        self.whole = {state: tuple(sorted(found)) for state, found in whole.items()}
        self.pairs = np.array(sorted(pairs), np.int64)
        sizes = [min(len(words), window) for _, words in items if words]
        self.least = min(sizes, default=window)

    def _extend(self, last: int, word: int, holders: list[set[int]]) -> int:
        """Adds one word after ``last``; an existing state is used where it has the right length."""
        found = self.next[last].get(word)
        if found is not None:
            if self.length[found] == self.length[last] + 1:
                return found
            return self._clone(last, word, found, holders)
        new = self._state(self.length[last] + 1, {}, 0, set(), holders)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            found = self.next[at][word]
            if self.length[found] == self.length[at] + 1:
                self.link[new] = found
            else:
                self.link[new] = self._clone(at, word, found, holders)
        return new

    def _clone(self, at: int, word: int, found: int, holders: list[set[int]]) -> int:
        copy = self._state(
            self.length[at] + 1, dict(self.next[found]), self.link[found], set(), holders
        )
        self.link[found] = copy
        while at >= 0 and self.next[at].get(word) == found:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _state(self, length, following, link, held, holders) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        holders.append(held)
        return len(self.length) - 1

    def stream(self, ids: list[int], hits: list[tuple[int, int]], items: set[int]) -> None:
        """Matches one run of words: spans of hit words (relative) and items with windows."""
        state = length = 0
        following, link, lengths, window = self.next, self.link, self.length, self.window
        for at, word in enumerate(ids):
            while state and word not in following[state]:
                state = link[state]
                length = lengths[state]
            if word in following[state]:
                state = following[state][word]
                length += 1
            if not length:
                continue
            if length >= window:
                hits.append((at - length + 1, at + 1))
                held = state
                while lengths[link[held]] >= window:
                    held = link[held]
                items.update(self.holders[held])
            short = self.short[state]
            while short > 0:
                size = lengths[short]
                if size <= length:
                    hits.append((at - size + 1, at + 1))
                    items.update(self.whole[short])
                short = self.short[link[short]]

    def candidates(self, ids: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of words that can hold a window: an occurrence consists of known words, and of
        pairs that are neighbours in some item. Nothing that matches is left out."""
        known = ids >= 0
        together = known[:-1] & known[1:] & (doc[:-1] == doc[1:])
        at = np.flatnonzero(together)
        code = ids[at] << 32 | ids[at + 1]
        place = np.searchsorted(self.pairs, code)
        place[place == len(self.pairs)] = 0
        good = np.zeros(len(ids), bool)
        if len(self.pairs):
            good[at] = self.pairs[place] == code
        begin = np.flatnonzero(good & ~np.append(False, good[:-1]))
        end = np.flatnonzero(~good & np.append(False, good[:-1])) + 1
        yield from zip(begin[end - begin >= self.least], end[end - begin >= self.least], strict=True)
        if self.least == 1:
            alone = known & ~good & ~np.append(False, good[:-1])
            for at in np.flatnonzero(alone):
                yield at, at + 1


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple]]:
    """Items with words, as (id text, words), in blocks of bounded size, streamed through the
    driver one block at a time. Null texts and null ids have no words; there is always a block."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), "text").dropna().distinct()
    for item, text in rows.sort("item_id", "text").toLocalIterator():
        words = words_of(text)
        if size and size + len(words) > block_words:
            yield block
            block, size = [], 0
        if words:
            block.append((item, words))
            size += len(words)
    yield block


Row = tuple[int, list[list[int]], list[list[int]], list[str]]


def match(automaton: Automaton, part: pa.RecordBatch) -> Iterator[Row]:
    """For each text of the batch's second column: number of words, spans of hit words, the same
    spans in bytes, and items with an occurring window."""
    data, starts = joined(part.column(1), 0x20)
    begin, end = spans(data, WORD)
    raw = LOWER[data].tobytes()
    first = np.searchsorted(begin, np.append(starts, len(data)))
    doc = np.repeat(np.arange(part.num_rows), np.diff(first))
    get = automaton.words.get
    places = zip(begin.tolist(), end.tolist(), strict=True)
    ids = np.fromiter((get(raw[a:b], -1) for a, b in places), np.int64, len(begin))
    found: dict[int, tuple[list, set]] = {}
    for a, b in automaton.candidates(ids, doc):
        hits, items = found.setdefault(int(doc[a]), ([], set()))
        local: list[tuple[int, int]] = []
        automaton.stream(ids[a:b].tolist(), local, items)
        shift = int(a - first[doc[a]])
        hits.extend((s + shift, e + shift) for s, e in local)
    for row, (low, high) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        hits, items = found.get(row, ([], set()))
        hits = union(hits)
        base = int(starts[row])
        cuts = [[int(begin[low + s]) - base, int(end[low + e - 1]) - base] for s, e in hits]
        # An id on several rows is one item.
        yield high - low, hits, cuts, sorted({automaton.items[i] for i in items})


def union(found: list) -> list[list[int]]:
    """Disjoint spans that cover the same words; spans that only touch become one."""
    out: list[list[int]] = []
    for begin, end in sorted(map(list, found)):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


_SPANS = "array<struct<begin:int,end:int>>"
_PAIRS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


def find_hits(
    spark: SparkSession,
    df: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(key, text, n_words, hits, cuts, items): hit word spans, the same spans in UTF-8 bytes, and
    the ids (as text) of the items with an occurring window.

    One row per input row, repeated rows included. A null or empty text has no words; so has a null
    item. An empty benchmark hits nothing. Other columns are not read, whatever their names. A
    benchmark of more than one block is matched block by block: each pass adds to the checkpoint of
    the one before, so a task holds one bounded automaton whatever the size of the benchmark.
    """
    found = f"text string, n_words bigint, hits {_SPANS}, cuts {_SPANS}, items array<string>"
    # The key may be a struct of columns with any names.
    named = T.StructField(key, df.schema[key].dataType)
    schema = T.StructType([named, *T.StructType.fromDDL(found)])
    frame = df.select(F.col(key), F.col(text).alias("text"))
    for number, block in enumerate(item_blocks(benchmark, block_words)):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = Automaton(shared.value, window)
            for batch in batches:
                for part in chunks(batch, "text"):
                    yield _columns(list(match(automaton, part)), part)

        if number:
            frame = checkpointed(frame)
        frame = frame.mapInArrow(run, schema)
    return frame


def _columns(rows: list[Row], part: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with what was found, joined to what earlier blocks found."""
    sizes, hits, cuts, items = (list(c) for c in zip(*rows, strict=True))
    if part.num_columns > 2:
        for old, new in ((part.column(3), hits), (part.column(4), cuts)):
            for at, before in enumerate(old.to_pylist()):
                if before:
                    new[at] = union(new[at] + [[b["begin"], b["end"]] for b in before])
        items = [sorted({*a, *b}) for a, b in zip(items, part.column(5).to_pylist(), strict=True)]
    columns = [
        pa.array(sizes, pa.int64()),
        *(pa.array([[tuple(s) for s in row] for row in c], _PAIRS) for c in (hits, cuts)),
        pa.array(items, pa.list_(pa.string())),
    ]
    names = [part.schema.names[0], "text", "n_words", "hits", "cuts", "items"]
    return pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names)


def n_hit():
    return F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])


def is_contaminated(coverage: int = 20):
    """Whether at least one word of ``coverage`` is hit."""
    return (n_hit() > 0) & (coverage * n_hit() >= F.col("n_words"))


def digests(hits: DataFrame, key: str = "doc_id") -> DataFrame:
    return hits.select(
        key,
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def without_spans():
    """The text without the bytes of its hit spans; what stood between words stays. The pieces
    between the spans are cut out of the UTF-8 bytes by the JVM: a second Python function in the
    stage would hold a second set of workers."""
    raw = F.col("text").cast("binary")
    count = F.size("cuts")

    def piece(at):
        begin = F.when(at == 0, F.lit(0)).otherwise(F.try_element_at("cuts", at)["end"])
        end = F.when(at == count, F.octet_length("text")).otherwise(
            F.try_element_at("cuts", at + 1)["begin"]
        )
        return F.substring(raw, begin + 1, end - begin)

    pieces = F.transform(F.sequence(F.lit(0), count), piece)
    joined = F.aggregate(pieces, F.lit(b""), lambda out, part: F.concat(out, part))
    return F.when(count > 0, joined.cast("string")).otherwise(F.col("text"))


def clean(spark: SparkSession, df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The input's columns without contaminated rows; shorter hits are cut out of the rows that
    stay. ``n_chars``, where there is such a column, is counted again for those."""
    others = [name for name in df.columns if name != "text"]
    packed = df.select(F.struct(*(F.col(f"`{name}`") for name in others)).alias("row"), "text")
    found = find_hits(spark, packed, benchmark, key="row")
    found = found.where(~is_contaminated()).withColumn("text", without_spans())
    out = {name: F.col(f"row.`{name}`") for name in others} | {"text": F.col("text")}
    if "n_chars" in others:
        size = F.char_length("text").cast(df.schema["n_chars"].dataType)
        out["n_chars"] = F.when(F.size("hits") > 0, size).otherwise(out["n_chars"])
    return found.select(*(out[name].alias(name) for name in df.columns))
