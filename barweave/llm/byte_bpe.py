"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

The usual split pattern (contractions, runs of letters, of numbers, of other characters, each with
one leading space, and white space) is a small automaton over character classes. Its steps are
functions from state to state, and composing functions is associative, so a whole chunk of
documents is scanned at once: lanes of the chunk are composed side by side, the lanes' functions
are scanned by doubling, and a replay from each lane's known start state yields the boundaries.
No regular expression touches the text. Lookahead (the last white space of a run, the letters of a
contraction) is folded into the classes by comparing the code point array with itself shifted.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.llm.batches import chunks, mix, ragged, range_hashes

#: Merged pieces kept by a worker before it starts afresh, about 30 MB of them.
CACHE_PIECES = 1 << 17
LANE = 128

LETTER, NUMBER, OTHER, SHORT, LONG, SPACE, BLANK, MORE = range(8)
FRESH, LETTERS, NUMBERS, OTHERS, SPACED, BLANKS, ONE_LEFT, TWO_LEFT = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece begins, by (class, state). The classes are: letter, number,
    other, an apostrophe with one or two letters of a contraction after it, the last space and the
    last other blank before a non-blank, and any blank followed by a blank or the end. Classes
    8..15 are the same at the first character of a document, where the state before is forgotten.
    """
    step = np.zeros((16, 8), np.uint8)
    cut = np.ones((16, 8), bool)
    for state in range(8):
        for kind, run in ((LETTER, LETTERS), (NUMBER, NUMBERS), (OTHER, OTHERS)):
            step[kind, state] = run
            cut[kind, state] = state not in (run, SPACED)
        for kind, left in ((SHORT, ONE_LEFT), (LONG, TWO_LEFT)):
            joins = state in (OTHERS, SPACED)
            step[kind, state] = OTHERS if joins else left
            cut[kind, state] = not joins
        step[SPACE, state], step[BLANK, state], step[MORE, state] = SPACED, FRESH, BLANKS
        cut[MORE, state] = state != BLANKS
    step[LETTER, ONE_LEFT], cut[LETTER, ONE_LEFT] = FRESH, False
    step[LETTER, TWO_LEFT], cut[LETTER, TWO_LEFT] = ONE_LEFT, False
    step[8:] = step[:8, FRESH : FRESH + 1]
    return step.reshape(-1), cut.reshape(-1)


STEP, CUT = _automaton()


@lru_cache(1)
def character_classes() -> np.ndarray:
    """LETTER, NUMBER, MORE (white space) or OTHER for every code point, as the encoder library's
    own pattern engine sees them."""
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", MORE)):
        single = {bytes([i]): i for i in range(256)}
        found = tiktoken.Encoding("one", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        kept = bytes(found.encode_ordinary(points)).decode()
        table[np.frombuffer(kept.encode("utf-32-le"), np.uint32)] = kind
    return table


def classify(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The automaton's class of every code point; ``first`` marks those that begin a document."""
    n = len(points)
    kind = character_classes()[points]
    one = np.append(points[1:], 0)
    two = np.append(points[2:], [0, 0])[:n]
    last = np.append(first[1:], True)
    ends_next = np.append(last[1:], True)
    one = np.where(last, 0, one)
    two = np.where(last | ends_next, 0, two)
    blank = kind == MORE
    followed = ~np.append(blank[1:], True) & ~last
    kind[blank & followed] = BLANK
    kind[blank & followed & (points == 0x20)] = SPACE
    mark = points == 0x27
    if mark.any():
        at = np.flatnonzero(mark)
        a, b = one[at], two[at]
        short = np.isin(a, [ord(c) for c in "stmd"])
        long = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (
            b == ord("l")
        )
        kind[at[short]] = SHORT
        kind[at[long]] = LONG
    kind[first] += 8
    return kind


def scan_cuts(kind: np.ndarray, step: np.ndarray = STEP, cut: np.ndarray = CUT) -> np.ndarray:
    """Where pieces begin, from a scan of transition functions over the classes."""
    n = len(kind)
    lanes = max(1, -(-n // LANE))
    grid = np.full(lanes * LANE, MORE, np.uint8)
    grid[:n] = kind
    columns = np.ascontiguousarray(grid.reshape(lanes, LANE).T).astype(np.intp) * 8
    function = np.tile(np.arange(8, dtype=np.uint8), (lanes, 1))
    for column in columns:  # a lane's function: its characters' functions one after the other
        function = step[column[:, None] + function]
    shift = 1
    while shift < lanes:  # inclusive scan: earlier functions are applied first
        later = np.take_along_axis(function[shift:], function[:-shift].astype(np.intp), 1)
        function = np.concatenate((function[:shift], later))
        shift *= 2
    state = np.concatenate((np.full(1, FRESH, np.uint8), function[:-1, FRESH]))
    cuts = np.empty((LANE, lanes), bool)
    for j, column in enumerate(columns):
        at = column + state
        cuts[j] = cut[at]
        state = step[at]
    return np.flatnonzero(cuts.T.reshape(-1)[:n])


def distinct_pieces(
    points: np.ndarray, begin: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """One index for each distinct piece, and each piece's place among them. Pieces are grouped by
    a hash; should one differ from its group's, every piece is its own."""
    hashes = range_hashes(mix(points.astype(np.uint64)), begin, end)
    _, at, which = np.unique(hashes, return_index=True, return_inverse=True)
    size = end - begin
    if (size[at][which] != size).any() or (
        points[ragged(begin[at][which], size)] != points[ragged(begin, size)]
    ).any():
        at = which = np.arange(len(begin))
    return at, which


def split_texts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts run together, where pieces begin in code points (and the end), and for each text
    the index of its first piece (and the count of all)."""
    whole = "".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(lengths)))
    first = np.zeros(len(points), bool)
    first[begins[:-1][lengths > 0]] = True
    cuts = scan_cuts(classify(points, first)) if len(points) else np.zeros(0, np.int64)
    return whole, np.append(cuts, len(points)), np.searchsorted(cuts, begins)


class Vocabulary:
    """Ranks of a byte-level BPE, its pieces merged so far, and each id's bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        tokens = {rank: token for token, rank in self.ranks.items()}
        ordered = [tokens.get(rank, b"") for rank in range(max(tokens, default=-1) + 1)]
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)
        self.sizes = np.fromiter(map(len, ordered), np.int64, len(ordered))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pieces: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the pair of lowest rank joins first, the leftmost of equals."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) > 48:
            return self._merge_long(piece)
        get, none = ranks.get, 1 << 60
        parts = [piece[i : i + 1] for i in range(len(piece))]
        found = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while found and (low := min(found)) != none:
            at = found.index(low)
            parts[at] += parts.pop(at + 1)
            del found[at]
            if at < len(found):
                found[at] = get(parts[at] + parts[at + 1], none)
            if at:
                found[at - 1] = get(parts[at - 1] + parts[at], none)
        return [ranks[part] for part in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap of candidate pairs: n log n for runs of any length."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        alive = [True] * n
        heap = []

        def offer(at: int) -> None:
            if end[at] < n:
                rank = ranks.get(piece[at : end[end[at]]])
                if rank is not None:
                    heapq.heappush(heap, (rank, at, end[end[at]]))

        for at in range(n):
            offer(at)
        while heap:
            _, at, stop = heapq.heappop(heap)
            if not alive[at] or end[at] >= n or end[end[at]] != stop or end[at] == stop:
                continue
            alive[end[at]] = False
            end[at] = stop
            if stop < n:
                before[stop] = at
                offer(at)
            if before[at] >= 0:
                offer(before[at])
        return [ranks[piece[at : end[at]]] for at in range(n) if alive[at]]

    def packed(self, piece: str) -> bytes:
        """The piece's ids as little-endian unsigned 32-bit integers."""
        found = self.pieces.get(piece)
        if found is None:
            found = np.array(self.merge(piece.encode()), "<u4").tobytes()
            if len(self.pieces) >= CACHE_PIECES:
                self.pieces.clear()
            if len(piece) <= 64:
                self.pieces[piece] = found
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's ids begin (and the count of all). Each
        distinct piece is looked up once."""
        whole, cuts, first = split_texts(texts)
        begin, end = cuts[:-1], cuts[1:]
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        at, which = distinct_pieces(points, begin, end)
        get, packed = self.pieces.get, self.packed
        pieces = [whole[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
        found = [get(piece) or packed(piece) for piece in pieces]
        pool = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        start = np.cumsum(size) - size
        sizes = size[which]
        ids = pool[ragged(start[which], sizes)]
        return ids, np.concatenate(([0], np.cumsum(sizes)))[first]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.bytes[ragged(self.starts[ids], self.sizes[ids])].tobytes()


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _map(df: DataFrame, key: str, text: str, path: str, schema: str, row) -> DataFrame:
    """``row(vocabulary, ids)`` gives the columns after the key, for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for part in chunks(batch, "text"):
                ids, first = words.encode(part.column(1).to_pylist())
                edges = first.tolist()
                made = [row(words, ids[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
                columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    kind = df.schema[key].dataType.simpleString()
    names = [key, *(item.split()[0] for item in schema.split(", "))]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    types = [kinds[item.split()[1]] for item in schema.split(", ")]
    frame = df.select(F.col(key), F.col(text).alias("text"))
    return frame.mapInArrow(run, f"`{key}` {kind}, {schema}")


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, ends): the token ids of each whole text and where each token ends in its UTF-8
    bytes, so that any span can be decoded alone.

    One row per input row, repeated rows included; a null or empty text gives empty arrays; a null
    key stays null; other columns are not read, whatever their names.
    """

    def row(words: Vocabulary, ids: np.ndarray):
        return ids.astype(np.int32), np.cumsum(words.sizes[ids]).astype(np.int32)

    return _map(df, key, text, path, "ids array<int>, ends array<int>", row)


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text): the text of each row's ids; ids of part of a character decode to U+FFFD. A null
    array gives an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            texts = [
                words.decode(np.array(row or [], np.int64)).decode(errors="replace")
                for row in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names)

    names = [key, "text"]
    kind = df.schema[key].dataType.simpleString()
    frame = df.select(F.col(key), F.col(ids).alias("ids"))
    return frame.mapInArrow(run, f"`{key}` {kind}, text string")


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of each whole text, encoded and decoded again
    in one pass; the cases are those of ``encode``."""

    def row(words: Vocabulary, ids: np.ndarray):
        return (
            len(ids),
            hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
            hashlib.sha256(words.decode(ids)).hexdigest(),
        )

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _map(df, key, text, path, schema, row)
