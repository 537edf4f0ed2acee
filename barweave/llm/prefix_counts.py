"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

A sequence of tokens is what BPE makes of a piece exactly if BPE keeps every two neighbours apart.
So the encoding of a prefix is the encoding of a shorter prefix plus one last token, and that token
is the only one which ends there and fits the shorter prefix's last token. One pass over a piece
stores the last token and the count at each prefix; budgets and truncation are then lookups.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barweave.llm.batches import chunks
from barweave.llm.byte_bpe import (
    BLANK,
    BLANKS,
    FRESH,
    LETTER,
    LETTERS,
    LONG,
    MORE,
    NUMBER,
    ONE_LEFT,
    OTHER,
    OTHERS,
    SHORT,
    SPACE,
    TWO_LEFT,
    classify,
    distinct_pieces,
    scan_cuts,
)

#: Distinct pieces whose counts a worker keeps before it starts afresh.
CACHE_PIECES = 1 << 19


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Runs of letters, single numbers, runs of others and contractions; blanks are pieces of
    their own here and are left out later."""
    step = np.zeros((16, 8), np.uint8)
    cut = np.ones((16, 8), bool)
    for state in range(8):
        step[LETTER, state], cut[LETTER, state] = LETTERS, state != LETTERS
        step[NUMBER, state] = FRESH
        step[OTHER, state], cut[OTHER, state] = OTHERS, state != OTHERS
        for kind, left in ((SHORT, ONE_LEFT), (LONG, TWO_LEFT)):
            step[kind, state] = OTHERS if state == OTHERS else left
            cut[kind, state] = state != OTHERS
        for kind in (SPACE, BLANK, MORE):
            step[kind, state], cut[kind, state] = BLANKS, state != BLANKS
    step[LETTER, ONE_LEFT], cut[LETTER, ONE_LEFT] = FRESH, False
    step[LETTER, TWO_LEFT], cut[LETTER, TWO_LEFT] = ONE_LEFT, False
    step[8:] = step[:8, FRESH : FRESH + 1]
    return step.reshape(-1), cut.reshape(-1)


STEP, CUT = _automaton()


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: the byte's own
    where that is printable, else the next one from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Counter:
    """Token counts under a BPE whose last symbol of each piece carries a word-end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        self.mark = model["end_of_word_suffix"] or ""
        self.tokens = set(model["vocab"])
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.longest = max(map(len, self.tokens))
        self.symbols = byte_symbols()
        self.apart: defaultdict[str, dict[str, bool]] = defaultdict(dict)
        self.known = 0
        self.totals: dict[str, int] = {}
        special = [t["content"] for t in data["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.library = Tokenizer.from_file(path).normalizer

    def merge(self, parts: list[str]) -> list[str]:
        """BPE on a short list of symbols: the pair of lowest rank, the leftmost of equals."""
        get, none = self.ranks.get, 1 << 60
        found = [get(pair, none) for pair in zip(parts, parts[1:], strict=False)]
        while found and (low := min(found)) != none:
            at = found.index(low)
            parts[at] += parts.pop(at + 1)
            del found[at]
            if at < len(found):
                found[at] = get((parts[at], parts[at + 1]), none)
            if at:
                found[at - 1] = get((parts[at - 1], parts[at]), none)
        return parts

    def split(self, token: str) -> list[str]:
        if self.mark and token.endswith(self.mark) and token != self.mark:
            body = token[: -len(self.mark)]
            return [*body[:-1], body[-1] + self.mark]
        return list(token)

    def fits(self, left: str, right: str) -> bool:
        """Whether BPE keeps the two tokens apart; left is empty at the start of a piece."""
        found = self.merge(self.split(left) + self.split(right)) == ([left] * bool(left) + [right])
        self.known += 1
        if self.known > CACHE_PIECES:
            self.apart.clear()
            self.known = 0
        self.apart[left][right] = found
        return found

    def prefixes(self, piece: str, every: bool = True) -> list[int]:
        """Tokens of each byte prefix of the piece, each taken as a piece of its own; with
        ``every`` false only of the whole piece."""
        text = "".join(map(self.symbols.__getitem__, piece.encode()))
        n, tokens, apart, fits = len(text), self.tokens, self.apart, self.fits
        mark, longest = self.mark, self.longest
        last: list[str | None] = [""] + [None] * n
        count, out = [0] * (n + 1), [0] * (n + 1)
        for begin in range(n):
            left = last[begin]
            if left is None:
                continue
            after = apart[left]
            reach = count[begin] + 1
            for end in range(begin + 1, min(n, begin + longest) + 1):
                token = text[begin:end]
                if last[end] is None and token in tokens:
                    fit = after.get(token)
                    if fits(left, token) if fit is None else fit:
                        last[end], count[end] = token, reach
                if mark and (every or end == n) and not out[end]:
                    token += mark
                    if token in tokens:
                        fit = after.get(token)
                        if fits(left, token) if fit is None else fit:
                            out[end] = reach
        return out if mark else count

    def total(self, piece: str) -> int:
        found = self.totals.get(piece)
        if found is None:
            found = self.prefixes(piece, every=False)[-1]
            if len(self.totals) >= CACHE_PIECES:
                self.totals.clear()
            if len(piece) <= 64:
                self.totals[piece] = found
        return found

    def normalise(self, text: str) -> str:
        """As the vocabulary's file has it. Texts in Latin-1 are composed already, and their lower
        case is taken character by character, so there plain lower case is the same."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.library.normalize_str(text) if self.library else text
        return text.lower()

    def segments(self, text: str) -> list[str]:
        """Normalised text between the special strings, in order."""
        if self.special and "<|" in text:
            return [self.normalise(s) for s in self.special.split(text)[::2]]
        return [self.normalise(text)]

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each whole text. A special string is one token."""
        cut = [self.segments(text) for text in texts]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = [segment for item in cut for segment in item]
        whole, points, begin, end, first = pieces_of(flat)
        at, which = distinct_pieces(points, begin, end)
        pieces = [whole[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
        each = np.fromiter(map(self.total, pieces), np.int64, len(pieces))[which]
        sums = np.concatenate(([0], np.cumsum(each)))[first]
        edges = np.concatenate(([0], np.cumsum(sizes)))
        return sums[edges[1:]] - sums[edges[:-1]] + sizes - 1

    def every_prefix(self, text: str) -> tuple[str, list[int]]:
        """The normalised text, and the token count of each of its prefixes by code points, the
        empty one first. An unfinished special string is ordinary text."""
        parts = self.special.split(text) if self.special and "<|" in text else [text]
        out, shown, before = [0], [], 0
        for at in range(0, len(parts), 2):
            segment = self.normalise(parts[at])
            mark = parts[at + 1] if at + 1 < len(parts) else ""
            counts = self._plain_prefixes(segment + mark)
            out += [before + c for c in counts[1 : len(segment) + len(mark)]]
            before += counts[len(segment)] + bool(mark)
            if segment + mark:
                out.append(before)
            shown += [segment, mark]
        return "".join(shown), out

    def _plain_prefixes(self, text: str) -> list[int]:
        out, before = [0], 0
        _, _, begin, end, _ = pieces_of([text])
        stop = 0
        for a, b in zip(begin.tolist(), end.tolist(), strict=True):
            out += [before] * (a - stop)
            piece, stop = text[a:b], b
            counts = self.prefixes(piece)
            ends = np.cumsum([len(c.encode()) for c in piece]).tolist()
            at = [counts[e] for e in ends]
            if len(piece) == 3 and piece[0] == "'" and piece[1].isalpha():
                at[1] = at[0] + self.total(piece[1])  # half a contraction is two pieces
            out += [before + c for c in at]
            before += at[-1]
        return out + [before] * (len(text) - stop)


def pieces_of(texts: list[str]):
    """The texts run together, their code points, where pieces other than blanks begin and end, and
    for each text the index of its first piece (and the count of all)."""
    whole = "".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    edges = np.concatenate(([0], np.cumsum(lengths)))
    if not len(points):
        none = np.zeros(0, np.int64)
        return whole, points, none, none, np.zeros(len(texts) + 1, np.int64)
    first = np.zeros(len(points), bool)
    first[edges[:-1][lengths > 0]] = True
    kind = classify(points, first)
    begin = scan_cuts(kind, STEP, CUT)
    end = np.append(begin[1:], len(points))
    solid = ~np.isin(kind[begin] & 7, (SPACE, BLANK, MORE))
    begin, end = begin[solid], end[solid]
    return whole, points, begin, end, np.searchsorted(begin, edges)


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(
    df: DataFrame, path: str, limit: int = 2048, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of each whole text.

    One row per input row, repeated rows included; a null or empty text has 0 bytes and 0 tokens;
    a null key stays null; other columns are not read, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = counter(path)
        for batch in batches:
            for part in chunks(batch, "text"):
                counts = words.counts(part.column(1).to_pylist())
                sizes = pa.compute.binary_length(part.column(1)).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), sizes, pa.array(counts), pa.array(counts > limit)], names
                )

    names = [key, "n_bytes", "n_tokens", "over_limit"]
    kind = df.schema[key].dataType.simpleString()
    frame = df.select(F.col(key), F.col(text).alias("text"))
    schema = f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return frame.mapInArrow(run, schema)


def prefix_counts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, normalised, counts): ``counts[i]`` is the exact token count of the first ``i`` code
    points of the normalised text, up to the whole text. A null text counts as empty: ``[0]``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = counter(path)
        for batch in batches:
            for part in chunks(batch, "text"):
                made = [words.every_prefix(row) for row in part.column(1).to_pylist()]
                shown = pa.array([m[0] for m in made], pa.string())
                counts = pa.array([m[1] for m in made], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), shown, counts], names)

    names = [key, "normalised", "counts"]
    kind = df.schema[key].dataType.simpleString()
    frame = df.select(F.col(key), F.col(text).alias("text"))
    return frame.mapInArrow(run, f"`{key}` {kind}, normalised string, counts array<int>")


def truncate(prefixes: DataFrame, budget: int) -> DataFrame:
    """Adds ``cut``, the longest prefix of at most ``budget`` tokens, and ``cut_tokens``, its count,
    to the rows of ``prefix_counts`` by lookup, without encoding again. Counts may fall when a
    prefix grows by one character, so the last prefix within the budget is meant."""
    fits = F.transform("counts", lambda c, i: F.when(c <= budget, i))
    length = F.array_max(fits)
    return prefixes.withColumns(
        {
            "cut": F.col("normalised").substr(F.lit(1), length),
            "cut_tokens": F.element_at("counts", length + 1),
        }
    )
