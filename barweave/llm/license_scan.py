"""Licence scans with a generalised suffix automaton of licence texts.

The automaton of all templates is small and every task builds it. A file's words stream through it;
the matching statistics (at each word, the longest run of words ending there that some template
contains) give the maximal matches. Long ones are chained, template by template: in a chain both the
file's and the template's words move forward, with bounded gaps. A chain that covers enough of its
template is a span of that licence. Phrases that name a licence are templates too, of which every
whole occurrence counts.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.llm.batches import LOWER, byte_set, chunks, joined, spans
from barweave.llm.license_texts import PHRASES, TEMPLATES

#: Words in a match that may be chained, at least.
LEAST = 3
#: Words between two matches of a chain, at most, in the file and in the template.
GAP = 24
#: The share of a template's words that a span covers, as a percentage.
COVER = 80

#: Words are runs of ASCII digits, ASCII letters (lower-cased) and anything beyond ASCII.
WORD = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_SEPARATE = bytes(LOWER[i] if WORD[i] else 0x20 for i in range(256))

Named = tuple[tuple[str, str], ...]


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_SEPARATE).split()


class Automaton:
    """Suffix automaton of all templates and phrases: for each state its transitions, suffix link,
    longest length, the places (template, end) where its words occur, and the nearest whole phrase
    on its suffix links."""

    def __init__(self, templates: Named, phrases: Named, least: int):
        self.labels = [label for label, _ in templates]
        self.phrases = [label for label, _ in phrases]
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts = [words_of(text) for _, text in (*templates, *phrases)]
        coded = [[self.ids.setdefault(word, len(self.ids)) for word in text] for text in texts]
        self.sizes = [len(text) for text in coded[: len(templates)]]
        last = [self._insert(text) for text in coded]
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        places: list[set[tuple[int, int]]] = [set() for _ in self.length]
        for number, text in enumerate(coded[: len(templates)]):
            state = 0
            for end, word in enumerate(text, 1):
                state = self.next[state][word]
                places[state].add((number, end))
        for state in reversed(order):
            places[self.link[state]] |= places[state]
        self.places = [
            sorted(found) if length >= least else []
            for found, length in zip(places, self.length, strict=True)
        ]
        self.whole: dict[int, set[int]] = {}
        for number, state in enumerate(last[len(templates) :]):
            if state:
                self.whole.setdefault(state, set()).add(number)
        self.phrase = [-1] * len(self.length)
        for state in order:
            self.phrase[state] = state if state in self.whole else self.phrase[self.link[state]]
        pairs = {a << 32 | b for text in coded for a, b in zip(text, text[1:], strict=False)}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.alone = {text[0] for text in coded if len(text) == 1}

    def _insert(self, text: list[int]) -> int:
        last = 0
        for word in text:
            found = self.next[last].get(word)
            if found is None:
                last = self._append(last, word)
            elif self.length[found] == self.length[last] + 1:
                last = found
            else:
                last = self._split(last, word, found)
        return last

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _append(self, last: int, word: int) -> int:
        new = self._state(self.length[last] + 1, {}, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            found = self.next[last][word]
            exact = self.length[found] == self.length[last] + 1
            self.link[new] = found if exact else self._split(last, word, found)
        return new

    def _split(self, last: int, word: int, found: int) -> int:
        """A state of its own for the part of ``found`` that extends ``last``."""
        part = self._state(self.length[last] + 1, dict(self.next[found]), self.link[found])
        self.link[found] = part
        while last >= 0 and self.next[last].get(word) == found:
            self.next[last][word] = part
            last = self.link[last]
        return part

    def statistics(self, ids: list[int]) -> Iterator[tuple[int, int]]:
        """At each word: the length of the longest match that ends there, and its state."""
        state = length = 0
        following, link, lengths = self.next, self.link, self.length
        for word in ids:
            while state and word not in following[state]:
                state = link[state]
                length = lengths[state]
            if word in following[state]:
                state = following[state][word]
                length += 1
            yield length, state

    def runs(self, ids: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int]]:
        """Where words stand that some template has next to each other, or a one-word phrase:
        outside of these runs nothing long enough matches."""
        if not len(ids):
            return
        near = (ids[:-1] >= 0) & (ids[1:] >= 0) & (doc[:-1] == doc[1:])
        at = np.flatnonzero(near)
        code = ids[at] << 32 | ids[at + 1]
        place = np.searchsorted(self.pairs, code)
        place[place == len(self.pairs)] = 0
        good = np.zeros(len(ids) + 1, bool)
        if len(self.pairs):
            good[at] = self.pairs[place] == code
        follows = np.append(False, good[:-2])
        inside = good[:-1] | follows
        if self.alone:
            inside = inside | np.isin(ids, list(self.alone))
        # A run ends where the next word does not follow it in any template.
        starts = np.flatnonzero(inside & ~follows).tolist()
        ends = (np.flatnonzero(inside & ~good[:-1]) + 1).tolist()
        yield from zip(starts, ends, strict=True)


@lru_cache(maxsize=4)
def automaton(templates: Named, phrases: Named, least: int) -> Automaton:
    return Automaton(templates, phrases, least)


Match = tuple[int, int, int]  # begin in the file, end in the file, end in the template


def chains(matches: list[Match], gap: int = GAP) -> list[tuple[int, int, int]]:
    """(begin, end, covered words) of the best chains of one template's matches, no match in two.

    ``matches`` ascend by their end. A match follows another if it begins and ends after it on both
    sides and at most ``gap`` words lie between; words that overlap count once.
    """
    ends = [end for _, end, _ in matches]
    best: list[tuple[int, int]] = []
    for begin, end, stop in matches:
        size = end - begin
        most, before = size, -1
        for at in range(bisect_right(ends, begin - gap - 1), len(best)):
            low, high, halt = matches[at]
            if not (low < begin and high < end and halt < stop):
                continue
            apart = min(begin - high, stop - size - halt)  # negative: words that overlap
            if stop - size > halt + gap or halt - (high - low) >= stop - size:
                continue
            covered = best[at][0] + size + min(0, apart)
            if covered > most:
                most, before = covered, at
        best.append((most, before))
    out, used = [], set()
    for last in sorted(range(len(best)), key=lambda i: (-best[i][0], i)):
        way, at = [], last
        while at >= 0 and at not in used:
            way.append(at)
            at = best[at][1]
        used.update(way)
        if at < 0:
            out.append((matches[way[-1]][0], matches[last][1], best[last][0]))
    return out


Span = tuple[int, int, int, int]  # template, begin, end, covered


def scan_run(
    machine: Automaton, ids: list[int], shift: int, least: int, found: dict[int, list[Match]]
) -> list[tuple[int, int]]:
    """Adds the long maximal matches of a run of words to ``found``, by template, and returns the
    places (word, phrase) of whole phrases."""
    places = []
    lengths, phrase, link = machine.length, machine.phrase, machine.link
    previous = (0, 0)
    for at, (length, state) in enumerate([*machine.statistics(ids), (0, 0)]):
        if previous[0] >= least and length != previous[0] + 1:
            end = shift + at
            for template, stop in machine.places[previous[1]]:
                found.setdefault(template, []).append((end - previous[0], end, stop))
        here = phrase[state] if length else -1
        while here > 0:
            size = lengths[here]
            if size <= length:
                places.extend((shift + at + 1 - size, number) for number in machine.whole[here])
            here = phrase[link[here]]
        previous = (length, state)
    return places


def covered_spans(machine: Automaton, found: dict[int, list[Match]], cover: int):
    """The spans of one file that cover enough of a template, and the best share of any chain. A
    span within one of another template that covers more words is left out."""
    accepted, best = [], 0.0
    for template, matches in found.items():
        size = machine.sizes[template]
        for begin, end, covered in chains(matches):
            covered = min(covered, size)
            best = max(best, covered / size)
            if 100 * covered >= cover * size:
                accepted.append((template, begin, end, covered))
    out: list[Span] = []
    reach, holder = -1, 0
    for span in sorted(accepted, key=lambda s: (s[1], -s[2], -s[3], s[0])):
        if span[2] <= reach and span[3] <= holder:
            continue
        out.append(span)
        if span[2] > reach:
            reach, holder = span[2], span[3]
    return out, best


def scan_batch(
    machine: Automaton, part: pa.RecordBatch, least: int, cover: int
) -> Iterator[tuple[int, list[tuple[int, int]], list[Span], float]]:
    """For each text of the batch's second column: words, places of phrases, spans, best share."""
    data, starts = joined(part.column(1), 0x20)
    begin, end = spans(data, WORD)
    raw = LOWER[data].tobytes()
    first = np.searchsorted(begin, np.append(starts, len(data)))
    doc = np.repeat(np.arange(part.num_rows), np.diff(first))
    get = machine.ids.get
    words = zip(begin.tolist(), end.tolist(), strict=True)
    ids = np.fromiter((get(raw[a:b], -1) for a, b in words), np.int64, len(begin))
    matches: dict[int, dict[int, list[Match]]] = {}
    places: dict[int, list[tuple[int, int]]] = {}
    for a, b in machine.runs(ids, doc):
        row = int(doc[a])
        own = matches.setdefault(row, {})
        named = scan_run(machine, ids[a:b].tolist(), a - int(first[row]), least, own)
        if named:
            places.setdefault(row, []).extend(named)
    for row, size in enumerate(np.diff(first).tolist()):
        found, best = covered_spans(machine, matches.get(row, {}), cover)
        yield size, places.get(row, []), found, best


_SPAN = pa.struct(
    [("label", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]
)


def scan(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: Named = TEMPLATES,
    phrases: Named = PHRASES,
    least: int = LEAST,
    cover: int = COVER,
) -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score, spans).

    One row per input row, repeated rows and rows without id included. ``spans`` are the words of
    each licence text found, from ``begin`` up to before ``end``, with the share of its words that
    is covered; ``score`` is the largest share that any chain covers. A null or empty text has no
    words, no places and no labels. Other columns are not read, whatever their names.
    """
    kind = df.schema[key].dataType.simpleString()
    names = [key, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [kind, *["bigint"] * 4, "string", "string", "double"]
    schema = ", ".join(f"`{name}` {kind}" for name, kind in zip(names, kinds, strict=True))
    schema += ", spans array<struct<label:string,begin:bigint,end:bigint,share:double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(templates, phrases, least)
        for batch in batches:
            for part in chunks(batch, "text"):
                rows = []
                for size, places, found, best in scan_batch(machine, part, least, cover):
                    named = {machine.phrases[number] for _, number in places}
                    labels = named | {machine.labels[template] for template, *_ in found}
                    at = [place for place, _ in places]
                    rows.append(
                        (
                            size,
                            len(at),
                            min(at, default=None),
                            max(at, default=None),
                            ",".join(sorted(named)),
                            ",".join(sorted(labels)),
                            best,
                            [
                                (machine.labels[t], begin, end, covered / machine.sizes[t])
                                for t, begin, end, covered in found
                            ],
                        )
                    )
                types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(_SPAN)]
                columns = zip(zip(*rows, strict=True), types, strict=True)
                arrays = [pa.array(list(column), kind) for column, kind in columns]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], [*names, "spans"])

    return df.select(F.col(key), F.col(text).alias("text")).mapInArrow(run, schema)
