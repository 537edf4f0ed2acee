"""Similarity self-join on word shingles with token-combination prefixes.

Two texts link when the Jaccard similarity of their sets of five-word shingles is at least 0.8. The
tokens of a set (its shingles) are put in one global order, rare ones first. A set of n tokens can
miss at most t = n - ceil(0.8 n) of them in a linked set, so it indexes a prefix that survives any t
losses: rare tokens one by one, frequent ones as combinations of two. A combination matches far
fewer sets than a frequent token does, but more tokens must survive to keep one, so the prefix is
extended: frequent tokens fall into groups by a hash, only tokens of one group are combined, and
wiping out a group of g tokens takes g - 1 losses. The prefix grows until wiping out everything it
indexes takes t + 1. Two linked sets then share an entry of the index, and every pair found through
one is verified on the whole sets.

How frequent a token is comes from counts of all shingles of all documents in ``COUNTERS`` hashed
counters. They only choose order and classes: any counts give the same links.

An entry of at most ``DENSE`` sets makes candidate pairs of its sets; a pair is verified once, however
many entries it shares. Larger entries make no pairs: the sets that such entries connect are a
cluster, its sets are dealt out to blocks, and a task compares two blocks at a time by products of
their tokens, so a set is sent once for each block of its cluster and not once for each set. Both
ways give the links of every set; the links connect components.

Most pairs, and most sets of a cluster, share little more than the entries that brought them
together, and their number grows faster than the input. So a first look compares sketches: one bit a
token or two, the parity of the set's tokens in each of as many groups. Every group whose parities
differ holds a token of one set alone, so the sketches bound the common tokens from above, and what
they rule out does not link. Tokens are made and sent for what is left: pairs one by one, and of a
cluster the smaller clusters that are left connected.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.llm.batches import LOWER, WORD, chunks, joined, mix, ragged, span_hashes, spans
from barweave.llm.components import components
from barweave.llm.scratch import checkpointed, release

SHINGLE = 5
#: Similarity as a percentage.
PERCENT = 80
#: Counters of token frequencies: 1 MB where every task holds them, whatever the input's size.
COUNTERS = 1 << 20
_PIECE = 1 << 14
#: A token is frequent if its counter exceeds this multiple of the mean counter, plus a margin.
FREQUENT = (4.0, 32.0)

#: Up to so many candidate documents their names (10 MB) are sent to the texts; beyond that the
#: texts are shuffled to them.
SENT_IDS = 100_000

#: Sets of an index entry that makes pairs.
DENSE = 32

#: Sets, and tokens, in one of the blocks that are compared with each other, about.
BLOCK_SETS = 1024
BLOCK_TOKENS = 1 << 17
#: The same where sketches are compared.
SKETCH_SETS = 2048
SKETCH_TOKENS = 1 << 20

_PLACE = mix(np.arange(1, SHINGLE + 2, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(column: pa.StringArray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes of all texts, ascending within each text, and where each
    text's begin (and the count of all). Words are runs of non-blanks with A-Z in lower case; a
    text of fewer words than a shingle has one shingle of all its words."""
    data, starts = joined(column, 0x20)
    data = LOWER[data]
    begin, end = spans(data, WORD)
    words = span_hashes(data, begin, end)
    first = np.searchsorted(begin, np.append(starts, len(data)))
    n_words = np.diff(first)
    n_full = np.maximum(n_words - size + 1, 0)
    at = ragged(first[:-1], n_full)
    value = np.full(len(at), size, np.uint64)
    for j in range(size):
        value += words[at + j] * _PLACE[j]
    doc = np.repeat(np.arange(len(column)), n_full)
    short = np.flatnonzero((n_words > 0) & (n_full == 0))
    whole = n_words[short].astype(np.uint64)
    for j in range(size - 1):
        there = n_words[short] > j
        whole[there] += words[first[short[there]] + j] * _PLACE[j]
    value = mix(np.concatenate((value, whole)))
    doc = np.concatenate((doc, short))
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, np.searchsorted(doc, np.arange(len(column) + 1))


def set_ids(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set; together with the set's size it names the set."""
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(value), dtype=np.uint64)))
    return mix(sums[first[1:]] - sums[first[:-1]]).astype(np.int64)


def sketches(value: np.ndarray, first: np.ndarray) -> pa.BinaryArray:
    """The parities of each set's tokens by their lowest bits: as many groups as the least power of
    two from the set's size and 64. A sketch folded in half, by exclusive or, is one of half as many
    groups."""
    n = np.diff(first)
    groups = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    ends = np.cumsum(groups)
    place = (value & np.repeat(groups - 1, n).astype(np.uint64)).astype(np.int64)
    place += np.repeat(ends - groups, n)
    odd = np.bincount(place, minlength=int(ends[-1]) if len(ends) else 0) & 1
    data = np.packbits(odd.astype(np.uint8), bitorder="little")
    offsets = np.concatenate(([0], ends >> 3)).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(n), buffers)


def _folded(own: list[bytes], size: int) -> np.ndarray:
    """Sketches of one length, a row each, folded to ``size`` bytes."""
    out = np.frombuffer(b"".join(own), np.uint8).reshape(len(own), -1)
    while out.shape[1] > size:
        half = out.shape[1] // 2
        out = out[:, :half] ^ out[:, half:]
    return out


def _possible(n: np.ndarray, m: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Whether sets of n and m tokens can link whose sketches differ in ``apart`` groups."""
    both = np.minimum((n + m - apart) // 2, np.minimum(n, m))
    return 100 * both >= PERCENT * (n + m - both)


def _near_sketches(
    left: list[bytes], n: np.ndarray, right: list[bytes], m: np.ndarray
) -> np.ndarray:
    """Which sets on the left can link with which on the right."""
    out = np.zeros((len(left), len(right)), bool)
    sides = [np.array([len(sketch) for sketch in own]) for own in (left, right)]
    for a in np.unique(sides[0]):
        rows = np.flatnonzero(sides[0] == a)
        for b in np.unique(sides[1]):
            columns = np.flatnonzero(sides[1] == b)
            if not _possible(n[rows, None], m[columns], 0).any():
                continue
            size = int(min(a, b))
            x, y = (
                np.unpackbits(_folded([own[k] for k in at], size), axis=1).astype(np.float32) * 2 - 1
                for own, at in ((left, rows), (right, columns))
            )
            apart = ((8 * size - x @ y.T) / 2).astype(np.int64)
            out[np.ix_(rows, columns)] = _possible(n[rows, None], m[columns], apart)
    return out


class Order(NamedTuple):
    """Level of each counter (its logarithm, in quarters of a doubling) and the least frequent
    level."""

    level: np.ndarray
    frequent: int


def _level(count: np.ndarray) -> np.ndarray:
    return np.minimum(4 * np.log2(count + 1.0), 255).astype(np.uint8)


def losses(n: np.ndarray | int, percent: int = PERCENT):
    """Tokens that a set of n can miss in a set it links with."""
    return n - (percent * n + 99) // 100


def signatures(value: np.ndarray, first: np.ndarray, order: Order, percent: int = PERCENT):
    """The index entries of each set: (which set, entry)."""
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    level = order.level[value & np.uint64(COUNTERS - 1)]
    by = np.lexsort((value, level, doc))
    value, level = value[by], level[by]
    rare = level < order.frequent
    need = losses(n, percent) + 1
    n_rare = np.bincount(doc[rare], minlength=len(n))
    alone = (n_rare >= need) | (n < 4)  # single tokens do; tiny sets have nothing to combine
    singles = np.where(alone, need, n_rare)
    picked = ragged(first[:-1], singles)
    sets, entries = [doc[picked]], [value[picked]]
    for at in np.flatnonzero(~alone & (n > 0)):
        tokens = value[first[at] + n_rare[at] : first[at + 1]]
        for scheme in schemes(int(n[at]), percent):
            found = combinations(tokens, int(need[at] - n_rare[at]), scheme)
            sets.append(np.full(len(found), at))
            entries.append(found)
    return np.concatenate(sets), np.concatenate(entries).astype(np.int64)


def schemes(n: int, percent: int = PERCENT) -> list[int]:
    """Powers of two up to the set's size and up to the least size it links with: two linked sets
    use the scheme of the smaller one."""
    least = -(-n * percent // 100)
    own, low = n.bit_length() - 1, max(least.bit_length() - 1, 2)
    return list(range(min(low, own), own + 1))


def combinations(tokens: np.ndarray, cost: int, scheme: int) -> np.ndarray:
    """Hashed pairs of tokens of one group, from the shortest prefix of ``tokens`` whose groups
    take ``cost`` losses to wipe out: one less than its tokens each."""
    group = mix(tokens + np.uint64(scheme)) % np.uint64(max(1, (1 << scheme) >> 3))
    by = np.argsort(group, kind="stable")
    fresh = np.ones(len(by), bool)
    fresh[1:] = group[by][1:] != group[by][:-1]
    follows = np.empty(len(by), bool)
    follows[by] = ~fresh
    stop = int(np.searchsorted(np.cumsum(follows), cost)) + 1
    tokens, group = tokens[:stop], group[:stop]
    by = np.argsort(group, kind="stable")
    tokens, group = tokens[by], group[by]
    out = []
    for apart in range(1, len(tokens)):
        same = group[apart:] == group[:-apart]
        if not same.any():
            break
        a, b = tokens[:-apart][same], tokens[apart:][same]
        low, high = np.minimum(a, b), np.maximum(a, b)
        out.append(mix(low * _PLACE[0] + mix(high + np.uint64(scheme))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _measure(df: DataFrame) -> DataFrame:
    """(doc_id, n, set_id, sketch) for each document, and (piece, counts) with each task's
    counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, np.int64)
        waiting, size = [], 0
        for batch in batches:
            for part in chunks(batch, "text"):
                value, first = shingle_sets(part.column(1))
                waiting.append(value & np.uint64(COUNTERS - 1))
                size += len(value)
                if size > COUNTERS:
                    counters += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
                    waiting, size = [], 0
                none = pa.nulls(part.num_rows, pa.int32())
                n, ids = pa.array(np.diff(first)), pa.array(set_ids(value, first))
                blank = pa.nulls(part.num_rows, pa.binary())
                made = [part.column(0), n, ids, sketches(value, first), none, blank]
                yield pa.RecordBatch.from_arrays(made, names)
        if waiting:
            counters += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
        for at in range(0, COUNTERS, _PIECE):
            if counters[at : at + _PIECE].any():
                counts = counters[at : at + _PIECE].astype(np.uint32).tobytes()
                counts = zlib.compress(counts, 1)
                null = pa.nulls(1, pa.int64())
                piece = [pa.array([at], pa.int32()), pa.array([counts])]
                row = [null, null, null, pa.nulls(1, pa.binary()), *piece]
                yield pa.RecordBatch.from_arrays(row, names)

    names = ["doc_id", "n", "set_id", "sketch", "piece", "counts"]
    schema = "doc_id bigint, n bigint, set_id bigint, sketch binary, piece int, counts binary"
    return df.select("doc_id", "text").mapInArrow(run, schema)


def _order(counted: DataFrame) -> Order:
    """The sums of all tasks' counters, in levels. The tasks' pieces are streamed, not gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums.setdefault(piece, np.zeros(_PIECE, np.int64))
                sums[piece] += np.frombuffer(zlib.decompress(counts), np.uint32)
        totals = pa.array([s.sum() for s in sums.values()], pa.int64())
        levels = pa.array([_level(s).tobytes() for s in sums.values()], pa.binary())
        pieces = pa.array(list(sums), pa.int32())
        yield pa.RecordBatch.from_arrays([pieces, levels, totals], ["piece", "level", "total"])

    pieces = counted.where("piece IS NOT NULL").select("piece", "counts").repartition("piece")
    level, total = np.zeros(COUNTERS, np.uint8), 0
    for row in pieces.mapInArrow(run, "piece int, level binary, total bigint").collect():
        level[row["piece"] : row["piece"] + _PIECE] = np.frombuffer(row["level"], np.uint8)
        total += row["total"]
    times, margin = FREQUENT
    return Order(level, int(_level(np.array(times * total / COUNTERS + margin))))


def _index(df: DataFrame, order: Order) -> DataFrame:
    """(entry, set_id, n): each set's index entries. A task enters a set once, however many of its
    documents have it."""
    shared = df.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for part in chunks(batch, "text"):
                value, first = shingle_sets(part.column(0))
                n, ids = np.diff(first), set_ids(value, first)
                keys = list(zip(ids.tolist(), n.tolist(), strict=True))
                new = np.zeros(len(n), bool)
                for at, key in enumerate(keys):
                    new[at] = n[at] > 0 and key not in seen
                    seen.add(key)
                keep = ragged(first[:-1][new], n[new])
                edges = np.concatenate(([0], np.cumsum(n[new])))
                sets, entries = signatures(value[keep], edges, shared.value)
                at = np.flatnonzero(new)[sets]
                arrays = [pa.array(entries), pa.array(ids[at]), pa.array(n[at])]
                yield pa.RecordBatch.from_arrays(arrays, ["entry", "set_id", "n"])

    return df.select("text").mapInArrow(run, "entry bigint, set_id bigint, n bigint")


def _fits(a: str, b: str):
    """Whether sets of sizes a and b can link at all."""
    return F.expr(f"100 * least({a}, {b}) >= {PERCENT} * greatest({a}, {b})")


def _near(frame: DataFrame, names: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join with names of few bytes each, sent to the frame's tasks where they are few."""
    small = names.count() <= SENT_IDS
    return frame.join(F.broadcast(names) if small else names.hint("shuffle_hash"), on, how)


def _sets(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """(s, doc, tokens) for each of ``wanted`` (set_id, n, doc), made from its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                value, first = shingle_sets(part.column(1))
                n, ids = pa.array(np.diff(first)), pa.array(set_ids(value, first))
                edges = zip(first[:-1].tolist(), first[1:].tolist(), strict=True)
                tokens = pa.array([value[a:b].tobytes() for a, b in edges], pa.binary())
                same = pa.compute.and_(
                    pa.compute.equal(ids, part.column(2)), pa.compute.equal(n, part.column(3))
                )
                made = [ids, n, part.column(0), tokens]
                names = ["set_id", "n", "doc", "tokens"]
                yield pa.RecordBatch.from_arrays(made, names).filter(same)

    texts = _near(df.select(F.col("doc_id").alias("doc"), "text"), wanted, ["doc"], "inner")
    texts = texts.select("doc", "text", "set_id", "n")
    made = texts.mapInArrow(run, "set_id bigint, n bigint, doc bigint, tokens binary")
    return checkpointed(made.select(F.struct("set_id", "n").alias("s"), "doc", "tokens"))


def _verified(df: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b, u, v): the pairs of set names whose sets link, with the sets' first documents. Tokens
    are compared of the pairs that sketches leave."""
    return checkpointed(_linked(df, checkpointed(_sketched(pairs, classes)), classes))


def _sketched(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose sketches do not rule a link out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(at).field("n").to_numpy() for at in (0, 1))
            apart = np.zeros(batch.num_rows, np.int64)
            both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            for at, (x, y) in enumerate(both):
                size = min(len(x), len(y))
                x, y = (int.from_bytes(_folded([own], size).tobytes()) for own in (x, y))
                apart[at] = (x ^ y).bit_count()
            yield batch.select(["a", "b"]).filter(pa.array(_possible(n, m, apart), pa.bool_()))

    left, right = (
        classes.selectExpr(f"struct(set_id, n) AS {end}", f"sketch AS {own}")
        for end, own in (("a", "x"), ("b", "y"))
    )
    found = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return found.mapInArrow(run, f"a {_NAME}, b {_NAME}")


def _linked(df: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs, with their documents, whose tokens are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.count_nonzero(np.isin(x, y))
                good.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select(["a", "b", "u", "v"]).filter(pa.array(good, pa.bool_()))

    left, right = (pairs.select(F.col(end).alias("s")).distinct() for end in ("a", "b"))
    named = classes.withColumn("s", F.struct("set_id", "n"))
    wanted = named.join(left.union(right).distinct(), "s").select("set_id", "n", "doc")
    sets = _sets(df, checkpointed(wanted))
    left = _near(sets, left, ["s"], "left_semi").selectExpr("s AS a", "doc AS u", "tokens AS x")
    right = _near(sets, right, ["s"], "left_semi").selectExpr("s AS b", "doc AS v", "tokens AS y")
    found = pairs.join(left, "a").join(right, "b").select("a", "b", "u", "v", "x", "y")
    return found.mapInArrow(run, f"a {_NAME}, b {_NAME}, u bigint, v bigint")


_NAME = "struct<set_id:bigint,n:bigint>"


class Found(NamedTuple):
    """What the index finds.

    ``documents`` are (doc_id, n, set_id) of all rows, ``classes`` (set_id, n, doc, copies, sketch)
    of all sets with words, with their first documents, ``pairs`` (a, b, u, v) the verified links
    between sets that no large entries connect, and ``clusters`` (set_id, n, doc, copies, component)
    the sets to be compared with all others of their component.
    """

    documents: DataFrame
    classes: DataFrame
    pairs: DataFrame
    clusters: DataFrame


def search(df: DataFrame) -> Found:
    df = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    measured = checkpointed(_measure(df))
    documents = measured.where("piece IS NULL").select("doc_id", "n", "set_id")
    named = df.where(F.col("doc_id").isNotNull())
    classes = measured.where("doc_id IS NOT NULL AND n > 0").groupBy("set_id", "n")
    classes = checkpointed(
        classes.agg(
            F.min("doc_id").alias("doc"),
            F.count_distinct("doc_id").alias("copies"),
            F.min("sketch").alias("sketch"),
        )
    )

    index = checkpointed(_index(named, _order(measured)))
    # Tasks may each have entered a set. Counted before the shuffle; a large entry can be split.
    sizes = index.groupBy("entry").agg(
        F.count(F.lit(1)).alias("size"), F.min("set_id").alias("low"), F.max("set_id").alias("high")
    )
    sizes = sizes.where("low < high").select("entry", "size")
    index = checkpointed(index.join(sizes, "entry").distinct())
    del sizes

    dense = index.where(f"size > {DENSE}").selectExpr("entry", "struct(set_id, n) AS s")
    clusters = _clusters(dense, classes)
    # What made the index, over twice the input. Right after a job Spark still refers to its shuffles.
    release(df.sparkSession)
    rare = index.where(f"size <= {DENSE}").selectExpr("entry", "struct(set_id, n) AS s")
    rare = _near(
        rare, clusters.selectExpr("struct(set_id, n) AS s", "component"), ["s"], "left"
    )
    left = rare.selectExpr("entry", "s AS a", "component AS c")
    right = rare.selectExpr("entry", "s AS b", "component AS d")
    pairs = left.join(right, "entry").where("a < b AND NOT coalesce(c = d, false)")
    pairs = pairs.where(_fits("a.n", "b.n")).select("a", "b").distinct()
    verified = _verified(named, pairs, classes)
    release(df.sparkSession)
    return Found(documents, classes, verified, _tight(clusters, classes))


def _clusters(dense: DataFrame, classes: DataFrame) -> DataFrame:
    """(set_id, n, doc, copies, component): the sets that entries of ``dense`` connect. An entry
    links each of its sets with the one of smallest name, so it has as many edges as sets."""
    named = dense.join(classes.withColumn("s", F.struct("set_id", "n")), "s")
    named = checkpointed(named.select("entry", "set_id", "n", "doc", "copies"))
    first = named.groupBy("entry").agg(F.min("doc").alias("first"))
    edges = named.join(first, "entry").where("doc > first").selectExpr("first AS u", "doc AS v")
    found = components(edges)
    sets = named.drop("entry").distinct()
    return checkpointed(
        sets.join(found, sets["doc"] == found["node"], "left").selectExpr(
            "set_id", "n", "doc", "copies", "coalesce(component, doc) AS component"
        )
    )


def _dealt(clusters: DataFrame, sets: int, tokens: int) -> DataFrame:
    """The clusters' sets with ``blocks``, of about so many sets or tokens each, and ``block``."""
    size = clusters.groupBy("component").agg(
        F.count(F.lit(1)).alias("sets"), F.sum("n").alias("all")
    )
    size = size.selectExpr(
        "component", f"ceil(greatest(sets / {sets}, all / {tokens})) AS blocks"
    )
    dealt = clusters.join(size, "component")
    return dealt.withColumn("block", F.expr("pmod(xxhash64(set_id, n), blocks)"))


def _met(sets: DataFrame, columns: list[str]) -> DataFrame:
    """(component, i, j, block and the columns): each set for every two blocks of which its own is
    one, i the smaller; what meets follows each other."""
    sets = sets.withColumn("other", F.expr("explode(sequence(0L, blocks - 1))"))
    sets = sets.selectExpr(
        "component", "least(block, other) AS i", "greatest(block, other) AS j", "block", *columns
    )
    key = ["component", "i", "j"]
    return sets.repartition(*key).sortWithinPartitions(*key)


def _tight(clusters: DataFrame, classes: DataFrame) -> DataFrame:
    """The clusters, cut up into what is connected by pairs of sets whose sketches do not rule a link
    out. A set without such a pair links with none of its cluster and is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            i, j = group["i"][0].as_py(), group["j"][0].as_py()
            size, doc, block = (group[name].to_numpy() for name in ("n", "doc", "block"))
            left, right = (np.flatnonzero(block == side) for side in (i, j))
            if not len(left) or not len(right):
                continue
            own = group["sketch"].to_pylist()
            sides = ([own[k] for k in at] for at in (left, right))
            near = _near_sketches(next(sides), size[left], next(sides), size[right])
            if i == j:
                near = np.triu(near, 1)
            some = np.concatenate((near.any(axis=1), near.any(axis=0)))
            at = np.concatenate((left, right))
            columns = [doc[at[_joined(near)]][some], doc[at][some]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["u", "v"])

    sets = clusters.join(classes.select("set_id", "n", "sketch"), ["set_id", "n"])
    met = _met(_dealt(sets, SKETCH_SETS, SKETCH_TOKENS), ["n", "doc", "sketch"])
    found = components(met.mapInArrow(run, "u bigint, v bigint"))
    # Two sets of one document have no edge between them, but the document's number.
    cut = clusters.drop("component").join(found, clusters["doc"] == found["node"], "left")
    cut = checkpointed(
        cut.selectExpr("set_id", "n", "doc", "copies", "coalesce(component, doc) AS component")
    )
    several = cut.groupBy("component").count().where("count > 1").select("component")
    return checkpointed(cut.join(several, "component", "left_semi"))


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The number of common tokens of each set on the left with each on the right. Tokens of few
    pairs of sets are counted pair by pair, others by products of matrices."""
    n_left, n_right = len(left), len(right)
    row = np.repeat(np.arange(n_left), [len(tokens) for tokens in left])
    column = np.repeat(np.arange(n_right), [len(tokens) for tokens in right])
    both = np.unique(np.concatenate((*left, *right)), return_inverse=True)[1]
    x, y = both[: len(row)], both[len(row) :]
    many = int(both.max()) + 1
    times_x, times_y = np.bincount(x, minlength=many), np.bincount(y, minlength=many)
    pairs = times_x * times_y
    often = pairs * 200 > n_left * n_right
    out = np.zeros(n_left * n_right, np.int64)
    by = np.argsort(y, kind="stable")
    begin = np.cumsum(times_y) - times_y
    few = np.flatnonzero(~often[x] & (pairs[x] > 0))
    size = times_y[x[few]]
    piece = np.cumsum(size) >> 22
    for at in np.split(np.arange(len(few)), np.flatnonzero(np.diff(piece)) + 1):
        met = column[by[ragged(begin[x[few[at]]], size[at])]]
        out += np.bincount(np.repeat(row[few[at]], size[at]) * n_right + met, minlength=len(out))
    out = out.reshape(n_left, n_right)
    number = np.where(often, np.cumsum(often) - 1, -1)
    width = 2048
    for low in range(0, int(often.sum()), width):
        sides = []
        for which, token, height in ((row, x, n_left), (column, y, n_right)):
            place = number[token] - low
            own = (place >= 0) & (place < width) & often[token]
            side = np.zeros((height, width), np.float32)
            side[which[own], place[own]] = 1
            sides.append(side)
        out += (sides[0] @ sides[1].T).astype(np.int64)
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (component, i, j), which follow each other."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(at).to_numpy() for at in range(3)])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for begin, end in zip(edges, edges[1:], strict=False):
            own = tuple(key[:, begin])
            if waiting and own != last:
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(batch.slice(begin, end - begin))
            last = own
    if waiting:
        yield pa.Table.from_batches(waiting)


def _joined(near: np.ndarray) -> np.ndarray:
    """For a matrix of links between the sets on its two sides: for each set, left ones first, the
    number of the first set that it is connected with."""
    rows, columns = near.shape
    label = np.arange(rows + columns)
    none = rows + columns
    while True:
        left, right = label[:rows], label[rows:]
        reached = np.where(near, right[None, :], none).min(axis=1, initial=none)
        left = np.minimum(left, reached)
        reached = np.where(near, left[:, None], none).min(axis=0, initial=none)
        new = np.concatenate((left, np.minimum(right, reached)))
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _compared(df: DataFrame, clusters: DataFrame, pairs: bool) -> DataFrame:
    """What the comparison of all sets of each cluster finds: with ``pairs`` every link (u, v), as
    the sets' first documents. Else (set_id, n, links, u, v): how many documents the sets that a
    set links with have, and the first documents of a set that it is connected with and its own; a
    set comes once for each two blocks that have links of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            i, j = group["i"][0].as_py(), group["j"][0].as_py()
            size, ids, doc, copies, block = (
                group[name].to_numpy() for name in ("n", "set_id", "doc", "copies", "block")
            )
            # A document with two rows of one set makes it twice.
            _, once = np.unique(np.stack((ids, size)), axis=1, return_index=True)
            left, right = (once[block[once] == side] for side in (i, j))
            if not len(left) or not len(right):
                continue
            tokens = group["tokens"]
            sets = {at: np.frombuffer(tokens[int(at)].as_py(), np.uint64) for at in once}
            both = _common([sets[at] for at in left], [sets[at] for at in right])
            near = 100 * both >= PERCENT * (size[left][:, None] + size[right] - both)
            if i == j:
                near = np.triu(near, 1)
            if pairs:
                a, b = np.nonzero(near)
                for low in range(0, len(a), 1 << 16):
                    u, v = doc[left[a[low : low + (1 << 16)]]], doc[right[b[low : low + (1 << 16)]]]
                    columns = [np.minimum(u, v), np.maximum(u, v)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
                continue
            at = np.concatenate((left, right))
            links = np.concatenate((near @ copies[right], copies[left] @ near))
            some = links > 0
            reached = doc[at[_joined(near)]]
            columns = [c[some] for c in (ids[at], size[at], links, reached, doc[at])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    names = ["u", "v"] if pairs else ["set_id", "n", "links", "u", "v"]
    dealt = checkpointed(_dealt(clusters, BLOCK_SETS, BLOCK_TOKENS))
    named = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sets = _sets(named, dealt.select("set_id", "n", "doc"))
    sets = sets.selectExpr("s.set_id", "s.n", "tokens").join(dealt, ["set_id", "n"])
    met = _met(sets, ["set_id", "n", "doc", "copies", "tokens"])
    return met.mapInArrow(run, ", ".join(f"{name} bigint" for name in names))


def links(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents (doc_id, n, set_id), with null ids, and every link between two different sets
    once, as the sets' first documents (u, v), u the smaller."""
    found = search(df)
    pairs = found.pairs.selectExpr("least(u, v) AS u", "greatest(u, v) AS v")
    return found.documents, pairs.unionByName(_compared(df, found.clusters, True))


def linked_classes(df: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links), one row per input row.

    ``component_id`` is the smallest doc_id reachable by links, the document's own included;
    ``n_links`` is the number of other documents that the row's set links with. Documents with equal
    sets link; a null or empty text, or one without words, has an empty set and links with nothing.
    Rows that repeat a doc_id are one document with the links of each; such a document of several
    sets counts once for each. A row without doc_id links with nothing and has no component. Other
    columns are not read.
    """
    found = search(df)
    dense = checkpointed(_compared(df, found.clusters, False))
    named = checkpointed(
        found.documents.where("doc_id IS NOT NULL AND n > 0").join(found.classes, ["set_id", "n"])
    )
    # A document of several sets connects them.
    low = named.groupBy("doc_id").agg(F.min("doc").alias("u"), F.max("doc").alias("v"))
    low = low.where("u < v").select("doc_id", "u")
    several = named.join(low, "doc_id").where("u < doc").selectExpr("u", "doc AS v")
    edges = found.pairs.select("u", "v").unionByName(dense.select("u", "v")).unionByName(several)
    reached = components(edges)

    copies = found.classes.selectExpr("struct(set_id, n) AS other", "copies AS links")
    ends = found.pairs.selectExpr("a AS s", "b AS other")
    ends = ends.unionByName(found.pairs.selectExpr("b AS s", "a AS other")).join(copies, "other")
    count = ends.selectExpr("s.set_id", "s.n", "links")
    count = count.unionByName(dense.select("set_id", "n", "links"))
    count = count.groupBy("set_id", "n").agg(F.sum("links").alias("links"))

    classes = found.classes.join(reached, F.col("doc") == F.col("node"), "left")
    classes = classes.join(count, ["set_id", "n"], "left").selectExpr(
        "set_id",
        "n",
        "coalesce(component, doc) AS component",
        "copies - 1 + coalesce(links, 0) AS n_links",
    )
    rows = found.documents.join(classes, ["set_id", "n"], "left")
    return rows.selectExpr(
        "doc_id",
        "n AS n_shingles",
        "CASE WHEN doc_id IS NOT NULL THEN coalesce(component, doc_id) END AS component_id",
        "if(doc_id IS NULL, 0L, coalesce(n_links, 0L)) AS n_links",
    )


def classes(df: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id): ``linked_classes`` without the number of links."""
    return linked_classes(df).drop("n_links")


def distinct_documents(df: DataFrame) -> DataFrame:
    """One row of each group of rows that link, directly or not: the one of smallest doc_id.

    Every row counts. Of rows that repeat a doc_id some one has the id, and the others come, like
    rows without doc_id, after all ids: a copy goes, also if it has the id of the row that stays,
    and a row of another text stays. Rows without words stay. Columns and their order are kept.
    """
    number = F.col("doc_id").cast("bigint")
    own = df.withColumn(_OWN, number)
    repeated = own.groupBy(_OWN).agg(F.count(F.lit(1)).alias("rows"))
    repeated = checkpointed(repeated.where(f"{_OWN} IS NULL OR rows > 1").select(_OWN))
    if not repeated.isEmpty():
        again = F.broadcast(repeated) if repeated.count() <= SENT_IDS else repeated
        same = own[_OWN].eqNullSafe(again[_OWN])
        # Written once: the numbers given to these rows must not change.
        loose = own.join(again, same, "left_semi").drop(_OWN)
        loose = checkpointed(loose.withColumn("_row", F.monotonically_increasing_id()))
        first = loose.where("doc_id IS NOT NULL").groupBy(number.alias("_id"))
        first = first.agg(F.min("_row").alias("_row"))
        top = own.agg(F.max(_OWN)).first()[0] or 0
        named = loose.join(first, "_row", "left").withColumn(
            _OWN, F.coalesce("_id", F.col("_row") + F.lit(top + 1))
        )
        own = own.join(again, same, "left_anti").unionByName(named.drop("_row", "_id"))
    keys = own.select(F.col(_OWN).alias("doc_id"), "text")
    going = classes(keys).where("component_id < doc_id").select(F.col("doc_id").alias(_OWN))
    return own.join(going, _OWN, "left_anti").select(*(F.col(f"`{name}`") for name in df.columns))


_OWN = "_own_id"
