"""Hard negatives from Hilbert-ordered blocks with zone maps.

All rows are written once as blocks: Parquet rows of up to ``BLOCK_ROWS`` vectors that follow each
other by label and then along a Hilbert curve through the dimensions that vary most. Beside each
block stands its zone map: the least and greatest value of every dimension, and of the label. For an
anchor a, the inner product with any vector of a block lies between the sums of the least and of the
greatest of a_d * min_d and a_d * max_d. Only blocks whose interval meets what an anchor looks for
are read: for its positives, scores from the fifth best that its own block holds; for its negatives,
the windows that the positives set, cut off below at the tenth best of the blocks that look nearest.
Whatever the vectors are, the result is exact; bounds decide only what is read.

Anchors are taken in groups of bounded size. What a group sends to the driver is a few numbers for
each of its anchors.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barweave.llm.positions import SENT_BYTES
from barweave.llm.scratch import checkpointed
from barweave.session import work_dir

#: Rows of a block, and blocks of a file, about.
BLOCK_ROWS = 1024
FILE_BLOCKS = 64
#: Bytes of anchors that all tasks hold at once.
GROUP_BYTES = 8 << 20
#: Dimensions of the Hilbert curve and bits of each.
CURVE_DIMS, CURVE_BITS = 8, 7
#: Blocks read first for an anchor's negatives.
PROBES = 2

POSITIVES, NEGATIVES = 5, 10
_MOST = (1 << 63) - 1
#: A negative's score, as a percentage of the positive's.
WINDOW = (30, 90)


def usable(df: DataFrame, key: str, vector: str, label: str, relabel: int = 7) -> DataFrame:
    """(vec_id, label, v): rows that take part, components as integers floor(256 * x). A row
    without id, label or vector, or with a component that is null or not finite, takes no part."""
    number = F.col(key).cast("bigint")
    own = F.col(label).cast("bigint")
    moved = F.when(number % relabel == 0, (own + 1) % 10).otherwise(own)
    rows = df.select(number.alias("vec_id"), moved.alias("label"), F.col(vector).alias("v"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    infinite = float("inf")
    rows = rows.where(
        F.forall(
            "v",
            lambda x: x.isNotNull()
            & ~F.isnan(x.cast("double"))
            & (F.abs(x.cast("double")) != F.lit(infinite)),
        )
    )
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(256 * x.cast("double"))))


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of cells, by the transposition of its axes."""
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    if not n:
        return np.zeros(len(cells), np.int64)
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        high = one << np.uint64(bit)
        low = high - one
        for axis in range(n):
            turned = (x[axis] & high) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, 0, -1):
        high = one << np.uint64(bit)
        flip ^= np.where((x[n - 1] & high) != 0, high - one, np.uint64(0))
    x ^= flip
    place = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in range(n):
            place = (place << one) | ((x[axis] >> np.uint64(bit)) & one)
    return place.astype(np.int64)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The lists of a column as rows of ``width`` numbers; what a list lacks is 0."""
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.values)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


class Shape(NamedTuple):
    """Rows, length of the longest vector, and for the dimensions that vary most their number,
    least value and span."""

    rows: int
    width: int
    axes: np.ndarray
    least: np.ndarray
    span: np.ndarray


def _shape(rows: DataFrame) -> Shape:
    """Of all rows, from sums that every task makes of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[float]] = {}
        for batch in batches:
            column = batch.column(0)
            width = max(np.diff(np.asarray(column.offsets)), default=0)
            found = _matrix(column, width).astype(np.float64)
            for axis in range(width):
                x = found[:, axis]
                n, total, squares, low, high = sums.get(axis, (0, 0.0, 0.0, np.inf, -np.inf))
                n, total, squares = n + len(x), total + x.sum(), squares + (x * x).sum()
                sums[axis] = [n, total, squares, min(low, x.min()), max(high, x.max())]
        columns = list(zip(*([axis, *map(float, s)] for axis, s in sums.items()), strict=True))
        columns = columns or [[]] * 6
        kinds = [pa.int64()] + [pa.float64()] * 5
        arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["axis", "n", "total", "squares", "low", "high"])

    sums = rows.select("v").mapInArrow(
        run, "axis bigint, n double, total double, squares double, low double, high double"
    )
    sums = sums.groupBy("axis").agg(
        *(F.sum(name).alias(name) for name in ("n", "total", "squares")),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    # One row for each dimension.
    found = sums.orderBy("axis").toPandas()
    spread = found["squares"] / found["n"] - (found["total"] / found["n"]) ** 2
    axes = np.argsort(-spread.to_numpy(), kind="stable")[:CURVE_DIMS]
    low, high = found["low"].to_numpy()[axes], found["high"].to_numpy()[axes]
    return Shape(rows.count(), len(found), axes, low, np.maximum(high - low, 1.0))


class Blocks(NamedTuple):
    """Where the blocks and their zone maps are, and the vectors' length."""

    folder: str
    width: int

    def zones(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/zones")

    def read(self, spark: SparkSession, parts: list[int]) -> DataFrame:
        """The blocks of some parts; no other file is read."""
        paths = [f"{self.folder}/blocks/part={part}" for part in sorted(parts)]
        return spark.read.option("basePath", f"{self.folder}/blocks").parquet(*paths)


_BLOCK = "part bigint, block bigint, rows int, least_label bigint, most_label bigint, low binary, "
_BLOCK += "high binary, ids binary, labels binary, kind string, vectors binary"


def write_blocks(rows: DataFrame, shape: Shape, block_rows: int = BLOCK_ROWS) -> Blocks:
    """Sorts the rows by label and place on the curve and packs them into blocks. Equal vectors
    keep apart by their ids and a number of their own, so no range of the sort is too large."""
    spark = rows.sparkSession
    folder = work_dir(spark, "hilbert-blocks")
    width = shape.width

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _matrix(batch.column(2), width).astype(np.float64)[:, shape.axes]
            cells = (found - shape.least) / shape.span * ((1 << CURVE_BITS) - 1)
            places = hilbert(np.clip(cells, 0, (1 << CURVE_BITS) - 1), CURVE_BITS)
            names = ["vec_id", "label", "v", "tie", "curve"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places)], names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = number = 0
        for batch in batches:
            while batch.num_rows:
                piece = batch.slice(0, block_rows - size)
                batch = batch.slice(piece.num_rows)
                waiting.append(piece)
                size += piece.num_rows
                if size == block_rows:
                    yield _packed(waiting, number, width)
                    waiting, size, number = [], 0, number + 1
        if size:
            yield _packed(waiting, number, width)

    tied = checkpointed(rows.withColumn("tie", F.monotonically_increasing_id()))
    schema = "vec_id bigint, label bigint, v array<bigint>, tie bigint, curve bigint"
    keyed = checkpointed(tied.mapInArrow(place, schema))
    parts = max(1, -(-shape.rows // (block_rows * FILE_BLOCKS)))
    parts = max(parts, min(shape.rows // block_rows, spark.sparkContext.defaultParallelism))
    keys = ["label", "curve", "vec_id", "tie"]
    dealt = keyed.repartitionByRange(parts or 1, *keys).sortWithinPartitions(*keys)
    packed = dealt.select("vec_id", "label", "v", F.spark_partition_id().alias("part"))
    packed = packed.mapInArrow(pack, _BLOCK)
    packed.write.partitionBy("part").parquet(f"{folder}/blocks")
    schema = f"{_BLOCK.removeprefix('part bigint, ')}, part bigint"
    blocks = spark.read.schema(schema).parquet(f"{folder}/blocks")
    zones = blocks.select("part", "block", "rows", "least_label", "most_label", "low", "high")
    zones.write.parquet(f"{folder}/zones")
    return Blocks(folder, width)


def _packed(waiting: list[pa.RecordBatch], number: int, width: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(waiting).combine_chunks()
    vectors = _matrix(table["v"].chunk(0), width)
    labels = table["label"].to_numpy()
    ids = table["vec_id"].to_numpy()
    if width:
        low, high = vectors.min(axis=0), vectors.max(axis=0)
    else:
        low = high = np.zeros(0, np.int64)
    part = table["part"][0].as_py()
    row = {
        "part": (part, pa.int64()),
        # Numbers of blocks are unique over all parts.
        "block": (part << 32 | number, pa.int64()),
        "rows": (len(ids), pa.int32()),
        "least_label": (int(labels.min()), pa.int64()),
        "most_label": (int(labels.max()), pa.int64()),
    }
    for name, values in (("low", low), ("high", high), ("ids", ids), ("labels", labels)):
        row[name] = (values.astype("<i8").tobytes(), pa.binary())
    reach = max(-int(low.min()), int(high.max()), 0) if width else 0
    kind = "<i2" if reach < 1 << 15 else "<i4" if reach < 1 << 31 else "<i8"
    row["kind"] = (kind, pa.string())
    row["vectors"] = (vectors.astype(kind).tobytes(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in row.values()], list(row))


def _vectors(row: dict, rows: int, width: int) -> np.ndarray:
    return np.frombuffer(row["vectors"], row["kind"]).reshape(rows, width).astype(np.int64)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact products of integer rows; in doubles where no sum can leave their integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = int(max(abs(int(a.min())), abs(int(a.max()))))
    reach = most * int(max(abs(int(b.min())), abs(int(b.max())))) * a.shape[1]
    if reach < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if reach < 1 << 63:
        return a @ b.T
    # Fails where a score is no long.
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


class Group(NamedTuple):
    """Anchors: their blocks and places, ids, labels and vectors."""

    block: np.ndarray
    at: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    vectors: np.ndarray


def bounds(group: Group, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor and each box from low to high, the interval that holds the products of the
    anchor with any vector in the box."""
    up, down = np.maximum(group.vectors, 0), np.minimum(group.vectors, 0)
    return product(up, low) + product(down, high), product(up, high) + product(down, low)


def anchor_groups(spark: SparkSession, blocks: Blocks, every: int, size: int) -> Iterator[Group]:
    """The rows whose id ``every`` divides, ``size`` at a time, with where they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                at = np.flatnonzero(ids % every == 0)
                if not len(at):
                    continue
                vectors = _vectors(row, len(ids), blocks.width)[at]
                columns = [
                    np.full(len(at), row["block"]),
                    at,
                    ids[at],
                    np.frombuffer(row["labels"], "<i8")[at],
                    [v.tobytes() for v in vectors],
                ]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names)

    names = ["block", "at", "vec_id", "label", "vector"]
    schema = "block bigint, at bigint, vec_id bigint, label bigint, vector binary"
    stored = spark.read.parquet(f"{blocks.folder}/blocks")
    found = checkpointed(stored.select("block", "ids", "labels", "kind", "vectors").mapInArrow(run, schema))
    waiting = []
    for row in found.toLocalIterator():
        waiting.append(row)
        if len(waiting) == size:
            yield _group(waiting, blocks.width)
            waiting = []
    if waiting:
        yield _group(waiting, blocks.width)


def _group(rows: list, width: int) -> Group:
    columns = [np.array([row[name] for row in rows], np.int64) for name in ("block", "at", "vec_id", "label")]
    vectors = np.frombuffer(b"".join(row["vector"] for row in rows), "<i8")
    return Group(*columns, vectors.reshape(len(rows), width))


class Zones(NamedTuple):
    """Some blocks' zone maps, and for each anchor and block the interval of the products."""

    part: np.ndarray
    block: np.ndarray
    least_label: np.ndarray
    most_label: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray
    most: np.ndarray


def zones_of(batches: Iterator[pa.RecordBatch], group: Group) -> Iterator[Zones]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            plain = [part[name].to_numpy() for name in ("part", "block", "least_label", "most_label")]
            box = [
                np.frombuffer(b"".join(part[name].to_pylist()), "<i8").reshape(part.num_rows, -1)
                for name in ("low", "high")
            ]
            yield Zones(*plain, *box, *bounds(group, *box))


#: Which anchors (rows) read which blocks (columns).
Rule = Callable[[Group, Zones], np.ndarray]


def chosen(spark: SparkSession, blocks: Blocks, group: Group, rule: Rule) -> DataFrame:
    """(part, block, anchors): the blocks that some anchor reads, with a bit for each anchor."""
    shared = spark.sparkContext.broadcast(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for zones in zones_of(batches, shared.value):
            needed = rule(shared.value, zones)
            some = np.flatnonzero(needed.any(axis=0))
            bits = [np.packbits(needed[:, at]).tobytes() for at in some]
            columns = [zones.part[some], zones.block[some], pa.array(bits, pa.binary())]
            arrays = [pa.array(column) for column in columns]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "block", "anchors"])

    schema = "part bigint, block bigint, anchors binary"
    return checkpointed(blocks.zones(spark).mapInArrow(run, schema))


def nearest(spark: SparkSession, blocks: Blocks, group: Group, target: np.ndarray) -> DataFrame:
    """(part, block, anchors): for each anchor with a target, the ``PROBES`` blocks with other
    labels whose middle has the product closest to it."""
    shared = spark.sparkContext.broadcast((group, target))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, wanted = shared.value
        n = len(wanted)
        apart = np.full((n, PROBES), np.inf)
        place = np.full((n, PROBES, 2), -1, np.int64)
        for zones in zones_of(batches, anchors):
            middle = (zones.low.astype(np.float64) + zones.high) / 2
            far = np.abs(anchors.vectors @ middle.T - wanted[:, None])
            far[~others(anchors, zones) | np.isnan(far)] = np.inf
            far = np.hstack((apart, far))
            own = np.stack((zones.part, zones.block), axis=1)
            places = np.concatenate((place, np.broadcast_to(own, (n, *own.shape))), axis=1)
            order = np.argsort(far, axis=1, kind="stable")[:, :PROBES]
            apart = np.take_along_axis(far, order, 1)
            place = np.take_along_axis(places, order[:, :, None], 1)
        anchor, rank = np.nonzero(np.isfinite(apart))
        columns = [anchor, apart[anchor, rank], *place[anchor, rank].T]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names)

    names = ["anchor", "apart", "part", "block"]
    found = blocks.zones(spark).mapInArrow(run, "anchor bigint, apart double, part bigint, block bigint")
    order = Window.partitionBy("anchor").orderBy("apart", "block")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROBES)
    bits: dict[tuple[int, int], np.ndarray] = {}
    for row in found.select("anchor", "part", "block").collect():
        own = bits.setdefault((row["part"], row["block"]), np.zeros(len(group.at), bool))
        own[row["anchor"]] = True
    rows = [(*key, bytearray(np.packbits(own).tobytes())) for key, own in bits.items()]
    return spark.createDataFrame(rows, "part bigint, block bigint, anchors binary")


def others(group: Group, zones: Zones) -> np.ndarray:
    """Which blocks hold a row of another label than the anchor's."""
    own = group.label[:, None]
    return (zones.least_label != own) | (zones.most_label != own)


def holds(group: Group, zones: Zones) -> np.ndarray:
    """Which blocks can hold a row of the anchor's label."""
    own = group.label[:, None]
    return (zones.least_label <= own) & (own <= zones.most_label)


Kept = tuple[np.ndarray, np.ndarray]  # scores and ids


def best(scores: np.ndarray, ids: np.ndarray, most: int) -> Kept:
    """The first rows by falling score, then by id."""
    if len(scores) > most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        near = scores >= least
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores))[:most]
    return scores[order], ids[order]


def read(
    spark: SparkSession,
    blocks: Blocks,
    group: Group,
    picked: DataFrame,
    windows: np.ndarray | None,
    most: int,
) -> DataFrame:
    """(anchor, window, score, vec_id): of the blocks picked for each anchor, the best ``most``
    rows, from each task: of the anchor's label without ``windows``, else of other labels and in
    each of the anchor's windows (least, greatest). A row within several windows comes once."""
    shared = spark.sparkContext.broadcast((group, windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, limits = shared.value
        kept: dict[tuple[int, int], Kept] = {}
        for batch in batches:
            for row in batch.to_pylist():
                needed = np.unpackbits(np.frombuffer(row["anchors"], np.uint8))[: len(anchors.at)]
                needed = np.flatnonzero(needed)
                ids, labels = (np.frombuffer(row[name], "<i8") for name in ("ids", "labels"))
                vectors = _vectors(row, len(ids), blocks.width)
                scores = product(anchors.vectors[needed], vectors)
                good = anchors.label[needed][:, None] == labels
                if limits is None:
                    own = np.flatnonzero(anchors.block[needed] == row["block"])
                    good[own, anchors.at[needed[own]]] = False
                else:
                    low, high = limits[needed, :, 0], limits[needed, :, 1]
                    empty = low > high
                    least = np.where(empty, _MOST, low).min(axis=1)
                    most_of = np.where(empty, -_MOST, high).max(axis=1)
                    good = ~good & (scores >= least[:, None]) & (scores <= most_of[:, None])
                for at in np.flatnonzero(good.any(axis=1)).tolist():
                    number = int(needed[at])
                    mine, names = scores[at][good[at]], ids[good[at]]
                    if limits is None:
                        _keep(kept, (number, 0), mine, names, most)
                        continue
                    for window, (low, high) in enumerate(limits[number].tolist()):
                        inside = (mine >= low) & (mine <= high)
                        _keep(kept, (number, window), mine[inside], names[inside], most)
        rows: dict[int, Counter] = {}
        for (number, _), (scores, ids) in kept.items():
            # Rows that repeat an id are told apart by their number only.
            rows[number] = rows.get(number, Counter()) | Counter(
                zip(scores.tolist(), ids.tolist(), strict=True)
            )
        for number, pairs in rows.items():
            found = np.array(list(pairs.elements()), np.int64)
            columns = [np.full(len(found), number), found[:, 0], found[:, 1]]
            yield pa.RecordBatch.from_arrays(
                list(map(pa.array, columns)), ["anchor", "score", "vec_id"]
            )

    schema = "anchor bigint, score bigint, vec_id bigint"
    parts = [row["part"] for row in picked.select("part").distinct().collect()]
    if not parts:
        return spark.createDataFrame([], schema)
    stored = blocks.read(spark, parts).select("block", "ids", "labels", "kind", "vectors")
    picked = picked.select("block", "anchors")
    sent = picked.count() * (len(group.at) // 8 + 64)
    picked = F.broadcast(picked) if sent <= SENT_BYTES else picked
    return stored.join(picked, "block").mapInArrow(run, schema)


def _keep(kept: dict, key: tuple, scores: np.ndarray, ids: np.ndarray, most: int) -> None:
    if not len(scores):
        return
    if key in kept:
        scores, ids = np.append(kept[key][0], scores), np.append(kept[key][1], ids)
    kept[key] = best(scores, ids, most)


def _first(found: DataFrame, by: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def positives(spark: SparkSession, blocks: Blocks, group: Group) -> list[list[tuple[int, int]]]:
    """For each anchor (score, vec_id) of its first ``POSITIVES`` other rows of the same label."""
    own = chosen(spark, blocks, group, lambda g, z: g.block[:, None] == z.block)
    near = _first(read(spark, blocks, group, own, None, POSITIVES), ["anchor"], POSITIVES)
    reached = np.full(len(group.at), -_MOST)
    for row in near.where(F.col("rank") == POSITIVES).collect():
        reached[row["anchor"]] = row["score"]
    picked = chosen(
        spark, blocks, group, lambda g, z: holds(g, z) & (z.most >= reached[:, None])
    )
    out: list[list[tuple[int, int]]] = [[] for _ in group.at]
    found = _first(read(spark, blocks, group, picked, None, POSITIVES), ["anchor"], POSITIVES)
    for row in sorted(found.collect(), key=lambda row: row["rank"]):
        out[row["anchor"]].append((row["score"], row["vec_id"]))
    return out


def negatives(
    spark: SparkSession, blocks: Blocks, group: Group, found: list[list[tuple[int, int]]]
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    below, above = WINDOW
    limits = np.zeros((len(found), POSITIVES, 2), np.int64)
    limits[:, :, 0] = 1  # from 1 to 0: nothing
    rows = []
    for anchor, scores in enumerate(found):
        for window, (score, vec_id) in enumerate(scores):
            low, high = -(-below * score // 100), above * score // 100
            limits[anchor, window] = low, high
            if low <= high:
                rows.append((anchor, window, int(group.vec_id[anchor]), vec_id, score, low, high))
    schema = "anchor bigint, window int, anchor_id bigint, positive_id bigint, "
    schema += "positive_score bigint, low bigint, high bigint"
    # A few rows for each anchor of the group, whose size is bounded.
    windows = F.broadcast(spark.createDataFrame(rows, schema))

    def first(candidates: DataFrame) -> DataFrame:
        inside = candidates.join(windows, "anchor").where("score BETWEEN low AND high")
        return _first(inside, ["anchor", "window"], NEGATIVES)

    target = np.where(limits[:, 0, 0] <= limits[:, 0, 1], limits[:, 0, 1], np.nan)
    probed = read(spark, blocks, group, nearest(spark, blocks, group, target), limits, NEGATIVES)
    for row in first(probed).where(F.col("rank") == NEGATIVES).collect():
        limits[row["anchor"], row["window"], 0] = row["score"]

    def meets(g: Group, z: Zones) -> np.ndarray:
        needed = np.zeros(z.most.shape, bool)
        for window in range(POSITIVES):
            low, high = limits[:, window, 0][:, None], limits[:, window, 1][:, None]
            needed |= (low <= high) & (z.most >= low) & (z.least <= high)
        return needed & others(g, z)

    picked = chosen(spark, blocks, group, meets)
    return first(read(spark, blocks, group, picked, limits, NEGATIVES)).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


_RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
_RESULT += "positive_score bigint, negative_score bigint"


def mine(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    every: int = 100,
    block_rows: int = BLOCK_ROWS,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every
    anchor, a row whose id ``every`` divides, and each of its first positives, the first negatives
    in the positive's window.

    Rows without id, label or vector, or with a component that is null or not finite, take no part.
    Components that a shorter vector lacks count as 0. Rows that repeat an id are rows of their own:
    each may be an anchor, a positive of the other, or a negative. Scores tie by the smaller id.
    Other columns are not read. An empty table has no rows; a score beyond 64 bits is an error.
    """
    spark = df.sparkSession
    rows = checkpointed(usable(df, key, vector, label))
    shape = _shape(rows)
    if not shape.rows:
        return spark.createDataFrame([], _RESULT)
    blocks = write_blocks(rows, shape, block_rows)
    folder = work_dir(spark, "hard-negatives")
    size = max(1, group_bytes // (8 * max(1, shape.width)))
    for number, group in enumerate(anchor_groups(spark, blocks, every, size)):
        found = negatives(spark, blocks, group, positives(spark, blocks, group))
        found.write.parquet(f"{folder}/group={number}")
    spark.createDataFrame([], _RESULT).write.parquet(f"{folder}/group=-1")
    return spark.read.schema(f"{_RESULT}, `group` int").parquet(folder).drop("group")


SQL = """
WITH rows_ AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
    list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows_ a JOIN rows_ b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""
