"""Line deduplication against levelled sorted runs of line hashes.

The index of lines seen so far is a set of runs: bucketed tables of (line hash, owner), sorted
within each bucket. A batch of documents is reduced to its distinct hashes, merge-joined with every
run (each hash is in one run at most), and what no run holds becomes a new run of level 0. When a
level has ``fanout`` runs, they are merged into one run of the next level, so a hash is rewritten
once per level and a batch meets few runs. The runs are bucketed as the joins need them: neither a
batch nor a compaction shuffles what is already in the index.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.llm.scratch import checkpointed
from barweave.session import work_dir

#: Keys of fewer code points are never dropped.
LEAST = 10
_BLANKS = b" \t\n\x0b\x0c\r"
#: Documents without an id come after all others and count as one document.
LAST = (1 << 63) - 1


def line_hash(line: bytes, least: int = LEAST) -> bytes | None:
    """128-bit hash of the line's key: without blanks at both ends, A-Z in lower case. None for a
    key of fewer than ``least`` code points."""
    key = line.strip(_BLANKS).lower()  # bytes: only A-Z change
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return xxhash.xxh3_128_digest(key)


def lines_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split(b"\n")


class LineIndex:
    """The runs, as tables of the session's catalog over one folder."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int, fanout: int = 2):
        self.spark, self.folder, self.buckets, self.fanout = spark, folder, buckets, fanout
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[DataFrame]] = []
        self.made = 0

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _write(self, frame: DataFrame) -> DataFrame:
        """A run; its rows already lie in the buckets' partitions where Spark can tell so. The
        catalog's entry goes again at once: the reader keeps what it needs of it."""
        self.made += 1
        table = f"{self.name}_{self.made}"
        (
            frame.repartition(self.buckets, "hash")
            .write.bucketBy(self.buckets, "hash")
            .sortBy("hash")
            .option("path", f"{self.folder}/{table}")
            .saveAsTable(table)
        )
        try:
            return self.spark.table(table).select("hash", "owner")
        finally:
            self.spark.sql(f"DROP TABLE {table}")  # external: the files stay

    def add(self, keys: DataFrame) -> DataFrame:
        """Takes a batch of (doc, part, hash); returns its rows whose hash has an owner below their doc,
        in an earlier batch or in this one."""
        seen = keys.groupBy("hash").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        held = []
        for number, run in enumerate(self.runs()):
            seen = seen.join(run.withColumnRenamed("owner", f"held{number}"), "hash", "left")
            held.append(F.col(f"held{number}"))
        owner = F.coalesce(*held, F.lit(None).cast("bigint"))
        seen = checkpointed(seen.select("hash", "first", "last", owner.alias("held")))
        self._push(0, self._write(seen.where("held IS NULL").selectExpr("hash", "first AS owner")))
        shared = seen.selectExpr("hash", "coalesce(held, first) AS owner", "last")
        shared = shared.where("owner < last").select("hash", "owner")
        return keys.join(shared, "hash").where("doc > owner").select("doc", "part", "hash")

    def _push(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self.levels[level][0]
            for other in self.levels[level][1:]:
                merged = merged.unionByName(other)
            self.levels[level] = []
            self._push(level + 1, self._write(merged))


def line_keys(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, part, hash): the distinct hashed keys of each whole text. Rows without id are one
    document, in a part for each text, so that they are not one row of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, parts, hashes = [], [], []
            for doc, part, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = set(map(line_hash, lines_of(value))) - {None}
                docs += [doc] * len(found)
                parts += [part] * len(found)
                hashes += found
            columns = [pa.array(docs, pa.int64()), pa.array(parts, pa.int64())]
            columns.append(pa.array(hashes, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["doc", "part", "hash"])

    rows = df.select(*_document(key, text), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc bigint, part bigint, hash binary")


def _document(key: str, text: str) -> list:
    """The names of a row's document and of its part."""
    number = F.col(key).cast("bigint")
    part = F.when(number.isNull(), F.xxhash64(F.col(text))).otherwise(F.lit(0))
    return [F.coalesce(number, F.lit(LAST)).alias("doc"), part.cast("bigint").alias("part")]


def drops(df: DataFrame, key: str = "doc_id", text: str = "text", batches: int = 4) -> DataFrame:
    """(doc, part, hashes): the line hashes each document loses. The documents go through a new index in
    ``batches`` ranges of ids, smallest ids first, so a line's owner is the smallest id holding it.
    """
    spark = df.sparkSession
    folder = work_dir(spark, "line-runs")
    cuts = df.select(F.col(key).cast("bigint").alias("doc")).approxQuantile(
        "doc", [i / batches for i in range(1, batches)], 0.01
    )
    batch = sum((F.col("doc") > cut).cast("int") for cut in cuts) if cuts else F.lit(0)
    keys = line_keys(df, key, text).withColumn("batch", batch)
    keys.write.partitionBy("batch").parquet(f"{folder}/keys")
    schema = T.StructType.fromDDL("doc bigint, part bigint, hash binary, batch int")
    keys = spark.read.schema(schema).parquet(f"{folder}/keys")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = LineIndex(spark, folder, buckets)
    found = [
        index.add(keys.where(F.col("batch") == number).drop("batch"))
        for number in range(len(cuts) + 1)
    ]
    lost = found[0]
    for more in found[1:]:
        lost = lost.unionByName(more)
    return lost.groupBy("doc", "part").agg(F.collect_set("hash").alias("hashes"))


def without_lines(df: DataFrame, lost: DataFrame, key: str = "doc_id", text: str = "text"):
    """(row, kept, n_lines, n_dropped): every input row, its other columns in ``row``, beside its
    text without lost lines.

    One output row per input row. A null or empty text is one empty line, and stays as it is. Rows that repeat an id
    count as one document: they lose the same lines and none to each other. Rows without an id come
    last, as one document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, dropped, kept = [], [], []
            places = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            for value, hashes in places:
                lines = lines_of(value)
                stay = lines
                if hashes:
                    gone = set(hashes)
                    stay = [line for line in lines if line_hash(line) not in gone]
                counts.append(len(lines))
                dropped.append(len(lines) - len(stay))
                kept.append(value if stay is lines else b"\n".join(stay).decode())
            arrays = [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(dropped, pa.int64()),
                pa.array(kept, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "n_lines", "n_dropped", "kept"])

    packed = df.select(
        *_document(key, text),
        F.struct(*(F.col(f"`{name}`") for name in df.columns if name != text)).alias("row"),
        F.col(text).alias("text"),
    )
    joined = packed.join(lost, ["doc", "part"], "left").select("row", "text", "hashes")
    schema = T.StructType(
        [
            T.StructField("row", packed.schema["row"].dataType),
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
            T.StructField("kept", T.StringType()),
        ]
    )
    return joined.mapInArrow(run, schema)


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The input's columns with repeated lines gone from the text. ``n_chars``, where there is such
    a column, is counted again for changed texts; a document that loses all lines stays, empty."""
    found = without_lines(df, drops(df, key, text), key, text)
    changed = F.col("n_dropped") > 0
    out = {c: F.col("kept" if c == text else f"row.`{c}`") for c in df.columns}
    if "n_chars" in out:
        size = F.char_length("kept").cast(df.schema["n_chars"].dataType)
        out["n_chars"] = F.when(changed, size).otherwise(out["n_chars"])
    return found.select(*(value.alias(name) for name, value in out.items()))


def digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_lines, n_dropped, kept_sha256)."""
    only = df.select(key, text)
    found = without_lines(only, drops(only, key, text), key, text)
    return found.select(
        F.col(f"row.`{key}`").alias(key),
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
