"""Language identification by nearest centroid.

A text's vector counts its byte n-grams in hashed buckets, weighted by TF-IDF and normalised. Each
language has several centroids (spherical k-means on a bounded sample of labelled rows). A text gets
the language of the centroid of highest cosine; one that lies much further from all centroids than
any sample text of its size does is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.llm.batches import LOWER, byte_set, chunks, joined, mix

#: Hash buckets of a vector.
BUCKETS = 4096
SIZES = (2, 3)
#: Labelled rows the classifier is fitted on, over all languages; about as many of each.
SAMPLE = 2048
CENTROIDS = 4
#: A text is rejected below this part of the lowest similarity in the sample at its size.
SLACK = 0.4

_LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_SHOWN = np.where(_LETTERS, LOWER, 0x20).astype(np.uint8)


class Model(NamedTuple):
    """Languages by centroid, centroids (rows), IDF weights, and by log2 of a text's size the lowest
    similarity of a sample text of that size or more."""

    langs: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    lowest: np.ndarray


def gram_counts(column: pa.StringArray) -> np.ndarray:
    """Counts of hashed byte n-grams, a row for each text; what is no letter is a blank."""
    data, starts = joined(column, 0x20)
    data = _SHOWN[data].astype(np.uint64)
    doc = np.repeat(np.arange(len(column)), np.diff(np.append(starts, len(data))))
    out = np.zeros(len(column) * BUCKETS, np.int64)
    for size in SIZES:
        code = np.full(max(len(data) - size + 1, 0), size, np.uint64)
        for j in range(size):
            code = code << np.uint64(8) | data[j : j + len(code)]
        within = doc[: len(code)] == doc[size - 1 : size - 1 + len(code)]
        bucket = (mix(code) % np.uint64(BUCKETS)).astype(np.int64) + doc[: len(code)] * BUCKETS
        out += np.bincount(bucket[within], minlength=len(out))
    return out.reshape(len(column), BUCKETS)


def unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(size > 0, size, 1)


def centroids(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from rows spread over the input. Clusters of hardly any rows, which are the
    odd texts and not a kind of text, are left out."""
    found = rows[np.linspace(0, len(rows) - 1, min(k, len(rows))).astype(int)]
    for _ in range(rounds):
        nearest = (rows @ found.T).argmax(1)
        found = unit(np.array([rows[nearest == c].mean(0) for c in np.unique(nearest)]))
    members = np.bincount((rows @ found.T).argmax(1), minlength=len(found))
    return found[members >= min(0.02 * len(rows), members.max())]


def size_class(counts: np.ndarray) -> np.ndarray:
    return np.log2(counts.sum(1) + 1).astype(int)


def split_of(key: str):
    """The CRC-32 of the id's text modulo 5; null for a null id."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """A model of the rows outside fold 0 that have a text and a language, or None without any.

    Rows of each language are counted over all data; a hash of the id then picks as many of each,
    ``SAMPLE`` in all on average.
    """
    rows = df.where((split_of(key) != 0) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not sizes:
        return None
    if len(sizes) > SAMPLE // 2:
        raise ValueError(f"{len(sizes)} languages for a sample of {SAMPLE} rows")
    share = {name: min(1.0, SAMPLE / len(sizes) / n) for name, n in sizes.items()}
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_000))
    chosen = F.lit(False)
    for name, part in share.items():
        chosen = chosen | ((F.col(lang) == name) & (place < int(part * 1_000_000)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small(batch):
                counts = gram_counts(part.column(1)).astype(np.uint32)
                vectors = pa.array([row.tobytes() for row in counts], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), vectors], ["lang", "counts"])

    picked = rows.where(chosen).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    sample = picked.mapInArrow(run, "lang string, counts binary").toPandas()
    if not len(sample):
        return None
    sample = sample.sort_values(["lang", "counts"])  # whatever the order of partitions
    counts = np.array([np.frombuffer(c, np.uint32) for c in sample["counts"]])
    labels = sample["lang"].to_numpy()
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 1
    vectors = unit(np.log1p(counts) * idf).astype(np.float32)
    langs, rows_of = [], []
    for name in sorted(set(labels)):
        found = centroids(vectors[labels == name], CENTROIDS)
        langs += [name] * len(found)
        rows_of.append(found)
    table = np.concatenate(rows_of).astype(np.float32)
    best = (vectors @ table.T).max(1)
    size = size_class(counts)
    lowest = np.array([best[size >= min(s, size.max())].min() for s in range(64)])
    return Model(langs, table, idf.astype(np.float32), lowest)


def small(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Chunks of few rows, as every row has a dense vector."""
    for part in chunks(batch, "text"):
        for start in range(0, part.num_rows, 256):
            yield part.slice(start, 256)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def predict(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """(row, text, lang_pred, score, rejected): every input row, its other columns in ``row``,
    beside its language.

    ``lang_pred`` is a learned language, or ``und`` with score 0, rejected, if the text is null or
    has no letter, or if nothing was learned. The score is the cosine to the nearest centroid.
    Ties go to the first centroid. Repeated rows are predicted alike; the row's other columns, the
    label among them, are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shown = batch.column(1)
            letters = [has_letter(t) for t in shown.to_pylist()]
            start = 0
            for part in small(batch):
                n = part.num_rows
                known = np.array(letters[start : start + n], bool)
                start += n
                if model is None:
                    known[:] = False
                    names, best = ["und"] * n, np.zeros(n)
                else:
                    counts = gram_counts(part.column(1))
                    vectors = unit(np.log1p(counts) * model.idf)
                    cosine = vectors @ model.centroids.T
                    names = [model.langs[i] for i in cosine.argmax(1)]
                    best = np.clip(cosine.max(1), 0, 1)
                    far = best < SLACK * model.lowest[size_class(counts)]
                rejected = ~known if model is None else ~known | far
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        shown.slice(start - n, n),
                        pa.array([m if k else "und" for m, k in zip(names, known, strict=True)]),
                        pa.array(np.where(known, best, 0.0).astype(float)),
                        pa.array(rejected),
                    ],
                    ["row", "text", "lang_pred", "score", "rejected"],
                )

    others = [name for name in df.columns if name != text]
    row = F.struct(*(F.col(f"`{name}`") for name in others)).alias("row")
    packed = df.select(row, F.col(text).alias("text"))
    found = T.StructType.fromDDL("text string, lang_pred string, score double, rejected boolean")
    schema = T.StructType([T.StructField("row", packed.schema["row"].dataType), *found])
    return packed.mapInArrow(run, schema)


def identify(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang"):
    """(key, held_out, lang_pred, score, rejected). A null id is never learned from and not held
    out."""
    found = predict(df.select(key, text), fit(df, key, text, lang), text)
    row = F.col(f"row.`{key}`").alias(key)
    held = F.coalesce(split_of(f"row.`{key}`") == 0, F.lit(False)).alias("held_out")
    return found.select(row, held, "lang_pred", "score", "rejected")


def accepted(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang"):
    """The input's rows, as they are, whose text is in a learned language."""
    found = predict(df, fit(df, key, text, lang), text).where("NOT rejected")
    return found.select(
        *(F.col("text" if c == text else f"row.`{c}`").alias(c) for c in df.columns)
    )
