"""JSON feeds, read from landed pages instead of over HTTP.

``multi_line=True`` reads whole files, as a feed returns them: one document, laid out on any number
of lines, or several after each other. Pages landed as JSON lines (one document per line) are
splittable and the better choice for large volumes; ``multi_line=False`` reads only those. Nothing
is lost silently: what is torn, of another type or laid out otherwise than said raises, and so does
a page of splits or quotes without its results (an error page) and an empty whole file. Only
results that are there and empty are none.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..schemas import ASSET, QUOTE_PAGE, SPLIT_PAGE, SPLITS, TICKER_DOCUMENT, without
from .landed import refuse_empty_files

_STRICT = {"mode": "FAILFAST"}
# States of a page that has its results.
_GOOD = ("OK", "DELAYED")


def _documents(files: DataFrame, schema: StructType, *more: str) -> DataFrame:
    """The documents of whole files (column ``value``). A comma is put between documents that
    follow each other, but not inside a string: with escaped quotes and backslashes written as
    their numbers, quotes are just the ends of strings, and every other piece is outside of them.
    """
    text = F.regexp_replace(F.btrim("value", F.lit(" \t\r\n")), r"\\\\", r"\\u005c")
    pieces = F.split(F.regexp_replace(text, r'\\"', r"\\u0022"), '"')
    apart = F.transform(
        pieces,
        lambda piece, at: F.when(
            at % 2 == 0, F.regexp_replace(piece, r"\}\s*\{", "},{")
        ).otherwise(piece),
    )
    items = F.array_join(apart, '"')
    listed = F.when(text.startswith("["), items).otherwise(F.concat(F.lit("["), items, F.lit("]")))
    whole = F.when(F.length(text) > 0, listed).otherwise(F.raise_error(F.lit("an empty page")))
    pages = F.from_json(whole, ArrayType(schema), _STRICT)
    return files.select(*more, F.posexplode(pages).alias("document", "page")).select(
        *more, "document", "page.*"
    )


def _read(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    multi_line: bool,
    with_file: bool = False,
) -> DataFrame:
    """The pages; ``with_file`` adds ``file`` and ``document``, the page's place in a whole file."""
    if multi_line:
        refuse_empty_files(spark, path)
        files = spark.read.text(path, wholetext=True)
        if with_file:
            files = files.select("value", F.col("_metadata").alias("file"))
            return _documents(files, schema, "file")
        return _documents(files, schema).drop("document")
    pages = spark.read.schema(schema).options(**_STRICT).json(path)
    if with_file:
        zero = F.lit(0).alias("document")
        return pages.select("*", F.col("_metadata").alias("file"), zero)
    return pages


def _results(name: str, good: Column):
    """The results of a page, or an error that names the page's state."""
    message = F.concat(F.lit(f"a page without {name}, status "), F.coalesce("status", F.lit("none")))
    return F.when(good & F.col(name).isNotNull(), F.col(name)).otherwise(F.raise_error(message))


def split_results() -> Column:
    """The results of a page of splits. A page in another state, without results, or with other
    than the number it says it has, is an error."""
    good = F.coalesce("status", F.lit("OK")).isin(*_GOOD)
    counted = F.coalesce("count", F.size("results")) == F.size("results")
    return _results("results", good & counted)


def read_split_pages(
    spark: SparkSession, path: str | list[str], multi_line: bool = True
) -> DataFrame:
    """Whole pages of splits with their ``file``; the results are as landed."""
    return _read(spark, path, SPLIT_PAGE, multi_line, with_file=True)


def read_splits(
    spark: SparkSession,
    path: str | list[str],
    first: date,
    last: date,
    as_of: date | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Splits executed from ``first`` to ``last``, stamped with the load date (default ``last``), as
    often as they are landed (``operators.split_events`` tells which are one). A feed whose results
    are empty gives an empty frame of the same schema."""
    pages = _read(spark, path, SPLIT_PAGE, multi_line)
    executed = F.col("execution_date").between(first.isoformat(), last.isoformat())
    taken_back = F.coalesce("withdrawn", F.lit(False))
    names = without(SPLITS, "as_of_date").fieldNames()
    return (
        pages.select(F.inline(split_results()))
        .filter(executed & ~taken_back)
        .select(*names)
        .withColumn("as_of_date", F.lit(as_of or last).cast("date"))
    )


def read_ticker_documents(
    spark: SparkSession, path: str | list[str], multi_line: bool = True
) -> DataFrame:
    """Detail documents; a failed lookup has no ``results`` and is skipped."""
    documents = _read(spark, path, TICKER_DOCUMENT, multi_line)
    return documents.filter(F.col("results").isNotNull()).select("results.*")


def read_assets(
    spark: SparkSession, path: str | list[str], multi_line: bool = True
) -> DataFrame:
    return _read(spark, path, ASSET, multi_line)


def flatten_quotes(pages: DataFrame, *more: str) -> DataFrame:
    """Pages of ticker -> bar maps to (ticker, c, t) and ``more`` of the page's columns; works on
    batch and streaming frames."""
    bars = _results("bars", F.lit(True))
    return pages.select(*more, F.explode(bars).alias("ticker", "bar")).select(
        "ticker", "bar.c", "bar.t", *more
    )


def _arrived(pages: DataFrame) -> DataFrame:
    """Quotes with their ``arrival``: when their file landed, its name, and the page's place in a
    whole file. Lines of one file arrive together: how a file is split must not order them."""
    place = F.col("document").cast("bigint").alias("place")
    arrival = F.struct(
        F.col("file.file_modification_time").alias("modified"),
        F.col("file.file_path").alias("path"),
        place,
    )
    return flatten_quotes(pages.withColumn("arrival", arrival), "arrival")


def read_quotes(
    spark: SparkSession, path: str | list[str], multi_line: bool = True, arrival: bool = False
) -> DataFrame:
    """All pages in one read; pages need no order and no accumulation. ``arrival`` adds the
    column that orders quotes by when they landed."""
    pages = _read(spark, path, QUOTE_PAGE, multi_line, with_file=arrival)
    return _arrived(pages) if arrival else flatten_quotes(pages)


def stream_quotes(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    multi_line: bool = True,
    arrival: bool = False,
) -> DataFrame:
    """The same feed as a stream of arriving files. Spark skips a file of no bytes."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    file = F.col("_metadata").alias("file")
    if multi_line:
        files = reader.text(path, wholetext=True)
        pages = _documents(files.select("value", file), QUOTE_PAGE, "file")
    else:
        pages = reader.schema(QUOTE_PAGE).options(**_STRICT).json(path)
        pages = pages.select("*", file, F.lit(0).alias("document"))
    return _arrived(pages) if arrival else flatten_quotes(pages)
