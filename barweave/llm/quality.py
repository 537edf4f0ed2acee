"""Document quality rules with verdicts on whole hosts, in DataFrame functions only.

Each document is measured and tested against a few rules. Hosts are judged by how many of their
documents break a rule; a small host's rate says little, so every rate is shrunk towards the other
hosts' by a beta prior fitted to the hosts' rates (method of moments). A host whose shrunk rate of
some rule exceeds ``HOST_LIMIT`` is not kept, and neither are its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barweave.llm.scratch import checkpointed

WINDOW = 5
HOST_LIMIT = 0.5
#: Bounds of the prior's weight, in documents. The upper one holds where all hosts are alike.
PRIOR_WEIGHT = (1.0, 1000.0)

#: Parts into which a host's documents are dealt to meet the verdicts.
SALTS = 32

_BLANK = "[\\x20\\x09-\\x0D]"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _BLANK + "+"), "")


def _covered(starts: Column) -> Column:
    """Words covered by windows that begin at the ascending ``starts``."""
    sizes = F.transform(
        starts,
        lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW))),
    )
    return F.aggregate(sizes, F.lit(0).cast("bigint"), lambda n, s: n + s)


def features(df: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text"):
    """(key, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of each
    whole text. A null text has no words and no lines; a null host counts as the host ''.

    Windows are compared by 64-bit hashes within one document. Only a document with a repeated
    window sorts its windows; each array is as long as its own document.
    """
    frame = df.select(
        F.col(key),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    frame = frame.withColumn("words", _words(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    frame = frame.select(
        key,
        "host",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.expr("cast(regexp_count(text, '[#*$%&|<>]') as bigint)").alias("n_symbols"),
        lines.alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    windows = F.transform(
        F.slice("hashes", 1, F.greatest(F.size("hashes") - (WINDOW - 1), F.lit(0))),
        lambda h, i: F.xxhash64(h, *(F.get("hashes", i + j) for j in range(1, WINDOW))),
    )
    frame = frame.select(
        key,
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    frame = frame.withColumn("windows", F.when(repeats, F.col("windows")))
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    frame = frame.withColumn("placed", F.sort_array(placed))
    again = F.filter(
        "placed",
        lambda w, j: w["h"].eqNullSafe(F.get("placed", j + 1)["h"])
        | ((j > 0) & w["h"].eqNullSafe(F.get("placed", F.greatest(j - 1, F.lit(0)))["h"])),
    )
    frame = frame.withColumn("starts", F.sort_array(F.transform(again, lambda w: w["i"])))
    covered = F.coalesce(_covered(F.col("starts")), F.lit(0).cast("bigint"))
    return frame.withColumn("n_repeat_words", covered).drop("windows", "placed", "starts")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


#: What a document may break. Hosts are judged by each rule on its own.
RULES = {
    "short": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 10 * word_chars",
    "lines": "100 * n_dup_lines > 30 * n_lines",
}


def host_verdicts(measured: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n_docs, <rule>_rate..., host_kept): one row per host. One host alone, or hosts that
    are all alike, get the strongest prior."""
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *(F.count_if(F.expr(rule)).alias(f"{name}_failed") for name, rule in RULES.items()),
    )
    rates = [F.col(f"{name}_failed") / F.col("n_docs") for name in RULES]
    moments = hosts.agg(
        *(F.avg(rate).alias(f"{name}_mean") for name, rate in zip(RULES, rates, strict=True)),
        *(F.var_samp(rate).alias(f"{name}_var") for name, rate in zip(RULES, rates, strict=True)),
    ).first()
    shrunk = {}
    for name in RULES:
        mean, var = moments[f"{name}_mean"] or 0.0, moments[f"{name}_var"] or 0.0
        low, high = PRIOR_WEIGHT
        weight = min(max(mean * (1 - mean) / var - 1, low), high) if var else high
        shrunk[f"{name}_rate"] = (F.col(f"{name}_failed") + mean * weight) / (
            F.col("n_docs") + weight
        )
    judged = hosts.select("host", "n_docs", *(rate.alias(n) for n, rate in shrunk.items()))
    return judged.withColumn("host_kept", F.greatest(*(F.col(n) for n in shrunk)) <= limit)


def judge(df: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text"):
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    host_kept): one row per input row, repeated rows included; other columns are not read.

    Measuring reads the texts once; the measures, some numbers a document, are written to the
    shared folder, so that hosts and documents are judged without reading texts again.
    """
    measured = checkpointed(features(df, key, host, text))
    hosts = host_verdicts(measured).where("NOT host_kept").select("host", "host_kept")
    salts = F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt")
    salted = measured.withColumn("salt", F.pmod(F.xxhash64(key, "n_words"), F.lit(SALTS)).cast("int"))
    joined = salted.join(hosts.select("*", salts), ["host", "salt"], "left")
    failed = base_failed()
    good = F.coalesce(F.col("host_kept"), F.lit(True))
    return joined.select(
        key,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & good).alias("kept"),
        good.alias("host_kept"),
    )


#: The same in SQL for DuckDB.
SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)),
      lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
places AS (
  SELECT doc_id, unnest(range(1, greatest(len(words) - 3, 1))) AS pos, words FROM parts),
windows AS (SELECT doc_id, pos, list_slice(words, pos, pos + 4) AS w FROM places),
again AS (
  SELECT doc_id, pos FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
gaps AS (
  SELECT doc_id, least(5, coalesce(lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) - pos, 5)) AS n
  FROM again),
repeats AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n FROM gaps GROUP BY doc_id),
measured AS (
  SELECT p.doc_id, host, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words
  FROM parts p LEFT JOIN repeats r ON p.doc_id = r.doc_id),
failed AS (
  SELECT *, n_words < 10 AS short, 100 * n_repeat_words > 20 * n_words AS repeated,
    100 * n_symbols > 10 * word_chars AS symbols, 100 * n_dup_lines > 30 * n_lines AS doubled
  FROM measured),
counts AS (
  SELECT host, rule, count(*) AS n, count(*) FILTER (bad) AS bad FROM (
    SELECT host, unnest(['short', 'repeated', 'symbols', 'doubled']) AS rule,
      unnest([short, repeated, symbols, doubled]) AS bad FROM failed) GROUP BY host, rule),
priors AS (
  SELECT rule, avg(bad / n) AS mean, coalesce(var_samp(bad / n), 0) AS var FROM counts GROUP BY rule),
weights AS (
  SELECT *, CASE WHEN var = 0 THEN 1000
    ELSE least(greatest(mean * (1 - mean) / var - 1, 1), 1000) END AS weight FROM priors),
hosts AS (
  SELECT host, max((bad + mean * weight) / (n + weight)) <= 0.5 AS host_kept
  FROM counts JOIN weights USING (rule) GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  short OR repeated AS base_failed, NOT (short OR repeated) AND host_kept AS kept, host_kept
FROM failed JOIN hosts USING (host)
"""
