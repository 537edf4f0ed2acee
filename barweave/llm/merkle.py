"""Merkle manifest of a dataset, with proofs made by a butterfly exchange.

Every document is a leaf; the leaves of a language, in the order of their ids, are the bottom of a
tree of fan-out 8, and the languages' roots are the bottom of one more tree. A block is an aligned
run of 8**k leaves, hashed up to its root by one task. Then the blocks swap: in a round, the blocks
of an aligned group of 8 subtrees each get the roots of the other subtrees, from the block with the
same low digits there, and every block hashes the group's node itself. So all blocks of a group hash
the same ancestors, and after the last round each block holds the root and the siblings on its way
up; nothing is sent down the tree again.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.llm.positions import numbered
from barweave.llm.scratch import checkpointed

FANOUT = 8
#: Levels of a tree that are hashed within a block: 8**4 leaves.
LEVELS = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(**changed):
    """The hash of a row's fields: each ``-`` if null, else its bytes, ``:`` and its value."""
    values = [changed.get(name, F.col(name)).cast("string") for name in FIELDS]
    said = [F.coalesce(F.concat(F.octet_length(v), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*said).cast("binary"), 256)


def leaves(df: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, shown): the leaf of each row, and the leaf of the row as it is shown
    later: with A-Z of the text in lower case where 3 divides the id's checksum. Hashes are binary;
    a row without id is shown as it is."""
    altered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    shown = F.when(altered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    rows = df.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        *(F.col(name) for name in ("source", "n_chars", "text")),
    )
    own, later = leaf_hash(), leaf_hash(text=shown)
    return rows.select("doc_id", "lang", F.unhex(own).alias("leaf"), F.unhex(later).alias("shown"))


def digest(parts: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def block_levels(found: list[bytes], size: int, levels: int) -> list[list[bytes]]:
    """The nodes of a block, level by level, from its leaves (in hexadecimal digits) to its root.
    A tree of ``size`` leaves that fits in the block ends where one node is left."""
    out, left = [found], size
    for _ in range(levels):
        if left == 1:
            break
        last = out[-1]
        out.append([digest(last[at : at + FANOUT]) for at in range(0, len(last), FANOUT)])
        left = -(-left // FANOUT)
    return out


def _hex(column: pa.ChunkedArray) -> list[bytes]:
    return [value.hex().encode() for value in column.to_pylist()]


def block_roots(placed: DataFrame, levels: int) -> DataFrame:
    """(tree, block, count, root): the root of every block; ``count`` is the tree's blocks."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        size = rows["size"][0].as_py()
        root = block_levels(_hex(rows["leaf"]), size, levels)[-1][0]
        count = -(-size // FANOUT**levels)
        out = {"tree": rows["tree"][:1], "block": rows["block"][:1], "count": [count]}
        return pa.table(out | {"root": [root.decode()]})

    blocks = placed.select("tree", "block", "at", "size", "leaf").groupBy("tree", "block")
    return blocks.applyInArrow(run, "tree bigint, block bigint, count bigint, root string")


def exchange(nodes: DataFrame) -> DataFrame:
    """(tree, block, root, before, after): for every node (tree, block, count, root), with blocks
    from 0 to count - 1, the root of its tree and the hashes of its siblings on the way there, left
    and right of it, joined level by level.

    A round multiplies the width of the subtrees by 8. A block asks the block with its own low
    digits in each subtree of its group; a last subtree that is narrower answers in turn. What a
    block sends or gets in a round is bounded by the fan-out, but for a narrow last subtree, whose
    blocks answer for those it lacks.
    """
    empty = F.array().cast("array<string>")
    state = nodes.select(
        "tree", "block", "count", "root", empty.alias("before"), empty.alias("after")
    )
    state = checkpointed(state)
    widest = state.agg(F.max("count")).first()[0] or 0
    width = 1
    while width < widest:
        group = FANOUT * width
        asking = state.where(F.col("count") > width).drop("root")
        slot = F.explode(F.sequence(F.lit(0), F.lit(FANOUT - 1))).alias("slot")
        asking = asking.select("*", slot).selectExpr(
            "*", f"block div {group} * {group} + slot * {width} AS first"
        )
        asking = asking.where("first < count").selectExpr(
            "*", f"first + block % {width} % least({width}, count - first) AS asked"
        )
        told = state.select("tree", F.col("block").alias("asked"), F.col("root").alias("told"))
        got = asking.join(told, ["tree", "asked"])
        got = got.groupBy("tree", "block", "count", "before", "after").agg(
            F.array_sort(F.collect_list(F.struct("slot", "told"))).alias("run")
        )
        own = f"block div {width} % {FANOUT}"
        got = got.selectExpr(
            "tree",
            "block",
            "count",
            "sha2(array_join(run.told, ''), 256) AS root",
            f"concat(before, array(array_join(filter(run, x -> x.slot < {own}).told, ''))) AS before",
            f"concat(after, array(array_join(filter(run, x -> x.slot > {own}).told, ''))) AS after",
        )
        state = checkpointed(state.where(F.col("count") <= width).unionByName(got))
        width = group
    return state.select("tree", "block", "root", "before", "after")


def proofs(df: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, tree, at), one row per
    row of documents (doc_id, source, lang, n_chars, text).

    ``tree`` numbers the languages, ``at`` the leaves of a language. Repeated rows are leaves of
    their own, next to each other; rows of one id come in the order of their leaves and rows without
    id come first. Null and empty texts differ; other columns are not read. No rows give no rows.
    """
    placed = numbered(leaves(df), "lang", ["doc_id", "leaf"]).drop("lang")
    placed = checkpointed(placed.withColumn("block", F.expr(f"at div {FANOUT**levels}")))
    lower = checkpointed(exchange(block_roots(placed, levels)))
    tops = lower.where("block = 0").select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("block"), "root"
    )
    tops = checkpointed(tops)
    tops = tops.withColumn("count", F.lit(tops.count()).cast("bigint"))
    upper = exchange(tops).selectExpr(
        "block AS tree", "root AS top", "before AS top_before", "after AS top_after"
    )
    way = lower.join(upper, "tree").selectExpr(
        "tree",
        "block",
        "root AS subroot",
        "top AS root",
        "concat(before, top_before) AS before",
        "concat(after, top_after) AS after",
    )

    def run(rows: pa.Table, ways: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        way = ways.to_pylist()[0]
        above = [tuple(map(str.encode, pair)) for pair in zip(way["before"], way["after"], strict=True)]
        nodes = block_levels(_hex(rows["leaf"]), rows["size"][0].as_py(), levels)
        # Of every node: the siblings from its level up, and the pairs around it and its ancestors.
        joined = [b"".join(before + after for before, after in above)]
        around = [above]
        for level in reversed(nodes[:-1]):
            parents = list(zip(joined, around, strict=True))
            joined, around = [], []
            for at in range(len(level)):
                first = at - at % FANOUT
                before = b"".join(level[first:at])
                after = b"".join(level[at + 1 : first + FANOUT])
                joined_above, around_above = parents[at // FANOUT]
                joined.append(before + after + joined_above)
                around.append([(before, after), *around_above])
        folded = []
        for now, pairs in zip(_hex(rows["shown"]), around, strict=True):
            for before, after in pairs:
                now = digest([before, now, after])
            folded.append(now.decode())
        same = [now == way["root"] for now in folded]
        return pa.table(
            {
                "doc_id": rows["doc_id"],
                "leaf": [value.decode() for value in nodes[0]],
                "subroot": [way["subroot"]] * len(rows),
                "root": [way["root"]] * len(rows),
                "proof_sha256": [hashlib.sha256(parts).hexdigest() for parts in joined],
                "folded_root": folded,
                "verified": same,
                "tree": rows["tree"],
                "at": rows["at"],
            }
        )

    schema = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
    schema += "folded_root string, verified boolean, tree bigint, at bigint"
    by = ["tree", "block"]
    return placed.groupBy(*by).cogroup(way.groupBy(*by)).applyInArrow(run, schema)



def _sql_leaf(text: str) -> str:
    said = [f"coalesce(strlen(({v})::VARCHAR) || ':' || {v}, '-')" for v in (*FIELDS[:-1], text)]
    return f"sha256({' || '.join(said)})"


#: The same in SQL: the checksum bit by bit, the trees and the folding level by level.
SQL = f"""
WITH RECURSIVE sums AS (
  SELECT *, translate(text, '{UPPER}', '{LOWER}') AS small,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(
      string_split(doc_id::VARCHAR, ''), lambda c: [ord(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda x, y: xor(xor(x, y) >> 1,
        CASE WHEN xor(x, y) % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)),
      4294967295::UBIGINT) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, lang, {_sql_leaf("text")} AS leaf,
    {_sql_leaf("CASE WHEN doc_id IS NOT NULL AND crc % 3 = 0 THEN small ELSE text END")} AS shown
  FROM sums),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
nodes AS (
  SELECT tree, 0 AS level, place AS i, leaf AS h, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 7) // 8
  FROM nodes WHERE n > 1 GROUP BY tree, level, i // 8),
tops AS (
  SELECT 0 AS level, tree AS i, h, count(*) OVER () AS n FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 7) // 8
  FROM tops WHERE n > 1 GROUP BY level, i // 8),
runs AS (
  SELECT tree, level, i // 8 AS g, list(h ORDER BY i) AS hs
  FROM nodes WHERE n > 1 GROUP BY ALL),
top_runs AS (
  SELECT level, i // 8 AS g, list(h ORDER BY i) AS hs FROM tops WHERE n > 1 GROUP BY ALL),
paths AS (
  SELECT tree, place, 0 AS level, place AS i, shown AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT tree, place, level + 1, i // 8,
    sha256(array_to_string(hs[1:i % 8], '') || h || array_to_string(hs[i % 8 + 2:], '')),
    proof || array_to_string(hs[1:i % 8], '') || array_to_string(hs[i % 8 + 2:], '')
  FROM paths JOIN runs USING (tree, level) WHERE g = i // 8),
top_paths AS (
  SELECT tree, place, 0 AS level, tree AS i, arg_max(h, level) AS h, arg_max(proof, level) AS proof
  FROM paths GROUP BY tree, place
  UNION ALL
  SELECT tree, place, level + 1, i // 8,
    sha256(array_to_string(hs[1:i % 8], '') || h || array_to_string(hs[i % 8 + 2:], '')),
    proof || array_to_string(hs[1:i % 8], '') || array_to_string(hs[i % 8 + 2:], '')
  FROM top_paths JOIN top_runs USING (level) WHERE g = i // 8),
ended AS (
  SELECT tree, place, arg_max(h, level) AS folded_root, sha256(arg_max(proof, level)) AS proof_sha256
  FROM top_paths GROUP BY tree, place)
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, proof_sha256, folded_root,
  folded_root = r.h AS verified, tree, place AS "at"
FROM leaves JOIN ended USING (tree, place)
JOIN (SELECT tree, h FROM nodes WHERE n = 1) s USING (tree)
JOIN (SELECT h FROM tops WHERE n = 1) r ON true
"""
