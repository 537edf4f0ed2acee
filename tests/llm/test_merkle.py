"""The Merkle manifest against a plain version, with blocks small enough for many rounds."""

import hashlib
import random
import zlib

import duckdb
import pytest

from barweave.llm import merkle
from barweave.llm.positions import numbered

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, at int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def said(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes):
    """The root of the nodes, and for each node the pairs left and right of it on the way up."""
    ways, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for way, at in zip(ways, places, strict=True):
            first = at - at % 8
            way.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 8])))
        nodes = [sha("".join(nodes[at : at + 8])) for at in range(0, len(nodes), 8)]
        places = [at // 8 for at in places]
    return nodes[0], ways


def plain(rows):
    def leaf(row, text):
        doc, _, lang, source, n = row[:5]
        return sha("".join(map(said, (doc, source, lang, n, text))))

    trees = {}
    for row in rows:
        text = row[1]
        if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        trees.setdefault(row[2], []).append((row[0], leaf(row, row[1]), leaf(row, text)))
    langs = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    for found in trees.values():
        found.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    climbed = [climb([own for _, own, _ in trees[lang]]) for lang in langs]
    root, tops = climb([subroot for subroot, _ in climbed]) if langs else (None, [])
    out = []
    for tree, (lang, (subroot, ways), top) in enumerate(zip(langs, climbed, tops, strict=True)):
        for at, ((doc, own, shown), way) in enumerate(zip(trees[lang], ways, strict=True)):
            proof = sha("".join(a + b for a, b in way + top))
            for before, after in way + top:
                shown = sha(before + shown + after)
            out.append((doc, own, subroot, root, proof, shown, shown == root, tree, at))
    return out


def rows_of(sizes, seed=3):
    rng = random.Random(seed)
    texts = (None, "", "a B", "É ß 漢", "lower", "UP " * 50)
    rows = []
    for lang, size in sizes.items():
        for _ in range(size):
            doc = rng.choice((None, 7, rng.randrange(-50, 10_000)))
            source, n = rng.choice((None, "", "s:1")), rng.choice((None, 0, 12))
            rows.append((doc, rng.choice(texts), lang, source, n, "x", 1))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


def result(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize(
    ("sizes", "levels"),
    [
        ({"en": 90, None: 17, "": 1, "é": 8, "z": 9}, 1),
        ({f"l{number}": 1 + number for number in range(11)}, 1),
        ({"en": 70, "de": 130}, 2),
    ],
)
def test_equals_plain_version(spark, sizes, levels):
    rows = rows_of(sizes)
    found = result(merkle.proofs(spark.createDataFrame(rows, SCHEMA), levels))
    assert found == sorted(plain(rows), key=repr)


def test_plain_version_equals_sql(spark):
    rows = rows_of({"en": 90, None: 17, "de": 3})
    database = duckdb.connect()
    database.sql("CREATE TABLE documents (doc_id BIGINT, text TEXT, lang TEXT, source TEXT, n_chars BIGINT)")
    database.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [row[:5] for row in rows])
    assert sorted(database.sql(merkle.SQL).fetchall(), key=repr) == sorted(plain(rows), key=repr)


def test_no_rows_and_one_row(spark):
    frame = spark.createDataFrame([(5, "A", "en", "s", 1, "x", 1)], SCHEMA)
    row = merkle.proofs(frame).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == sha("")
    assert merkle.proofs(frame.limit(0)).collect() == []


def test_only_altered_rows_fail(spark):
    rows = [(n, "Text", "en", "s", 4, "x", 1) for n in range(200)]
    found = merkle.proofs(spark.createDataFrame(rows, SCHEMA), 1).collect()
    failed = {row["doc_id"] for row in found if not row["verified"]}
    assert failed == {n for n in range(200) if zlib.crc32(str(n).encode()) % 3 == 0}
    assert len({row["root"] for row in found}) == 1


def test_positions_with_one_value_on_most_rows(spark):
    rows = [("a" if n % 3 else None, 5 if n % 4 else n) for n in range(500)]
    frame = spark.createDataFrame(rows, "g string, v int").repartition(7)
    found = numbered(frame, "g", ["v"]).collect()
    assert sorted((row["tree"], row["at"]) for row in found) == sorted(
        [(0, n) for n in range(167)] + [(1, n) for n in range(333)]
    )
    for tree in (0, 1):
        values = [row["v"] for row in sorted(found, key=lambda r: r["at"]) if row["tree"] == tree]
        assert values == sorted(values)
