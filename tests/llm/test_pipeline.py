"""The pipeline stage by stage against plain Python versions of what the stages keep."""

import hashlib
import os
import random
import sys
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken
from test_llm import brute_components, lower, plain_hits

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from barweave.llm import byte_bpe, jaccard_join  # noqa: E402
from barweave.llm.scratch import checkpointed  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string"
ENGLISH = "the house and the garden were quiet in the morning when she went down to the river".split()
GERMAN = "das haus und der garten waren still am morgen als sie hinunter zum fluss ging und".split()
ITEM = " ".join(f"benchmark{i}" for i in range(30))


def documents():
    rng = random.Random(9)
    rows = []
    for doc in range(120):
        words = rng.choices((ENGLISH, GERMAN)[doc % 2], k=rng.randint(30, 60))
        words += [f"w{rng.randrange(1000)}" for _ in range(8)]
        rows.append([doc, " ".join(words), ("en", "de")[doc % 2]])
    for doc in range(120, 140):  # near copies of the first
        words = rows[doc - 120][1].split()
        words[rng.randrange(len(words))] = "changed"
        rows.append([doc, " ".join(words), rows[doc - 120][2]])
    line = "a line of the site that every page repeats"
    for doc in range(40, 60):
        rows[doc][1] += f"\n{line}\nshort"
    rows[60][1] += " " + ITEM  # most of it is the item
    rows[61][1] += (" " + " ".join(ENGLISH)) * 60 + " " + ITEM[:160]  # a window and a word
    rows += [[200, None, "en"], [201, "", "en"], [202, " \n ", None], [203, "12 34", "en"]]
    rows += [list(rows[3]), [None, rows[5][1], "de"], [None, rows[5][1], "de"]]
    return [(doc, text, lang, "s", len(text or ""), "r") for doc, text, lang in rows]


@pytest.fixture
def folder(spark, tmp_path):
    def make(rows):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
        items = spark.createDataFrame([(1, ITEM), (2, None)], "item_id bigint, text string")
        items.write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return make


def rows_of(frame):
    return sorted(((row["doc_id"], row["text"]) for row in frame.collect()), key=str)


def plain_lines(rows):
    owner = {}
    for doc, text in sorted(rows, key=lambda row: (row[0] is None, row[0] or 0)):
        for part in (text or "").split("\n"):
            owner.setdefault(lower(part.strip(" \t\n\x0b\x0c\r")), doc)
    out = []
    for doc, text in rows:
        if text is not None:
            parts = text.split("\n")
            keys = [lower(part.strip(" \t\n\x0b\x0c\r")) for part in parts]
            pairs = zip(parts, keys, strict=True)
            text = "\n".join(a for a, k in pairs if len(k) < 10 or owner[k] == doc)
        out.append((doc, text))
    return sorted(out, key=str)


def test_every_stage_equals_its_plain_version(spark, folder):
    sf_dir = folder(documents())
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        steps[name] = before, docs = docs, stage(spark, docs, sf_dir)
        docs = checkpointed(docs)
        steps[name] = (rows_of(before), docs)

    given, kept = steps["language_id"]
    assert set(rows_of(kept)) <= set(given)
    gone = {doc for doc, _ in given} - {doc for doc, _ in rows_of(kept)}
    assert gone == {200, 201, 202, 203}  # without a letter

    before, after = steps["line_dedup"]
    assert rows_of(after) == plain_lines(before)

    before, after = steps["near_duplicates"]
    # Rows that repeat an id, or have none, come after all others.
    seen, numbered = set(), []
    for doc, text in before:
        again = doc is None or doc in seen
        seen.add(doc)
        numbered.append((10_000 + len(numbered) if again else doc, doc, text))
    component = brute_components([(own, text) for own, _, text in numbered])
    expected = [(doc, text) for own, doc, text in numbered if component[own][2] == own]
    assert rows_of(after) == expected and 100 < len(expected) < len(before) - 8

    before, after = steps["decontamination"]
    bad = {doc for doc, *_, bad in plain_hits(before, [(1, ITEM), (2, None)]) if bad}
    assert 60 in bad and 61 not in bad
    found = dict(rows_of(after))
    assert set(found) == {doc for doc, _ in before} - bad
    assert "benchmark3" not in found[61] and ENGLISH[3] in found[61]
    assert {d: t for d, t in found.items() if d != 61} == {
        d: t for d, t in before if d != 61 and d not in bad
    }

    before, after = steps["byte_bpe"]
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=byte_bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")).ranks,
        special_tokens={},
    )
    expected = []
    for doc, text in before:
        ids = library.encode_ordinary(text or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        decoded = hashlib.sha256((text or "").encode()).hexdigest()
        expected.append((doc, len(ids), hashlib.sha256(raw).hexdigest(), decoded))
    assert sorted(map(tuple, after.collect()), key=str) == sorted(expected, key=str)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(expected, key=str)
    assert list(stages) == ["language_id", "line_dedup", "near_duplicates", "decontamination", "byte_bpe"]


def test_no_documents_and_none_with_a_text(spark, folder):
    assert corpus_pipeline.run(spark, folder([])).collect() == []


def test_nulls_alone(spark, folder):
    rows = [(None, None, None, None, None, None), (1, "", None, None, None, None)]
    assert corpus_pipeline.run(spark, folder(rows)).collect() == []
    assert Path(corpus_pipeline.__file__).name == "corpus_pipeline.py"


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    near, other = text.replace("w39", "x"), " ".join(f"o{i}" for i in range(40))
    rows = [(5, near), (7, text), (7, other), (7, other), (None, other), (None, text), (None, None), (None, "")]
    rows += [(None, "own words without a number"), (9, "own words without a number"), (-3, None)]
    frame = spark.createDataFrame([(*row, 1) for row in rows], "doc_id bigint, text string, `a.b` int")
    found = jaccard_join.distinct_documents(frame.repartition(4))
    assert found.columns == ["doc_id", "text", "a.b"]
    assert sorted(((r[0], r[1]) for r in found.collect()), key=str) == sorted(
        [(5, near), (7, other), (None, None), (None, ""), (9, rows[8][1]), (-3, None)], key=str
    )
