"""Licence scans against plain searches."""

import random
import re

import pytest

from barweave.llm import license_scan
from barweave.llm.license_scan import Automaton, chains, scan
from barweave.llm.license_texts import APACHE, BSD, GNU, ISC, MIT, PHRASES, TEMPLATES

SCHEMA = "doc_id bigint, text string, n_words string, spans int"
#: Short words over few letters, so that matches repeat, overlap and nest.
SMALL = (("x", "a b c d e f"), ("y", "c d e a b"), ("z", "a a b a a b c"))


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def scanned(spark, texts, **options):
    rows = [(n, text, "x", 1) for n, text in enumerate(texts)]
    found = scan(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()
    return [row.asDict(True) for row in sorted(found, key=lambda row: row["doc_id"])]


def base(text):
    words = plain_words(text)
    places = [
        (at, label)
        for label, phrase in PHRASES
        for at in range(len(words))
        if words[at : at + len(phrase.split())] == phrase.split()
    ]
    at = [place for place, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(at), min(at, default=None), max(at, default=None), labels


def test_base_equals_plain_search(spark):
    rng = random.Random(4)
    pieces = "mit MIT license License, apache general public the é gnu 漢 version-2.0 \n ( mit-license".split(" ")
    texts = [" ".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", " .;", "MIT License " * 3000, "licenſe mit Kelvin"]
    for text, row in zip(texts, scanned(spark, texts), strict=True):
        names = ("n_words", "n_base", "first_word", "last_word", "base_labels")
        assert tuple(row[name] for name in names) == base(text), text
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1


def test_given_documents(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = dict(documents.select("doc_id", "text").collect())
    for row in scan(documents).collect():
        found = tuple(row[name] for name in ("n_words", "n_base", "first_word", "last_word", "base_labels"))
        assert found == base(texts[row["doc_id"]])
        noted = re.search("[Ll]icensed under|Released under", texts[row["doc_id"]] or "")
        assert bool(row["labels"]) == bool(noted)


def test_statistics_equal_plain_search():
    rng = random.Random(5)
    machine = Automaton(SMALL, (), 2)
    templates = [text.split() for _, text in SMALL]
    names = {number: word.decode() for word, number in machine.ids.items()}
    for _ in range(300):
        ids = [rng.randrange(len(names)) for _ in range(rng.randint(1, 25))]
        words = [names[i] for i in ids]
        for at, (length, state) in enumerate(machine.statistics(ids), 1):
            held = {
                size: [
                    (number, end)
                    for number, text in enumerate(templates)
                    for end in range(size, len(text) + 1)
                    if text[end - size : end] == words[at - size : at]
                ]
                for size in range(1, at + 1)
            }
            assert length == max([size for size, places in held.items() if places], default=0)
            if length >= 2:
                assert machine.places[state] == held[length]


def test_chains_equal_plain_search():
    """Against the best of all ways through the matches."""
    rng = random.Random(6)

    def best(matches, gap):
        def follow(last):
            low, high, halt = matches[last]
            values = [0]
            for at, (begin, end, stop) in enumerate(matches):
                size = end - begin
                moves = low < begin and high < end and halt < stop and halt - (high - low) < stop - size
                if moves and begin - high <= gap and stop - size - halt <= gap:
                    overlap = max(0, high - begin, halt - (stop - size))
                    values.append(size - overlap + follow(at))
            return max(values)

        return max(end - begin + follow(at) for at, (begin, end, _) in enumerate(matches))

    for _ in range(400):
        matches = set()
        for _ in range(rng.randint(1, 7)):
            begin, size = rng.randint(0, 30), rng.randint(3, 8)
            matches.add((begin, begin + size, rng.randint(size, 40)))
        matches = sorted(matches, key=lambda m: m[1])
        gap = rng.choice((0, 4, 24))
        found = chains(matches, gap)
        assert max(covered for _, _, covered in found) == best(matches, gap)


def test_licences_changed_moved_and_cut(spark):
    rng = random.Random(7)
    texts, labels = [], []
    for label, text in (("mit", MIT), ("bsd", BSD), ("isc", ISC), ("apache", APACHE)):
        words = text.split()
        for share, found in ((0.04, True), (0.5, False)):
            changed = [w if rng.random() >= share else "zzz" for w in words]
            texts.append("some code\n" + " * ".join(changed) + "\nmore code " * 50)
            labels.append((label, found))
        texts.append(" ".join(words[: len(words) // 3]))
        labels.append((label, False))
    lesser = GNU.format(name="Lesser ", version=3)
    texts += [lesser, MIT + "x " * 40 + BSD, "Released under the MIT License.\n" * 400]
    labels += [("lgpl", True), ("bsd", True), ("mit", True)]
    rows = scanned(spark, texts)
    for row, (label, found) in zip(rows, labels, strict=True):
        named = set(row["labels"].split(","))
        if found:
            assert label in named and row["score"] >= 0.8
        else:
            assert not row["spans"] and row["score"] < 0.8
    assert {span["label"] for span in rows[-2]["spans"]} == {"mit", "bsd"}
    first, second = sorted((span["begin"], span["end"]) for span in rows[-2]["spans"])
    assert first[1] <= second[0] and first[0] == 0
    assert len(rows[-1]["spans"]) == 400 and rows[-1]["n_base"] == 400


@pytest.mark.parametrize("text", ["", "the license of an author", "without warranty of any kind"])
def test_clean_texts_have_no_label(spark, text):
    (row,) = scanned(spark, [text])
    assert row["labels"] == "" and row["spans"] == []


def test_every_template_is_found(spark):
    for (label, text), row in zip(TEMPLATES, scanned(spark, [t for _, t in TEMPLATES]), strict=True):
        assert label in row["labels"].split(","), text
        assert row["score"] == 1


def test_odd_rows(spark):
    rows = [(None, "MIT License", "x", 1), (1, None, "x", 1), (1, None, "x", 1), (2, "", None, 2)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = scan(frame).collect()
    assert sorted((str(row["doc_id"]), row["n_base"]) for row in found) == [
        ("1", 0), ("1", 0), ("2", 0), ("None", 1),
    ]
    assert scan(frame.limit(0)).collect() == []
    assert license_scan.automaton((), (("p", "one"),), 3).alone
    one = scan(frame, templates=(), phrases=(("p", "mit"),)).where("doc_id IS NULL").first()
    assert (one["n_base"], one["labels"], one["score"]) == (1, "p", 0)
