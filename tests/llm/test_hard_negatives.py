"""Hard negatives against a plain search, with blocks and groups small enough to be many."""

import itertools
import random

import duckdb
import numpy as np
import pytest

from barweave.llm import hard_negatives
from barweave.llm.hard_negatives import bounds, hilbert, mine, product

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, block bigint"


def plain(rows, every):
    kept = []
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not np.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        kept.append((vec_id, [int(np.floor(256 * float(np.float32(x)))) for x in vector], label))
    out = []
    for at, (vec_id, vector, label) in enumerate(kept):
        if vec_id % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(vector, other, strict=False)), name, theirs == label)
            for place, (name, other, theirs) in enumerate(kept)
            if place != at
        )
        for score, positive, _ in [row for row in scored if row[2]][:5]:
            good = [
                (name, -negative)
                for negative, name, same in scored
                if not same and 30 * -score <= 100 * -negative <= 90 * -score
            ]
            for rank, (name, negative) in enumerate(good[:10], 1):
                out.append((vec_id, positive, rank, name, -score, negative))
    return sorted(out)


def clustered(n, dims=6, labels=4, seed=1):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = []
    for number in range(n):
        middle = middles[0] if number % 3 == 0 else rng.choice(middles)
        vector = [float(np.float32(x + rng.gauss(0, 0.1 if number % 3 else 0.001))) for x in middle]
        rows.append((number, vector, rng.randrange(labels), "x", 3))
    return rows


@pytest.mark.parametrize(("every", "options"), [(20, {"block_rows": 16, "group_bytes": 200}), (9, {})])
def test_equals_plain_search(spark, every, options):
    rows = clustered(240)
    # Nothing of these takes part, but for a short, an empty and a repeated vector.
    rows += [
        (None, rows[0][1], 1, "x", 3),
        (20_000, None, 1, "x", 3),
        (20_020, rows[0][1], None, "x", 3),
        (20_040, [1.0, None], 1, "x", 3),
        (20_060, [1.0, float("nan")], 1, "x", 3),
        (20_080, [float("inf")], 1, "x", 3),
        (20_100, [0.5, 0.25], 1, "x", 3),
        (20_120, [], 1, "x", 3),
        (-40, rows[5][1], 2, "x", 3),
        rows[20], rows[20], rows[31], rows[32], rows[33],
    ]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = sorted(map(tuple, mine(frame, every=every, **options).collect()))
    assert found == plain(rows, every)


def test_plain_search_equals_sql(spark, sf_dir):
    database = duckdb.connect()
    database.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    rows = database.sql("SELECT vec_id, embedding, label FROM embeddings").fetchall()
    assert sorted(database.sql(hard_negatives.SQL).fetchall()) == plain(rows, 100)


def test_no_rows_no_anchors_no_positives(spark):
    frame = spark.createDataFrame([(1, [1.0], 1, "x", 3), (100, [1.0], 2, "x", 3)], SCHEMA)
    assert mine(frame.limit(0)).collect() == []
    assert mine(frame.where("vec_id = 1")).collect() == []
    assert mine(frame).collect() == []


def test_curve_visits_neighbours():
    """Every cell once, and each next one beside the last."""
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        order = hilbert(cells, bits)
        assert sorted(order.tolist()) == list(range(len(cells)))
        way = cells[np.argsort(order)]
        assert (np.abs(np.diff(way, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_products_are_exact():
    rng = np.random.default_rng(2)
    for reach in (200, 1 << 28, 1 << 40):
        box = rng.integers(-reach, reach, (30, 5))
        anchors = rng.integers(-200, 200, (7, 5))
        exact = [[sum(int(x) * int(y) for x, y in zip(a, b, strict=True)) for b in box] for a in anchors]
        assert product(anchors, box).tolist() == exact
        group = hard_negatives.Group(None, None, None, None, anchors)
        low, high = box.min(axis=0)[None, :], box.max(axis=0)[None, :]
        least, most = bounds(group, low, high)
        assert (least[:, 0] <= np.min(exact, axis=1)).all()
        assert (most[:, 0] >= np.max(exact, axis=1)).all()
    with pytest.raises(OverflowError):
        product(np.full((1, 2), 1 << 50), np.full((1, 2), 1 << 50))


def test_blocks_that_cannot_hold_a_match_are_not_read(spark):
    """Vectors in tight, far clusters: an anchor's blocks are few."""
    rng = np.random.default_rng(3)
    rows = []
    for number in range(1200):
        middle = np.zeros(4)
        middle[number % 4] = 1.0
        rows.append((number, (middle + rng.normal(0, 0.01, 4)).tolist(), number % 4, "x", 3))
    usable = hard_negatives.usable(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label")
    usable = hard_negatives.checkpointed(usable)
    blocks = hard_negatives.write_blocks(usable, hard_negatives._shape(usable), 32)
    (group,) = hard_negatives.anchor_groups(spark, blocks, 400, 100)
    reached = np.full(len(group.at), 50_000)
    picked = hard_negatives.chosen(
        spark, blocks, group, lambda g, z: z.most >= reached[:, None]
    )
    assert 0 < picked.count() < 0.5 * blocks.zones(spark).count()
