import numpy as np
import pytest
from brute import hard_negatives as brute_negatives

from tablekit.llm import hard_negatives as module
from tablekit.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int, score string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def result(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def integers(rows):
    return [(i, [int(np.floor(256 * x)) for x in v], label) for i, v, label in rows]


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v], label, "taken") for i, v, label in rows], SCHEMA)


def clustered(rng, n, labels=4, size=12):
    centres = rng.normal(size=(labels, size))
    of = rng.integers(0, labels, n)
    x = centres[rng.integers(0, labels, n)] + rng.normal(size=(n, size)) * rng.choice([0.05, 0.5, 2], (n, 1))
    return [(i, (x[i] * rng.choice([0.2, 1, 3])).tolist(), int(of[i])) for i in range(n)]


@pytest.mark.parametrize("numbers", [1 << 22, 600])
def test_against_brute_force_whatever_the_shards(spark, monkeypatch, numbers):
    monkeypatch.setattr(module, "SHARD_NUMBERS", numbers)
    monkeypatch.setattr(module, "STEP", 16)
    monkeypatch.setattr(module, "TOGETHER", 3)
    rows = clustered(np.random.default_rng(1), 400)
    expected = brute_negatives(integers(rows), 10)
    assert len(expected) > 500
    assert result(hard_negatives(frame(spark, rows), 10)) == expected


def test_ties_copies_and_few_rows(spark):
    rows = [(i, [1.0, 0.5 if i % 3 else -0.25], i % 2) for i in range(40)]
    assert result(hard_negatives(frame(spark, rows), 4)) == brute_negatives(integers(rows), 4)
    assert result(hard_negatives(frame(spark, rows[:1]), 4)) == []
    opposite = [(0, [1.0, 0.0], 1), (2, [-1.0, 0.0], 1), (3, [-0.5, 0.1], 2), (4, [0.0, 0.0], 1), (5, [0.0, 0.0], 2)]
    assert result(hard_negatives(frame(spark, opposite), 2)) == brute_negatives(integers(opposite), 2)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(i, [0.1 * i, 1.0, -0.3], i % 3) for i in range(30)]
    short = [(100 + i, [1.0, 0.01 * i], i % 2) for i in range(10)]
    blank = [(200, [], 1), (201, [], 1), (202, [], 2)]
    odd = [(None, [1.0, 1.0, 1.0], 1), (300, None, 1), (310, [1.0, None, 1.0], 1), (320, [inf, 1.0, 1.0], 0), (330, [nan, 1.0, 0.0], 0), (340, [1.0, 1.0, 1.0], None)]
    again = [(6, [0.6, 1.0, -0.3], 0), (9, [9.0, 9.0, 9.0], 2)]  # a repeated row; an id with two rows, of which the smaller label counts
    df = spark.createDataFrame([(*r, "x") for r in good + short + blank + odd + again], SCHEMA)
    expected = brute_negatives(integers(good + short + blank), 2)
    assert any(r[0] == 200 for r in expected) and any(r[0] >= 100 for r in expected)
    assert result(hard_negatives(df, 2)) == expected
    assert hard_negatives(df.limit(0), 2).count() == 0


def test_large_numbers_stay_exact_or_fail(spark):
    rows = [(i, [float(2**22 + 3 * i), float(2**21 - i)], i % 2) for i in range(12)]
    assert result(hard_negatives(frame(spark, rows), 3, most=100)) == brute_negatives(integers(rows), 3, most=100)
    with pytest.raises(Exception, match="do not fit"):
        hard_negatives(frame(spark, [(i, [1e15, 1e15], 1) for i in range(4)]), 2).collect()


def test_a_walk_ends_long_before_the_list_where_bounds_allow(monkeypatch):
    scored = []
    real = module._scores
    monkeypatch.setattr(module, "_scores", lambda a, b: scored.append(len(b)) or real(a, b))
    rng = np.random.default_rng(2)
    x = rng.normal(size=(20_000, 8)) * 0.01 + np.eye(8)[rng.integers(0, 8, 20_000)]
    vectors = np.floor(256 * x).astype(np.int64)
    shard = module.Shard(np.arange(20_000), np.ones(20_000, np.int64), vectors)
    centre = np.eye(8)[0]
    anchors = np.floor(256 * (centre + rng.normal(size=(5, 8)) * 0.01)).astype(np.int64)
    shard.sort_for(0, centre, 0.15)
    limits = np.full((5, 1), -(2**62)), np.full((5, 1), 2**62)
    found = {i: ids.tolist() for i, _, ids, _ in module.best_of_shard(shard, -np.arange(1, 6), np.ones(5, np.int64), anchors, True, *limits, 5)}
    for i in range(5):
        scores = vectors @ anchors[i]
        assert found[i] == np.lexsort((np.arange(20_000), -scores))[:5].tolist()
    assert sum(scored) < 8_000
