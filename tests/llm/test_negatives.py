"""Hard negatives against scoring all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from indicator_lake.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, v string, rank int, row string"


def brute(rows, every=5, wanted=negatives.Wanted()):
    usable = {}
    for i, x, label in rows:
        if i is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        one = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * c) for c in x])
        usable[i] = min(usable.get(i, one), one)
    out = []
    for a, (own, x) in usable.items():
        if a % every:
            continue
        scored = sorted(
            (-sum(p * q for p, q in zip(x, y, strict=True)), i, label) for i, (label, y) in usable.items() if i != a and len(y) == len(x)
        )
        for s, p, _ in [t for t in scored if t[2] == own][: wanted.positives]:
            inside = [(i, n) for n, i, label in scored if label != own and 50 * -s <= 100 * -n <= 95 * -s][: wanted.negatives]
            out += [(a, p, k, i, -s, -n) for k, (i, n) in enumerate(inside, 1)]
    return sorted(out)


def mined(llm, rows):
    table = llm.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    prepared = negatives.prepared(table, negatives.relabelled())
    return sorted(tuple(r) for r in negatives.mine(prepared, F.col("vec_id") % 5 == 0).collect())


@pytest.mark.parametrize("block", [8, 60, 8192])
def test_mining_equals_brute_force(llm, monkeypatch, block):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "FIRST_DEPTH", 2)
    rng = random.Random(block)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(160):
        c = rng.choice(centres)
        rows.append((i, [round(x + rng.gauss(0, 0.4), rng.choice([0, 3])) for x in c], rng.randint(0, 3)))
    rows += [(200 + i, rows[0][1], i % 4) for i in range(30)]  # many equal scores
    rows += [(300, None, 1), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (302, [float("nan")] * 6, 1), (303, [float("inf")] * 6, 1)]
    rows += [(304, [0.0] * 6, 1), (305, [], 1), (310, [], 1), (315, [1.0, 2.0], 1), (320, [2.0, 2.0], 1), (321, [1.5, 0.9], 2)]
    rows += [(None, rows[1][1], 1), (325, rows[1][1], None), rows[5], (5, rows[9][1], 0)]  # repeated row, repeated id
    assert mined(llm, rows) == brute(rows)


def test_passes_do_not_change_the_result(llm, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)], rng.randint(0, 1)) for i in range(80)]
    monkeypatch.setattr(negatives, "PASS_VALUES", 20)
    assert mined(llm, rows) == brute(rows)


def test_nothing_to_mine(llm):
    assert mined(llm, []) == []
    assert mined(llm, [(5, [1.0], 1)]) == []
    assert mined(llm, [(5, [1.0], 1), (6, [1.0], 1)]) == []  # no other label


def test_very_large_components_are_exact():
    rows = np.array([[10**12, 3], [-(10**12), 5], [10**12, 4]], np.int64)
    anchor = np.array([[10**12, 1]], np.int64)
    rows, anchor = negatives.exact([rows, anchor])
    lists = negatives.Lists(np.arange(3), rows)
    places, scores = lists.search(anchor[0], lambda *_: False)
    assert sorted(map(int, scores)) == [5 - 10**24, 10**24 + 3, 10**24 + 4]
    assert lists.ids[places][negatives.best(lists.ids[places], scores, 1)].tolist() == [2]


def test_search_stops_before_all_rows_are_met():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-20, 20, (4000, 3)).astype(float)
    vectors[7] = 300
    lists = negatives.Lists(np.arange(4000), vectors)
    places, scores = lists.search(np.array([1.0, 1.0, 1.0]), lambda rows, found, threshold: threshold < found.max())
    assert 7 in places and len(places) < 400
