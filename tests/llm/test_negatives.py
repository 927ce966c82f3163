"""Hard negatives: against all pairs, the bounds on their own, and odd tables."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from llm_helpers import rows
from pyspark.sql import functions as F

from tradewinds.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(table, every=5, positives=5, k=3, low=50, high=95):
    whole = [
        (i, label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, label in table
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    anchors = {}
    for i, label, v in whole:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (label, len(v), v)), (label, len(v), v))
    out = []
    for i, (label, size, v) in anchors.items():
        scored = [(-sum(x * y for x, y in zip(v, w)), j, other) for j, other, w in whole if j != i and len(w) == size]
        for score, j, _ in sorted(s[:2] + (None,) for s in scored if s[2] == label)[:positives]:
            found = sorted(s[:2] for s in scored if s[2] != label and low * -score <= 100 * -s[0] <= high * -score)
            out += [(i, j, n + 1, negative, -score, -other) for n, (other, negative) in enumerate(found[:k])]
    return sorted(out, key=repr)


def run(spark, table, every=5, **more):
    df = spark.createDataFrame(table, SCHEMA)
    for name in ("row", "size", "v", "mean", "deviation", "window", "score", "group", "block", "anchor_id", "groups"):
        df = df.withColumn(name, F.lit(name))
    return rows(negatives.hard_negatives(df, F.col("vec_id") % every == 0, **more))


def random_table(n, size, seed, labels=4):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(labels, size))
    kind = np.where(random.random(n) < 0.4, 0, random.integers(0, labels, n))
    v = centres[random.integers(0, labels, n)] * 0.5 + centres[kind] + random.normal(size=(n, size)) + 0.3
    return [(int(i), [float(x) for x in v[i]], int(kind[i])) for i in range(n)]


@pytest.mark.parametrize("size", [1, 3, 16, 37])
def test_against_all_pairs(spark, size):
    table = random_table(300, size, size)
    assert run(spark, table) == brute(table)


def test_small_blocks_and_groups(spark):
    table = random_table(400, 20, 7)
    want = brute(table)
    assert want and run(spark, table, group_rows=9, block_rows=25) == want


def test_keys_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BROADCAST_KEYS", 0)
    table = random_table(200, 8, 9)
    assert run(spark, table, group_rows=5, block_rows=20) == brute(table)


def test_odd_rows(spark):
    table = random_table(60, 6, 3)
    table += [
        (None, [1.0] * 6, 0), (100, None, 0), (105, [], 1), (110, [1.0] * 6, None), (115, [1.0, None] * 3, 0),
        (120, [float("nan")] * 6, 0), (125, [float("inf")] * 6, 1), (130, [2.0, 1.0], 0), (131, [2.0, 1.5], 0),
        (132, [1.5, 1.0], 1), (133, [1.0, 1.0], 2), (135, [0.0] * 6, 0), (140, [-3.0] * 6, 2), (145, [9.0], 7),
    ]
    # An id that repeats, with another vector, another label and as it is; equal vectors with ids of their own.
    table += [(5, [0.5] * 6, 1), (5, [0.5] * 6, 1), (7, table[7][1], table[7][2])]
    table += [(200 + k, table[10][1], table[10][2] if k % 2 else 9) for k in range(12)]
    assert run(spark, table) == brute(table)
    assert run(spark, table, block_rows=10) == brute(table)


def test_huge_components(spark):
    table = [(k, [2.0**18 * (k % 7 + 1), 2.0**17, -3.0 * k], k % 3) for k in range(30)]
    assert run(spark, table) == brute(table)


def test_no_rows_and_no_anchors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []
    assert run(spark, [(5, [1.0], 0)]) == []


def test_other_windows(spark):
    table = random_table(150, 12, 11)
    got = run(spark, table, positives=2, negatives=7, low=-80, high=99)
    assert got == brute(table, positives=2, k=7, low=-80, high=99)


def test_bounds_hold_and_narrow():
    random = np.random.default_rng(1)
    for size in (1, 5, 16, 64, 67):
        v = np.floor(random.normal(size=(80, size)) * 100 + 40).astype(np.int64)
        mean, deviation = negatives.summaries(v)
        side = negatives._Side(pd.DataFrame({"v": list(v), "mean": list(mean), "deviation": list(deviation)}))
        exact, last = v @ v.T, None
        for m, d in side.levels:
            centre, reach = m @ m.T, d @ d.T
            assert (np.abs(exact - centre) <= reach + 1e-6 * np.abs(exact).max()).all()
            assert last is None or (reach <= last + 1e-6 * last.max()).all()
            last = reach
