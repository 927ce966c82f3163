"""Ranks without a global sort: exact percentiles and ntiles."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradewinds.operators import positions
from tradewinds.operators.positions import ntile_cuts, percentiles, tile_of


@pytest.mark.parametrize("n,tiles", [(0, 5), (1, 5), (3, 5), (5, 5), (23, 5), (101, 10), (2000, 5)])
def test_ntile_equals_the_window(spark, n, tiles):
    rng = random.Random(n)
    # a third of all rows in one group with one value, and missing values
    data = [
        ("hot" if i % 3 == 0 else f"g{i % 5}", 7.0 if i % 3 == 0 else rng.choice([None, float(rng.randint(0, 9))]), f"id{i}")
        for i in range(n)
    ]
    df = spark.createDataFrame(data, "grp string, value double, id string")
    cuts = ntile_cuts(df, tiles)
    assert cuts.where(F.size("cuts") >= tiles).count() == 0
    got = df.join(cuts, "grp", "left").select("id", tile_of(F.col("value"), F.col("id"), F.col("cuts")))
    window = Window.partitionBy("grp").orderBy("value", "id")
    assert rows(got) == rows(df.select("id", F.ntile(tiles).over(window)))


def test_percentiles_equal_numpy(spark):
    rng = random.Random(1)
    data = [("a", 5.0)] * 400 + [("a", rng.random() * 100) for _ in range(600)] + [("b", float(i)) for i in range(4)]
    data += [("c", 1.5), ("c", None)]
    df = spark.createDataFrame(data, "grp string, value double")
    shares = {"q1": 0.25, "mid": 0.5, "q9": 0.9}
    got = {r["grp"]: [r[n] for n in shares] for r in percentiles(df, shares).collect()}
    for grp in "abc":
        values = [v for g, v in data if g == grp and v is not None]
        assert got[grp] == pytest.approx([np.quantile(values, s) for s in shares.values()])


def test_only_the_wanted_partitions_are_sorted(spark):
    """No exchange brings the whole table into one partition."""
    df = spark.range(1000).select(F.lit("all").alias("grp"), F.rand(1).alias("value"), F.col("id").cast("string"))
    cuts = ntile_cuts(df, 5)
    plan = cuts._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("limit", [1_000_000, 50])
def test_one_value_of_nine_tenths(spark, monkeypatch, limit):
    """Cuts inside of a value that very many rows share; with `limit` 50 the ids are counted by prefixes."""
    monkeypatch.setattr(positions, "RANKED_ROWS", limit)
    rng = random.Random(3)
    data = [("g", 1.0 if rng.random() < 0.9 else rng.random() * 3, f"customer-{rng.randrange(10**6):07d}") for _ in range(4_000)]
    data += [("g", 1.0, "customer-0000001")] * 90 + [("g", 1.0, "é" * k) for k in range(40)]
    data += [("nulls", None, f"n{k}") for k in range(300)] + [("nulls", float("nan"), f"x{k}") for k in range(300)]
    data += [("same", 2.0, "one id")] * 200
    df = spark.createDataFrame(data, "grp string, value double, id string")
    window = Window.partitionBy("grp").orderBy("value", "id")
    want = {
        (r.grp, r.tile): (r.value, r.id)
        for r in df.withColumn("tile", F.ntile(5).over(window)).withColumn("at", F.row_number().over(window))
        .withColumn("first", F.min("at").over(Window.partitionBy("grp", "tile"))).where("at = first").collect()
    }
    for r in ntile_cuts(df, 5).collect():
        for tile, cut in enumerate(r.cuts, 2):
            value, id_ = want[r.grp, tile]
            assert cut.id == id_ and (cut.value == value or value is None or value != value)


def test_brackets_hold_ranks_of_many_values(spark, monkeypatch):
    """A coarse sketch: brackets must hold the ranks all the same, and few rows are counted by value."""
    monkeypatch.setattr(positions, "GRID", 20)
    monkeypatch.setattr(positions, "ACCURACY", 50)
    df = spark.range(60_000).select(
        F.when(F.col("id") % 7 == 0, "b").otherwise("a").alias("grp"), F.log1p(F.rand(5) * 1e6).alias("value"),
        F.md5(F.col("id").cast("string")).alias("id"),
    ).persist()
    got = df.join(ntile_cuts(df, 10), "grp").select("id", tile_of(F.col("value"), F.col("id"), F.col("cuts")))
    window = Window.partitionBy("grp").orderBy("value", "id")
    assert rows(got) == rows(df.select("id", F.ntile(10).over(window)))
    df.unpersist()


def test_rows_are_neither_sorted_nor_written(spark, monkeypatch):
    """Only tables of a few rows per group are staged."""
    written = []
    monkeypatch.setattr(positions, "stage", lambda df, name, old=positions.stage: written.append(old(df, name)) or written[-1])
    df = spark.range(50_000).select(F.lit("all").alias("grp"), F.rand(2).alias("value"), F.col("id").cast("string"))
    ntile_cuts(df, 5).collect()
    assert written and all(t.count() <= 4 for t in written)
