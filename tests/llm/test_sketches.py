"""Shapes of the sketches, counters that are merged, and the tree of additions."""

import random

import numpy as np
import pytest

from calorgrid.llm import quantiles as q
from test_records import rank_error


def test_epsilon_and_delta_set_width_and_rows():
    small, wide, sure = q.shape_for(0.05, 0.1), q.shape_for(0.005, 0.1), q.shape_for(0.05, 1e-6)
    assert wide.width_bits > small.width_bits and wide.rows == small.rows
    assert sure.rows > small.rows and all(s.rows % 2 for s in (small, wide, sure))
    for bad in ((0, 0.1), (0.1, 1), (0.1, 1e-40)):
        with pytest.raises(ValueError):
            q.shape_for(*bad)
    with pytest.raises(ValueError):
        q.merge([q.pack(q.encode(np.arange(9.0)), np.ones(9, int), small, 0)], 1, wide)


@pytest.mark.parametrize("epsilon", [0.05, 0.02, 0.005])
def test_counters_keep_epsilon(epsilon):
    g = np.random.default_rng(8)
    shape = q.shape_for(epsilon, 0.05)
    for v in (g.normal(60, 15, 60000), g.integers(0, 12, 60000) / 4, np.concatenate([g.normal(0, 1, 59000), g.uniform(-1e12, 1e12, 1000)]), np.exp(g.normal(0, 8, 60000))):
        parts = [q.pack(q.encode(x), np.ones(len(x), int), shape, 0) for x in np.array_split(v, 30)]
        assert {p[:1] for p in parts} == {b"c"}
        shares = [0.01, 0.25, 0.5, 0.9, 0.95, 0.99]
        n, got = q.quantiles(q.merge(parts, 1, shape, 0), shares, shape)
        assert n == len(v) and max(rank_error(np.sort(v), x, s) for s, x in zip(shares, got, strict=True)) <= epsilon


@pytest.mark.parametrize("most", [None, 0])
def test_no_task_adds_more_than_the_fan_in(spark, most):
    r = random.Random(6)
    rows = [(r.choice(["a", "a", "b", None]), i % 40, r.choice([None, float("inf"), r.gauss(50, 9)])) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, d int, v double").repartition(9)
    shape = q.shape_for(0.1, 0.3)
    days = q.summarise(df, ["g", "d"], "v", shape, most)
    got = {x["g"]: (x["n"], x["p50"]) for x in q.answers(q.merged(days, ["g"], shape, most, fan_in=3), ["g"], {"p50": 0.5}, shape).collect()}
    want = {x["g"]: (x["n"], x["p50"]) for x in q.answers(q.summarise(df, ["g"], "v", shape, most), ["g"], {"p50": 0.5}, shape).collect()}
    assert got == want and len(got) == 3  # ``merged`` raises where a task is given more
    assert q.answers(q.merged(q.summarise(df.limit(0), ["g"], "v"), ["g"]), ["g"], {"p50": 0.5}).count() == 0


def test_a_partition_gives_several_summaries(spark):
    df = spark.range(0, 5000, 1, 3).selectExpr("cast(id % 2 as string) g", "cast(id as double) v")
    got = {x["g"]: x["n"] for x in q.answers(q.summarise(df, ["g"], "v", held_rows=100), ["g"], {"p50": 0.5}).collect()}
    assert got == {"0": 2500, "1": 2500}
