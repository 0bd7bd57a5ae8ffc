"""Proportions of the splits, against the best that whole groups allow, and hot groups."""

import itertools
import random

import numpy as np
import pytest

from calorgrid.llm import splits
from test_records import FRAME, MOVES, frame

SHARE = np.array([0.8, 0.1, 0.1])


def off(labels, out, share):
    """Largest miss of any split's share, of all records and of each label, in shares of the label."""
    g = np.column_stack([labels, labels.sum(axis=1)]).astype(float)
    have = np.array([g[out == k].sum(axis=0) for k in range(len(share))])
    return have / g.sum(axis=0) - share[:, None]


@pytest.mark.parametrize("seed", range(40))
def test_small_cases_against_all_placements(seed):
    r = np.random.default_rng(seed)
    labels = r.integers(0, r.choice([3, 30, 200]), (7, 2)) + 1
    share = np.array([0.6, 0.2, 0.2])
    out = splits.place(labels, np.outer(share, labels.sum(axis=0)))
    best = min((off(labels, np.array(k), share) ** 2).sum() for k in itertools.product(range(3), repeat=7))
    assert (off(labels, out, share) ** 2).sum() <= 2 * best + 0.01


@pytest.mark.parametrize("seed,groups,hot", [(1, 50, 0.0), (2, 400, 0.3), (3, 3000, 0.33), (4, 48, 0.1)])
def test_every_label_has_its_share(seed, groups, hot):
    r = np.random.default_rng(seed)
    size = np.maximum(1, r.pareto(1.5, groups) * 10).astype(int)
    size = np.minimum(size, max(2, size.sum() // 12))
    size[0] = max(size[0], int(hot / (1 - hot) * size[1:].sum()))
    labels = np.array([r.multinomial(n, r.dirichlet([5, 3, 1, 0.3])) for n in size])
    out = splits.place(labels, np.outer(SHARE, labels.sum(axis=0)))
    miss = np.abs(off(labels, out, SHARE))
    assert miss[:, -1].max() < 0.02 and miss.max() < (0.08 if groups < 100 else 0.02)


def test_a_hot_cabinet_stays_whole(spark):
    r = random.Random(3)
    frames = [frame(i, f"C1_B1_P1_2024-01-01_IR1_{i:05d}" if i % 3 == 0 else f"C{r.randint(2, 60)}_B1_P{r.randint(1, 3)}_2024-01-01_IR1_{i:05d}", verdict=r.choice(["normal", "caution", None])) for i in range(1500)]
    df = spark.createDataFrame(frames, FRAME)
    out = splits.frame_splits(df, spark.createDataFrame([], MOVES), {"train": 0.8, "val": 0.1, "test": 0.1}, ("normal", "caution"))
    got = out.collect()
    assert len(got) == 1500 and len({(x["group_key"], x["split"]) for x in got}) == len({x["group_key"] for x in got})
    shares = splits.split_shares(df, out, {"train": 0.8, "val": 0.1, "test": 0.1}, ("normal", "caution"), 0.02).collect()
    assert len(shares) == 12 and all(x["kept"] for x in shares)
    assert all(abs(x["share"] - (0.8 if x["split"] == "train" else 0.1)) < 0.02 for x in shares if x["label"] == "(all)")
    assert splits.split_shares(df.limit(0), out.limit(0), {"train": 1.0}, ("normal",), 0.1).count() == 0
