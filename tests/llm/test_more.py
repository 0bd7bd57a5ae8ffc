"""Large figures in near pairs, vocabularies out of order, packings of the least number."""

import json

import numpy as np
import pytest

from calorgrid.llm import packing
from calorgrid.llm.bpe import Encoder
from calorgrid.llm.overlap import cross_split_pairs
from test_records import FRAME, frame


def test_figures_of_any_size(spark):
    stem = "C1_B1_P1_2024-01-01_IR1_00001"
    near = "C1_B1_P1_2024-01-01_IR1_00012"
    rows, want = [], set()
    for k, x in enumerate((1e13, -3e15, 1e300, 0.0, -0.05, 99.96)):
        rows += [frame(10 * k, stem, figures=(x, 1.0, 2.0, 3.0)), frame(10 * k + 1, near, split="val", figures=(x if abs(x) > 1e3 else x + 0.09, 1.0, 2.0, 3.0))]
        want.add((10 * k, 10 * k + 1))
    want |= {(30, 41), (40, 31)} & set()
    for k, x in ((100, float("nan")), (200, float("inf")), (300, None)):
        rows += [frame(k, stem, figures=(x, 1.0, 2.0, 3.0)), frame(k + 1, near, split="val", figures=(x, 1.0, 2.0, 3.0))]
    got = {tuple(x) for x in cross_split_pairs(spark.createDataFrame(rows, FRAME)).collect()}
    truth = set()
    for a in rows:
        for b in rows:
            if a[4] == "train" and b[4] == "val" and all(x is not None and y is not None and abs(x - y) <= 0.1 + 1e-9 for x, y in zip(a[6:10], b[6:10], strict=True)):
                truth.add((min(a[0], b[0]), max(a[0], b[0])))
    assert want <= got == truth and not any(i >= 100 for pair in got for i in pair)


def test_numbers_must_rise_with_the_merges(tmp_path):
    letters = {chr(b): i for i, b in enumerate([*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)])}
    n = len(letters)
    letters |= {chr(0x100 + i): n + i for i in range(68)}
    path = tmp_path / "v.json"
    for ids, fine in (((256, 257), True), ((257, 256), False)):
        vocab = letters | {"ab": ids[0], "abc": ids[1]}
        path.write_text(json.dumps({"model": {"vocab": vocab, "merges": ["a b", "ab c"]}}))
        if fine:
            assert Encoder(str(path)).encode("abcab") == [257, 256]
        else:
            with pytest.raises(ValueError, match="rise"):
                Encoder(str(path))


@pytest.mark.parametrize("capacity", [64, 512, 2048])
def test_the_least_number_of_containers(capacity):
    g = np.random.default_rng(capacity)
    sizes = np.minimum(capacity, np.maximum(1, g.lognormal(np.log(capacity / 8), 0.9, 4000))).astype(int)
    counts = dict(zip(*np.unique(sizes, return_counts=True), strict=True))
    used = sum(times for times, _ in packing.plan({int(k): int(v) for k, v in counts.items()}, capacity))
    assert used == -(-int(sizes.sum()) // capacity)
