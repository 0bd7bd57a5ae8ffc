"""What the wavelet step decides, and stretches that are cut."""

import numpy as np
import pytest

from calorgrid.operators import readings
from test_readings import SCHEMA, brute, rows


def series(seed):
    g = np.random.default_rng(seed)
    n = int(g.integers(1, 400))
    x = 50 + g.normal(0, g.choice([0.05, 0.5, 3.0]), n) + g.choice([0, 6]) * np.sin(np.arange(n) / 9) + np.where(np.arange(n) > n * g.random(), g.choice([0, 10, 40]), 0)
    at = g.integers(0, n, n // 30)
    x[at] += g.choice([-60, -9, -8, 8, 9, 70], len(at))
    return np.round(x, int(g.choice([0, 1, 6])))


@pytest.mark.parametrize("seed", range(300))
def test_no_spike_is_missed(seed):
    x = series(seed)
    middle, spread = readings.middle_and_spread(x)
    off = np.abs(x - middle)
    want = (off >= 8 - 1e-9) & (off >= 12 * spread - 1e-9)
    for known in (None, (middle, spread)):
        assert (readings.spikes(x, known, 8.0, 12.0) == want).all()
    assert not (want & ~readings.candidates(x, 8.0 - 2e-9)).any()


def test_only_candidates_are_measured(monkeypatch):
    """The decomposition decides: nearly all quiet sources need no medians, of the others only the candidates come to the check."""
    g = np.random.default_rng(5)
    quiet = [np.round(40 + g.normal(0, 0.3, 300), 1) for _ in range(50)]
    calls = []
    exact = readings.middle_and_spread
    monkeypatch.setattr(readings, "middle_and_spread", lambda x: calls.append(len(x)) or exact(x))
    assert not any(readings.spikes(x, None, 8.0, 12.0).any() for x in quiet) and len(calls) <= 5
    calls.clear()
    spiked = [x.copy() for x in quiet]
    for x in spiked:
        x[[50, 200]] += 30
    assert all(readings.spikes(x, None, 8.0, 12.0).sum() == 2 for x in spiked) and len(calls) == 50
    assert max(readings.candidates(x, 8.0).sum() for x in spiked) <= 20
    monkeypatch.setattr(readings, "candidates", lambda x, *_: np.zeros(len(x), dtype=bool))
    assert not any(readings.spikes(x, None, 8.0, 12.0).any() for x in spiked)


def test_neighbouring_numbers_are_not_stuck():
    x = np.array([1.0, np.nextafter(1.0, 2), 1.0, 1.0, 60.1, np.nextafter(60.1, 0)])
    assert readings.runs_without_detail(x)[1].tolist() == [1, 1, 2, 1, 1]


@pytest.mark.parametrize("seed,n,hot,held", [(11, 500, 0.9, 20), (12, 700, 0.4, 1), (13, 300, 0.6, 50)])
def test_long_stretches_are_cut_and_sewn(spark, seed, n, hot, held):
    data = rows(seed, n, hot)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        got = readings.faulty_readings(spark.createDataFrame(data, SCHEMA).repartition(7), held=held).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(set(map(tuple, got))) and {tuple(x) for x in got} == brute(data)
