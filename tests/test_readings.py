import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from calorgrid.operators.readings import faulty_readings, haar_details, runs_without_detail

SCHEMA = "det_id long, spot_id long, captured_at timestamp, t_max double, t_p99 double, over_range boolean, part int, kind string, at string"


def brute(rows):
    out, spots = set(), {}
    for r in rows:
        i, s, at, m, p, o = r[:6]
        bad = any(v is not None and (v != v or v < -60 or v > 650) for v in (m, p))
        bad = bad or (m is not None and p is not None and p > m) or (m is not None and o is not None and o != (m > 250))
        if bad:
            out.add((i, "impossible"))
        elif s is not None:
            spots.setdefault(s, []).append(r)
    for each in spots.values():
        for c in (3, 4):
            x = [(r[0], r[c]) for r in each if r[c] is not None]
            if x:
                med = np.median([v for _, v in x])
                mad = np.median([abs(v - med) for _, v in x])
                out |= {(i, "spike") for i, v in x if abs(v - med) >= 8 - 1e-9 and abs(v - med) >= 12 * mad - 1e-9}
        line = [(r[3], r[0]) for r in sorted(each, key=lambda r: (r[2] is None, r[2] or datetime.min, r[0])) if r[3] is not None]
        k = 0
        while k < len(line):
            j = k
            while j < len(line) and line[j][0] == line[k][0]:
                j += 1
            if j - k >= 6:
                out |= {(i, "stuck") for _, i in line[k:j]}
            k = j
    return out


def rows(seed, n, hot):
    r = random.Random(seed)
    out, t0 = [], datetime(2024, 1, 1)
    level = {}
    for i in range(n):
        s = 1 if r.random() < hot else r.choice([None, 2, 3, 4, 5, 6, 7])
        m = level.get(s, 50.0) if r.random() < 0.55 else round(50 + r.gauss(0, 0.4), 1)
        level[s] = m
        if r.random() < 0.03:
            m = r.choice([None, float("nan"), float("inf"), 700.0, -99.0, 95.0, 260.0, -0.0])
        p = r.choice([None, m, m, m]) if m is None or m != m else (None if r.random() < 0.05 else m - r.choice([0, 1.0, 1.2, -0.5 if r.random() < 0.1 else 2]))
        o = r.choice([None, m is not None and m > 250, m is not None and m > 250])
        at = None if r.random() < 0.02 else t0 + timedelta(minutes=r.randint(0, n // 2))
        out.append((i, s, at, m, p, o, 9, "clash", "clash"))
    return out


@pytest.mark.parametrize("seed,n,hot", [(1, 400, 0.9), (2, 600, 0.33), (3, 30, 0.5)])
def test_all_kinds_against_a_plain_loop(spark, seed, n, hot):
    data = rows(seed, n, hot)
    got = faulty_readings(spark.createDataFrame(data, SCHEMA).repartition(7)).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert {tuple(x) for x in got} == brute(data)


def test_no_rows_and_null_rows(spark):
    assert faulty_readings(spark.createDataFrame([], SCHEMA)).count() == 0
    assert faulty_readings(spark.createDataFrame([(None,) * 9, (1, 1, None, None, None, None, None, None, None)], SCHEMA)).count() == 0


def test_the_decomposition_adds_up():
    x = np.random.default_rng(0).normal(size=77)
    d, a = haar_details(x)
    assert np.allclose(d.sum(axis=0) + a, x)
    run, length = runs_without_detail(np.array([1.0, 1.0, 2.0, 1.0, 1.0, 1.0]))
    assert length[run].tolist() == [2, 2, 1, 3, 3, 3]
