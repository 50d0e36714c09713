"""The detector scores stretches whole; this walks one reading at a time with
plain lists and must find the same, however the stretches are cut."""
import numpy as np
import pytest

from gridspark.operators.detect_state import FrozenBaseline


def plain_walk(ts, v, c, f, window, min_n, z, sustained_s):
    base, event, out = [], None, []
    for i in range(len(ts)):
        score = None
        if len(base) >= max(2, min_n):
            zs = []
            for x, past in ((v[i], [b[0] for b in base]), (c[i], [b[1] for b in base])):
                sigma = np.std(past)
                zs.append(abs((x - np.mean(past)) / (sigma if sigma else 1e-6)))
            if any(s >= z for s in zs):
                score = np.nanmax(zs)
        if score is not None and event is None:
            event = [ts[i], score, f[i]]
            out.append((i, None, *event))
        elif score is not None:
            event[1] = max(event[1], score)
            if ts[i] - event[0] >= sustained_s * 1e6:
                out.append((i, "sustained", *event))
        else:
            if event is not None:
                out.append((i, "sustained" if ts[i] - event[0] >= sustained_s * 1e6 else "transient", *event))
                event = None
            base = (base + [(v[i], c[i])])[-window:]
    return out


def rows(e, shift=0):
    return [(int(r.idx) + shift, r.fault_type, int(r.start_us), float(r.peak_z), r.feeder_id) for r in e.itertuples()]


def same(a, b):
    assert [(x[0], x[1], x[2], x[4]) for x in a] == [(x[0], x[1], x[2], x[4]) for x in b]
    assert np.allclose([x[3] for x in a], [x[3] for x in b], rtol=1e-9)


@pytest.mark.parametrize("trial", range(6))
def test_stretches_equal_the_plain_walk(trial):
    rng = np.random.default_rng(trial)
    n = 3000
    v, c = 100 + rng.normal(0, 2, n), 40 + rng.normal(0, 1.2, n)
    for s0 in rng.integers(0, n - 50, 40):
        v[s0:s0 + int(rng.integers(1, 40))] *= 0.5
    if trial % 2:
        v[rng.integers(0, n, 10)] = np.nan
        c[rng.integers(0, n, 10)] = np.nan
    if trial == 4:
        v[:] = np.round(v, -2)
        c[:] = 40.0
    ts = np.cumsum(rng.integers(0, 3, n)).astype(np.int64) * 1_000_000
    f = np.array([f"f{x % 3}" for x in range(n)], dtype=object)
    z = 3.0 if trial % 3 == 0 else 6.0
    window, min_n = [(30, 10), (5, 3), (30, 10), (10, 20), (30, 1), (7, 7)][trial]
    whole = FrozenBaseline(window, min_n, z, z, 5.0)
    found = rows(whole.run(ts, v, c, f))
    want = plain_walk(ts, v, c, f, window, min_n, z, 5.0)
    same(found, want)
    assert (len(want) > 0) == (min_n <= window)
    m, split, a = FrozenBaseline(window, min_n, z, z, 5.0), [], 0
    for b in sorted(rng.integers(0, n, 30).tolist()) + [n]:
        split += rows(m.run(ts[a:b], v[a:b], c[a:b], f[a:b]), a)
        a = b
    assert split == found and str(m.get_state()) == str(whole.get_state())  # to the bit
