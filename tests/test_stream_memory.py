"""The streaming detector unpacks a device's readings a stretch at a time."""
import numpy as np
import pandas as pd
import pytest

from gridspark.operators.detect_state import FrozenBaseline
from gridspark.streaming import detect as SD

PARAMS = dict(window=20, min_n=5, vth=4.0, cth=4.0, sustained_s=30.0)


class Cell:
    """A value or list state, and the handle and timer values that go with it."""

    def __init__(self):
        self.value, self.rows, self.timers, self.now = None, [], [], 0

    def exists(self):
        return self.value is not None or bool(self.rows)

    def get(self):
        return self.value if self.value is not None else iter(self.rows)

    def update(self, value):
        self.value = value

    def appendValue(self, row):
        self.rows.append(row)

    def put(self, rows):
        self.rows = rows

    def clear(self):
        self.value, self.rows = None, []

    def registerTimer(self, at):
        self.timers.append(at)

    def getCurrentWatermarkInMs(self):
        return self.now


def readings(n=4000, seed=3):
    rng = np.random.default_rng(seed)
    v = 100 + rng.normal(0, 1, n)
    v[rng.integers(0, n, 60)] += 50
    v[1000:1090] += 80
    ts = np.sort(rng.integers(0, n // 2, n)) * 1_000_000  # some readings share a time
    return pd.DataFrame({"ts_us": ts, "reading_id": [f"r{i:05d}" for i in range(n)], "feeder_id": [None if i % 9 == 0 else f"f{i % 2}" for i in range(n)],
                         "voltage": v, "current": 10 + rng.normal(0, 0.1, n)})


def whole(pdf):
    pdf = pdf.sort_values(["ts_us", "reading_id"])
    t, rid = pdf["ts_us"].to_numpy(), pdf["reading_id"].to_numpy()
    e = FrozenBaseline(**PARAMS).run(t, pdf["voltage"].to_numpy(), pdf["current"].to_numpy(), pdf["feeder_id"].to_numpy())
    return [(rid[i], k, s, p, f) for i, k, s, p, f in zip(e["idx"], e["fault_type"], e["start_us"], e["peak_z"], e["feeder_id"])]


def rows(found):
    return [tuple(r) for f in found if f["fault_type"].iat[0] != SD.LATE for r in f[["reading_id", "fault_type", "start_us", "peak_z", "feeder_id"]].itertuples(index=False)]


@pytest.fixture
def longest(monkeypatch):
    """Small stretches, and the readings given to the walk at once."""
    for name, value in (("RUN_ROWS", 500), ("BATCH_ROWS", 40), ("PART_ROWS", 200)):
        monkeypatch.setattr(SD, name, value, raising=False)
    sizes, run = [], FrozenBaseline.run
    monkeypatch.setattr(FrozenBaseline, "run", lambda self, ts, *rest: sizes.append(len(ts)) or run(self, ts, *rest))
    return sizes


def test_a_batch_is_walked_in_stretches(longest):
    pdf = readings()
    want = whole(pdf)
    longest.clear()
    mixed = pdf.sample(frac=1, random_state=1)
    p = SD.FrozenBaselineProcessor(PARAMS)
    p.state = Cell()
    first = mixed[mixed["ts_us"] <= pdf["ts_us"].iat[2500]]
    second = mixed[mixed["ts_us"] > pdf["ts_us"].iat[2500]]
    late = first.iloc[:7]  # come again, behind the last position
    got = rows(p.handleInputRows(("d",), iter(np.array_split(first, 9)), None))
    more = list(p.handleInputRows(("d",), iter([*np.array_split(second, 5), late]), None))
    assert len(want) > 60 and got + rows(more) == want
    assert [int(f["ts_us"].iat[0]) for f in more if f["fault_type"].iat[0] == SD.LATE] == [7]
    assert max(longest) <= 1000 and sum(longest) == len(pdf)


def test_waiting_readings_are_walked_in_stretches(longest):
    pdf = readings(seed=4)
    want = whole(pdf)
    longest.clear()
    p, cell = SD.WaitingProcessor(PARAMS), Cell()
    p.handle, p.state, p.waiting = cell, Cell(), Cell()
    mixed, got = pdf.sample(frac=1, random_state=2), []
    for frame in np.array_split(mixed, 6):
        assert list(p.handleInputRows(("d",), iter(np.array_split(frame, 3)), cell)) == []
    assert cell.timers and min(cell.timers) == -(-int(pdf["ts_us"].min()) // 1000)
    for share in (0.3, 0.6, 1.0):  # what the watermark has not passed waits on
        cell.now = int(pdf["ts_us"].iat[int(share * (len(pdf) - 1))]) // 1000
        got += rows(p.handleExpiredTimer(("d",), cell, None))
        assert p.waiting.exists() == (share < 1)
    assert len(want) > 60 and got == want
    assert max(longest) <= 1000 and sum(longest) == len(pdf)
