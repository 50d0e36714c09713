"""Small seeded telemetry: one reading a second per device, plain noise."""
from __future__ import annotations

from datetime import datetime, timezone

import numpy as np
import pandas as pd

from gridspark import schemas as S


def telemetry_pdf(n_devices: int, n_feeders: int, seconds: int, t0: float, seed: int) -> pd.DataFrame:
    """White noise around a level of each device's own; rows by second, then device."""
    rng = np.random.default_rng(seed)
    second, device = (x.ravel() for x in np.meshgrid(np.arange(seconds), np.arange(n_devices), indexing="ij"))
    level = 20.0 + 5.0 * np.arange(n_devices)
    noise = rng.standard_normal((3, len(second)))
    return pd.DataFrame({
        "reading_id": [f"r_{d:04d}_{k:06d}" for k, d in zip(second, device)],
        "device_id": [f"dev_{d:04d}" for d in device],
        "feeder_id": [f"feeder_{d % n_feeders:03d}" for d in device],
        "ts": [datetime.fromtimestamp(t0 + int(k), tz=timezone.utc).replace(tzinfo=None) for k in second],
        "voltage": 1000.0 + 5.0 * noise[0], "current": level[device] + 0.5 * noise[1],
        "frequency": 50.0 + 0.01 * noise[2], "source": S.SYNTHETIC})[S.READINGS.names]


def telemetry(spark, n_devices=10, n_feeders=2, seconds=30, t0=100000.0, seed=1):
    return spark.createDataFrame(telemetry_pdf(n_devices, n_feeders, seconds, t0, seed), S.READINGS)


def schedule(spark, faults):
    """faults: list of (fault_id, device_id, feeder_id, fault_type, start_epoch_s, duration_s)."""
    rows = [(fid, dev, fdr, kind, datetime.fromtimestamp(st, tz=timezone.utc).replace(tzinfo=None),
             float(dur), 0.5, 3.0, 0.1) for fid, dev, fdr, kind, st, dur in faults]
    return spark.createDataFrame(pd.DataFrame(rows, columns=S.FAULT_SCHEDULE.names), S.FAULT_SCHEDULE)
