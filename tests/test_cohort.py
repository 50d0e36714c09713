"""A9 cohort sample against a brute-force walk over the blocks."""
from datetime import datetime

import pandas as pd

from gridspark.operators import cohort


def _brute(pdf, n, months, max_blocks):
    out, seen = [], set()
    for b in sorted(pdf.block.unique())[:max_blocks]:
        if len(seen) >= n:
            break
        blk = pdf[pdf.block == b].copy()
        blk["_t"] = pd.to_datetime(blk.DateTime, errors="coerce")
        blk = blk.dropna(subset=["_t"])
        new = sorted(h for h in blk.LCLid.unique() if h not in seen)   # ids ranked within a block
        take = new[: max(0, n - len(seen))]
        seen.update(take)
        blk = blk[blk.LCLid.isin(take)]
        start = blk.groupby("LCLid")["_t"].transform("min")
        blk = blk[blk._t < start + pd.DateOffset(months=months)]
        out.append(blk.drop(columns="_t"))
    return pd.concat(out) if out else pdf.iloc[:0]


def test_cohort_matches_brute_force(spark):
    rows = []
    for h in range(12):
        for k in range(8):
            b = (h + k) % 5
            rows.append((f"H{h:02d}", "Std", f"2012-{1 + (k * 2) % 12:02d}-{28 + k % 3:02d} 00:00:00", "0.1", b))
    rows.append(("H99", "Std", "not a time", "0.1", 0))
    rows.append(("H01", "Std", "2011-11-30 00:00:00", "0.1", 3))  # month-end clamp: +3 months = 2012-02-29
    pdf = pd.DataFrame(rows, columns=["LCLid", "stdorToU", "DateTime", "kwh_per_half_hour", "block"])
    df = spark.createDataFrame(pdf)
    for n, months, mb in ((5, 3, 10), (20, 2, 3), (3, 12, 1), (20, 3, None)):
        got = sorted(tuple(r) for r in cohort.cohort_sample(df, n, months, mb).select(*pdf.columns).collect())
        want = sorted(tuple(x) for x in _brute(pdf, n, months, mb).itertuples(index=False))
        assert got == want


def test_month_end_clamp(spark):
    df = spark.createDataFrame([("H", "Std", "2012-11-30 00:00:00", "1", 0),
                                ("H", "Std", "2013-02-28 00:00:00", "1", 0),
                                ("H", "Std", "2013-02-27 23:59:59", "1", 0)],
                               "LCLid string, stdorToU string, DateTime string, kwh_per_half_hour string, block int")
    got = sorted(r.DateTime for r in cohort.cohort_sample(df, 1, 3, 1).collect())
    assert got == ["2012-11-30 00:00:00", "2013-02-27 23:59:59"]
    assert datetime(2013, 2, 28)  # clamp boundary is excluded


def test_rows_without_a_block_take_no_slot(spark):
    rows = [("A", "2012-01-01 00:00:00", None), ("B", "2012-01-01 00:00:00", 1), ("C", "2012-01-01 00:00:00", 2), (None, "2012-01-01 00:00:00", 1)]
    df = spark.createDataFrame(rows, "LCLid string, DateTime string, block int")
    assert sorted(r.LCLid for r in cohort.cohort_sample(df, max_blocks=2).collect()) == ["B", "C"]
    assert sorted(r.LCLid for r in cohort.cohort_sample(df).collect()) == ["B", "C"]
