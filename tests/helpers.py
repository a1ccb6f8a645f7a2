import math

import numpy as np
import pandas as pd

START = pd.Timestamp("2024-01-01")


def hours(spark, values, site="a", name="v", start=START):
    """One site's hourly rows; None is a null reading, ... is an absent row."""
    rows = [(site, (start + pd.Timedelta(hours=i)).to_pydatetime(), None if v is None else float(v))
            for i, v in enumerate(values) if v is not ...]
    return spark.createDataFrame(rows, f"site string, timestamp timestamp, {name} double")


def column(df, name="v", order=("site", "timestamp")):
    return [r[name] for r in df.orderBy(*order).collect()]


def random_series(spark, sites=3, n=400, seed=0, channels=("v",), drop=0.2, null=0.3):
    rng = np.random.default_rng(seed)
    frames = []
    for s in range(sites):
        ts = START + pd.to_timedelta(np.arange(n), unit="h")
        f = pd.DataFrame({"site": f"s{s}", "timestamp": ts})
        for c in channels:
            f[c] = np.where(rng.random(n) < null, np.nan, rng.random(n) * 300)
        keep = rng.random(n) >= drop
        keep[[0, n - 1]] = True
        frames.append(f[keep])
    pdf = pd.concat(frames, ignore_index=True)
    kinds = ", ".join(f"{c} double" for c in channels)
    rows = [(r[0], r[1].to_pydatetime(), *[None if math.isnan(x) else float(x) for x in r[2:]])
            for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, f"site string, timestamp timestamp, {kinds}"), pdf


def same(a, b, tol=1e-9):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        if x is None or y is None or (isinstance(y, float) and math.isnan(y)):
            assert x is None and (y is None or math.isnan(y)), (x, y)
        else:
            assert math.isclose(x, y, rel_tol=tol, abs_tol=tol), (x, y)
