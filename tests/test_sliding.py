"""The sliding pass: blocks of any size give what whole series give, and pandas' rolling windows agree."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from quantloom.operators import sliding
from quantloom.operators.panel import FAMILIES

WIDTHS = (5, 20)


def series(seed=0):
    """Three entities, one longer than a block, one of three rows; gaps and flat stretches."""
    r = np.random.default_rng(seed)
    frames = []
    for e, n in enumerate((sliding.BLOCK + 700, 3, 300)):
        x = pd.DataFrame({c: np.round(5 + r.random(n) * 10, 1) for c in ("open", "high", "low", "close")} | {"volume": r.integers(0, 50, n) * 1.0})
        x.loc[r.random(n) < 0.05, "close"] = np.nan
        x.loc[r.random(n) < 0.05, "volume"] = np.nan
        x.loc[n // 2 : n // 2 + 30, ["close", "volume"]] = 7.0
        frames.append(x.assign(entity=e, place=np.arange(1.0, n + 1)))
    return pd.concat(frames, ignore_index=True)


def made(x, size):
    asked = [(f, w) for w in WIDTHS for f in FAMILIES]
    schema = pa.schema([("entity", pa.int64()), *((f"{f}{w}", pa.float64()) for f, w in asked)])
    table = pa.Table.from_pandas(x[["entity", *sliding.BARS, "place"]], preserve_index=False)
    out = sliding.Slide(1, asked, schema)(iter(table.to_batches(max_chunksize=size)))
    return pa.Table.from_batches(list(out), schema).to_pandas()


@pytest.mark.parametrize("size", [1, 7, 10_000_000])
def test_blocks_and_rolling_windows(size):
    x = series() if size > 7 else series().iloc[-400:].reset_index(drop=True).query("entity < 9")
    if size <= 7:
        x = x[x["entity"] == 2].reset_index(drop=True)
    got = made(x, size)
    by = x.groupby("entity", sort=False)
    roll = lambda c, w, s=x: s.groupby("entity", sort=False)[c].rolling(w, min_periods=1)
    flat = lambda v: v.reset_index(level=0, drop=True).sort_index().to_numpy()
    c, v = x["close"].to_numpy(), x["volume"].to_numpy()
    y = x.assign(lv=np.log1p(x["volume"]), dv=by["volume"].diff())
    y["vup"], y["vmove"] = y["dv"].clip(lower=0), y["dv"].abs()
    for w in WIDTHS:
        high, low = flat(roll("high", w).max()), flat(roll("low", w).min())
        plain = {
            "ma": flat(roll("close", w).mean()) / c, "std": flat(roll("close", w).std()) / c, "max": high / c, "qtlu": flat(roll("close", w).quantile(0.8)) / c,
            "rsv": (c - low) / (high - low + 1e-12), "roc": by["close"].shift(w).to_numpy() / c, "vma": flat(roll("volume", w).mean()) / (v + 1e-12),
            "vsump": flat(roll("vup", w, y).sum()) / (flat(roll("vmove", w, y).sum()) + 1e-12),
        }
        plain["vsump"][np.isnan(flat(roll("vmove", w, y).mean()))] = np.nan
        for k, want in plain.items():
            np.testing.assert_allclose(got[f"{k}{w}"], want, rtol=1e-7, atol=1e-8, equal_nan=True, err_msg=f"{k}{w}")
        values = x["high"].to_numpy()
        for i in (0, len(x) // 2, len(x) - 1):
            own = values[max(i - w + 1, i - int(x["place"][i]) + 1) : i + 1]
            assert got[f"imax{w}"][i] == pytest.approx((own.argmax() + 1) / w)
        # flat windows correlate with nothing, and a line has no fit there
        still = len(x) - 300 + 150 + 28
        assert np.isnan(got[f"corr{w}"][still]) and np.isnan(got[f"rsqr{w}"][still]) and got[f"std{w}"][still] == 0
        a, b = (s[max(0, still + 60 - w + 1) : still + 61] for s in (c, y["lv"].to_numpy()))
        ok = ~(np.isnan(a) | np.isnan(b))
        assert got[f"corr{w}"][still + 60] == pytest.approx(np.corrcoef(a[ok], b[ok])[0, 1])
        if not np.isnan(a).any():
            assert got[f"beta{w}"][still + 60] * c[still + 60] == pytest.approx(np.polyfit(np.arange(w), a, 1)[0])
            assert got[f"rank{w}"][still + 60] == pytest.approx((a < a[-1]).sum() / (w - 1))
