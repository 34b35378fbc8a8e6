"""The factors of sliding windows in one pass over each entity's series.

Rows arrive as Arrow batches, sorted by entity and date, with each row's place in its series. A block of rows sees
its windows as rows of a matrix (a view of the series, oldest value first; what lies before the series' start is missing), and every factor is
a reduction of it: sums and centred moments for means, deviations, slopes and correlations, one sort of a window for both quantiles, one
comparison for ranks and places. The rows behind a block are carried to the next, so memory is a block's, whatever the series'
length. Spark's own frames evaluate each frame of each aggregate anew, and collect a list for each rank.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view

EPS = 1e-12
BARS = ("high", "low", "close", "volume")
BLOCK = 4096


def div(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.full(np.broadcast(a, b).shape, np.nan), where=(b != 0) & ~np.isnan(b))


def ln(x: np.ndarray) -> np.ndarray:
    return np.log(x, out=np.full(x.shape, np.nan), where=x > 0)


@dataclass
class Frame:
    """All windows of one width over one series; missing values are NaN and don't count."""

    x: np.ndarray
    place: np.ndarray
    w: int

    @cached_property
    def m(self) -> np.ndarray:
        views = sliding_window_view(np.concatenate([np.full(self.w - 1, np.nan), self.x]), self.w)
        return np.where(np.arange(self.w)[::-1] < self.place[:, None], views, np.nan)

    @cached_property
    def ok(self) -> np.ndarray:
        return ~np.isnan(self.m)

    @cached_property
    def n(self) -> np.ndarray:
        return self.ok.sum(1)

    @cached_property
    def whole(self) -> bool:
        """No window lacks a value: nothing to mask."""
        return bool(self.ok.all())

    @cached_property
    def total(self) -> np.ndarray:
        return np.where(self.n > 0, (self.m if self.whole else np.where(self.ok, self.m, 0.0)).sum(1), np.nan)

    @cached_property
    def mean(self) -> np.ndarray:
        return div(self.total, self.n)

    @cached_property
    def high(self) -> np.ndarray:
        best = np.where(self.ok, self.m, -np.inf).max(1)
        return np.where(self.n > 0, best, np.nan)

    @cached_property
    def low(self) -> np.ndarray:
        best = np.where(self.ok, self.m, np.inf).min(1)
        return np.where(self.n > 0, best, np.nan)

    @cached_property
    def centred(self) -> np.ndarray:
        return np.where(self.ok, self.m - self.mean[:, None], 0.0)

    @cached_property
    def squares(self) -> np.ndarray:
        """Centred sum of squares; 0 for a flat window, not its rounding."""
        return np.where(self.high == self.low, 0.0, (self.centred**2).sum(1))

    @cached_property
    def std(self) -> np.ndarray:
        return np.sqrt(np.where(self.n > 1, div(self.squares, self.n - 1.0), np.nan))

    @cached_property
    def ordered(self) -> np.ndarray:
        return np.sort(self.m, 1)  # missing ones last

    def quantile(self, q: float) -> np.ndarray:
        at = np.maximum(self.n - 1, 0) * q
        a, b = np.floor(at).astype(int), np.ceil(at).astype(int)
        rows = np.arange(len(self.x))
        lo, hi = self.ordered[rows, a], self.ordered[rows, b]
        return np.where(self.n > 0, lo + (hi - lo) * (at - a), np.nan)

    @cached_property
    def along(self) -> tuple[np.ndarray, np.ndarray]:
        """Sum of products with the place in the window, centred; only full windows without gaps have one."""
        t = np.arange(self.w) - (self.w - 1) / 2
        xy = np.where(self.n == self.w, (self.centred * t).sum(1), np.nan)
        return xy, np.full(len(self.x), (t * t).sum())

    @cached_property
    def slope(self) -> np.ndarray:
        xy, xx = self.along
        return div(xy, xx)

    @cached_property
    def rsquare(self) -> np.ndarray:
        xy, xx = self.along
        return np.where(xx * self.squares > EPS, div(xy * xy, xx * self.squares), np.nan)

    @cached_property
    def residual(self) -> np.ndarray:
        return self.x - self.mean - self.slope * ((self.w - 1) / 2)

    @cached_property
    def rank(self) -> np.ndarray:
        below = (self.m < self.x[:, None]).sum(1)
        share = np.where(self.n < 2, 0.5, div(below, self.n - 1.0))
        return np.where(~np.isnan(self.x) & (self.place >= self.w), share, np.nan)

    def first(self, of: np.ndarray) -> np.ndarray:
        """1-based place of a value's first occurrence, from the window's first row."""
        at = (self.m == of[:, None]).argmax(1) - np.maximum(self.w - self.place, 0) + 1.0
        return np.where(self.n > 0, at, np.nan)

    @cached_property
    def first_high(self) -> np.ndarray:
        return self.first(self.high)

    @cached_property
    def first_low(self) -> np.ndarray:
        return self.first(self.low)

    def corr(self, other: Frame) -> np.ndarray:
        gone = ~(self.ok & other.ok)
        a, b = (Pair(np.where(gone, np.nan, f.m)) for f in (self, other))
        ok = (a.n >= max(2, self.w // 2)) & (a.squares > 0) & (b.squares > 0)
        return np.where(ok, div((a.centred * b.centred).sum(1), np.sqrt(a.squares * b.squares)), np.nan)


class Pair(Frame):
    """A frame of which the matrix is given."""

    def __init__(self, m: np.ndarray):
        self.__dict__["m"] = m


class Block:
    """Series of a block of rows, and their frames by width, made when a factor asks for them."""

    def __init__(self, bars: dict[str, np.ndarray], place: np.ndarray):
        self.place, self.series = place, dict(bars)
        c, v = bars["close"], bars["volume"]
        dc, dv = c - self.back(c, 1), v - self.back(v, 1)
        ratio = div(c, self.back(c, 1))
        self.series |= {
            "up": np.maximum(dc, 0), "down": np.maximum(-dc, 0), "net": np.maximum(dc, 0) - np.maximum(-dc, 0), "move": np.abs(dc),
            "vup": np.maximum(dv, 0), "vdown": np.maximum(-dv, 0), "vnet": np.maximum(dv, 0) - np.maximum(-dv, 0), "vmove": np.abs(dv),
            "rose": (dc > 0).astype(float), "fell": (dc < 0).astype(float),
            "lv": ln(v + 1), "cr": ratio, "lvr": ln(div(v, self.back(v, 1)) + 1), "rv": np.abs(ratio - 1) * v,
        }
        self.frames: dict[tuple[str, int], Frame] = {}

    def back(self, x: np.ndarray, n: int) -> np.ndarray:
        moved = np.concatenate([np.full(min(n, len(x)), np.nan), x[: max(len(x) - n, 0)]])
        return np.where(self.place > n, moved, np.nan)

    def frame(self, name: str, w: int) -> Frame:
        if (name, w) not in self.frames:
            self.frames[name, w] = Frame(self.series[name], self.place, w)
        return self.frames[name, w]

    def factor(self, family: str, w: int) -> np.ndarray:
        f = lambda name: self.frame(name, w)
        c, v = self.series["close"], self.series["volume"]
        share = lambda part, whole: div(f(part).total, f(whole).total + EPS)
        imax, imin = (lambda: f("high").first_high / w), (lambda: f("low").first_low / w)
        made: dict[str, Callable[[], np.ndarray]] = {
            "roc": lambda: div(self.back(c, w), c), "ma": lambda: div(f("close").mean, c), "std": lambda: div(f("close").std, c),
            "beta": lambda: div(f("close").slope, c), "rsqr": lambda: f("close").rsquare, "resi": lambda: div(f("close").residual, c),
            "max": lambda: div(f("high").high, c), "min": lambda: div(f("low").low, c),
            "qtlu": lambda: div(f("close").quantile(0.8), c), "qtld": lambda: div(f("close").quantile(0.2), c),
            "rank": lambda: f("close").rank, "rsv": lambda: div(c - f("low").low, f("high").high - f("low").low + EPS),
            "imax": imax, "imin": imin, "imxd": lambda: imax() - imin(),
            "corr": lambda: f("close").corr(f("lv")), "cord": lambda: f("cr").corr(f("lvr")),
            "cntp": lambda: f("rose").mean, "cntn": lambda: f("fell").mean, "cntd": lambda: f("rose").mean - f("fell").mean,
            "sump": lambda: share("up", "move"), "sumn": lambda: share("down", "move"), "sumd": lambda: share("net", "move"),
            "vma": lambda: div(f("volume").mean, v + EPS), "vstd": lambda: div(f("volume").std, v + EPS),
            "wvma": lambda: div(f("rv").std, f("rv").mean + EPS),
            "vsump": lambda: share("vup", "vmove"), "vsumn": lambda: share("vdown", "vmove"), "vsumd": lambda: share("vnet", "vmove"),
        }
        return made[family]()


@dataclass
class Slide:
    """Of (keys, bars, place, other columns): keys, the window factors asked for, and the other columns as they are."""

    keys: int
    asked: list[tuple[str, int]]
    schema: pa.Schema

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach, tail = max((w for _, w in self.asked), default=1), None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                b = batch.slice(at, BLOCK)
                rows = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns[self.keys : self.keys + len(BARS) + 1]])
                rows = rows if tail is None else np.concatenate([tail, rows], 1)
                tail = rows[:, -reach:]
                block = Block(dict(zip(BARS, rows, strict=False)), rows[-1])
                # By width, so that one width's matrices are held at a time.
                made: dict[tuple[str, int], np.ndarray] = {}
                for w in sorted({w for _, w in self.asked}):
                    made |= {(f, w): block.factor(f, w)[-b.num_rows :] for f, x in self.asked if x == w}
                    block.frames.clear()
                columns = [*b.columns[: self.keys], *(pa.array(made[x], from_pandas=True) for x in self.asked), *b.columns[self.keys + len(BARS) + 1 :]]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
