"""Frames and group statistics as columns. Entity windows order by date; frames count rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .expr import col, div

ENTITY, DATE = "entity", "date"


def series(entity: str | list[str] = ENTITY, date: str = DATE) -> WindowSpec:
    return Window.partitionBy(*([entity] if isinstance(entity, str) else entity)).orderBy(date)


def last_rows(n: int, over: WindowSpec | None = None) -> WindowSpec:
    return (over or series()).rowsBetween(1 - n, 0)


AGGREGATES: dict[str, Callable[[Column], Column]] = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count, "std": F.stddev_samp, "var": F.var_samp, "median": lambda c: F.percentile(c, F.lit(0.5))}


def rolling(c: Column | str, n: int, agg: str, min_periods: int | None = None, over: WindowSpec | None = None) -> Column:
    """Aggregate of the last n rows, with at least min_periods (default n) values."""
    w = last_rows(n, over)
    value = F.when(F.count(col(c)).over(w) >= (n if min_periods is None else min_periods), AGGREGATES[agg](col(c)).over(w))
    return value.cast("double")


def moments(x: Column, y: Column, w: WindowSpec) -> dict[str, Column]:
    """n, means and centred sums over rows of w where both are present."""
    ok = x.isNotNull() & y.isNotNull()
    a, b = F.when(ok, x), F.when(ok, y)
    n = F.count(a).over(w)
    pop = lambda u, v: F.covar_pop(u, v).over(w) * n
    return {"n": n, "mx": F.avg(a).over(w), "my": F.avg(b).over(w), "xx": F.var_pop(a).over(w) * n, "yy": F.var_pop(b).over(w) * n, "xy": pop(a, b)}


def pearson(m: dict[str, Column], least: int = 2) -> Column:
    return F.when((m["n"] >= least) & (m["xx"] > 0) & (m["yy"] > 0), m["xy"] / F.sqrt(m["xx"] * m["yy"]))


def rank(c: Column | str, groups: list[str], ascending: bool = True, method: str = "average", pct: bool = False, tie: list[str] | None = None) -> Column:
    """Rank within groups; missing values get none and don't count."""
    x = col(c)
    ok = x.isNotNull()
    key = x.asc_nulls_last() if ascending else x.desc_nulls_last()
    w = Window.partitionBy(*groups).orderBy(key)
    same = F.count(F.lit(1)).over(Window.partitionBy(*groups, x))
    at = {
        "min": lambda: F.rank().over(w),
        "dense": lambda: F.dense_rank().over(w),
        "max": lambda: F.rank().over(w) + same - 1,
        "average": lambda: F.rank().over(w) + (same - 1) / 2,
        "first": lambda: F.row_number().over(Window.partitionBy(*groups).orderBy(key, *(tie or []))),
    }[method]()
    if pct:
        most = F.size(F.collect_set(x).over(Window.partitionBy(*groups))) if method == "dense" else F.count(x).over(Window.partitionBy(*groups))
        at = at / most
    return F.when(ok, at.cast("double"))


def bins(c: Column | str, groups: list[str], n: int, **how) -> Column:
    """min(floor(pct * n) + 1, n): not of equal counts."""
    pct = rank(c, groups, pct=True, **how)
    return F.when(pct.isNotNull(), F.least(F.floor(pct * n) + 1, F.lit(n))).cast("long")


def zscore(c: Column | str, groups: list[str], ddof: int = 1) -> Column:
    w = Window.partitionBy(*groups)
    x = col(c)
    return div(x - F.avg(x).over(w), (F.stddev_samp if ddof else F.stddev_pop)(x).over(w))


__all__ = ["AGGREGATES", "DATE", "ENTITY", "bins", "last_rows", "moments", "pearson", "rank", "rolling", "series", "zscore"]
