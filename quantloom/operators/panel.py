"""Panel operators over one entity window, and the library of daily price/volume factors built on them.

All factors come out of one select: one scan, one exchange by entity, one sort per frame width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.expr import col, div, greater, less, ln
from ..functions.windows import ENTITY, last_rows, moments, pearson, series
from ..shipping import ship
from .sliding import BARS, Slide

EPS = 1e-12
WINDOWS = (5, 10, 20, 30, 60)
#: Names, in the order of `candle_factors` and `window_factors`.
CANDLES = ("kmid", "klen", "kmid2", "kup", "kup2", "klow", "klow2", "ksft", "ksft2", "open0", "high0", "low0", "vwap0")
FAMILIES = ("roc", "ma", "std", "beta", "rsqr", "resi", "max", "min", "qtlu", "qtld", "rank", "rsv", "imax", "imin", "imxd", "corr", "cord", "cntp", "cntn", "cntd", "sump", "sumn", "sumd", "vma", "vstd", "wvma", "vsump", "vsumn", "vsumd")


def ref(c: Column | str, n: int) -> Column:
    return F.lag(col(c), n).over(series())


def _frame(agg, n: int) -> Column:
    return agg.over(last_rows(n)).cast("double")


def mean(c: Column | str, n: int) -> Column:
    return _frame(F.avg(col(c)), n)


def std(c: Column | str, n: int) -> Column:
    return _frame(F.stddev_samp(col(c)), n)


def total(c: Column | str, n: int) -> Column:
    return _frame(F.sum(col(c)), n)


def highest(c: Column | str, n: int) -> Column:
    return _frame(F.max(col(c)), n)


def lowest(c: Column | str, n: int) -> Column:
    return _frame(F.min(col(c)), n)


def quantile(c: Column | str, n: int, q: float) -> Column:
    return _frame(F.percentile(col(c), F.lit(q)), n)


def _line(c: Column | str, n: int) -> dict[str, Column]:
    """Regression on the row's place in a full window without gaps."""
    x = F.row_number().over(series()).cast("double")
    m = moments(x, col(c), last_rows(n))
    return m | {"full": m["n"] == n}


def slope(c: Column | str, n: int, place: str = "_place") -> Column:
    w, y = last_rows(n), col(c)
    return F.when(F.count(y).over(w) == n, F.regr_slope(y, F.col(place)).over(w))


def rsquare(c: Column | str, n: int, place: str = "_place") -> Column:
    w, y, x = last_rows(n), col(c), F.col(place)
    cov, vx, vy = F.covar_pop(x, y).over(w), F.var_pop(x).over(w), F.var_pop(y).over(w)
    return F.when((F.count(y).over(w) == n) & (vx * vy * n * n > EPS), cov * cov / (vx * vy))


def residual(c: Column | str, n: int, place: str = "_place") -> Column:
    y = col(c)
    return y - mean(y, n) - slope(y, n, place) * ((n - 1) / 2)


def ts_rank(c: Column | str, n: int) -> Column:
    """Share of the window's earlier values below the current one; one half with fewer than two values."""
    w, x = last_rows(n), col(c)
    valid = F.count(x).over(w)
    below = F.size(F.filter(F.collect_list(x).over(w), lambda a: a < x))
    value = F.when(valid < 2, F.lit(0.5)).otherwise(below / (valid - 1))
    return F.when(x.isNotNull() & (F.count(F.lit(1)).over(w) == n), value)


def _place_of(c: Column | str, n: int, sign: int, place: str) -> Column:
    """1-based place from the window's start of the first extreme value."""
    w, x = last_rows(n), col(c)
    best = F.max(F.when(x.isNotNull(), F.struct((sign * x).alias("v"), (-F.col(place)).alias("p")))).over(w)
    start = F.col(place) - F.least(F.col(place) - 1, F.lit(n - 1))
    return (-best["p"] - start + 1).cast("double")


def idx_max(c: Column | str, n: int, place: str = "_place") -> Column:
    return _place_of(c, n, 1, place)


def idx_min(c: Column | str, n: int, place: str = "_place") -> Column:
    return _place_of(c, n, -1, place)


def rolling_corr(a: Column | str, b: Column | str, n: int) -> Column:
    return pearson(moments(col(a), col(b), last_rows(n)), max(2, n // 2))


def rolling_cov(a: Column | str, b: Column | str, n: int) -> Column:
    m = moments(col(a), col(b), last_rows(n))
    return F.when(m["n"] >= max(2, n // 2), m["xy"] / (m["n"] - 1))


def cross_rank(c: Column | str, date: str = "date") -> Column:
    x = col(c)
    return F.when(x.isNotNull(), F.rank().over(Window.partitionBy(date).orderBy(x.asc_nulls_last())) / F.count(x).over(Window.partitionBy(date)))


def candle_factors() -> dict[str, Column]:
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    top, bottom, span = greater(o, c), less(o, c), h - lo + EPS
    return {
        "kmid": div(c - o, o), "klen": div(h - lo, o), "kmid2": div(c - o, span), "kup": div(h - top, o), "kup2": div(h - top, span),
        "klow": div(bottom - lo, o), "klow2": div(bottom - lo, span), "ksft": div(2 * c - h - lo, o), "ksft2": div(2 * c - h - lo, span),
        "open0": div(o, c), "high0": div(h, c), "low0": div(lo, c), "vwap0": div(F.coalesce(F.col("vwap"), (h + lo + c) / 3), c),
    }


def window_factors(w: int) -> dict[str, Column]:
    """The factors of one width; `_place` and the `_` columns of `prepared` must be there."""
    h, lo, c, v = (F.col(x) for x in ("high", "low", "close", "volume"))
    up, down, vup, vdown = (F.col(x) for x in ("_up", "_down", "_vup", "_vdown"))
    share = lambda part, whole: div(total(part, w), total(whole, w) + EPS)
    cntp, cntn = mean("_rose", w), mean("_fell", w)
    imax, imin = idx_max(h, w) / w, idx_min(lo, w) / w
    return {
        "roc": div(ref(c, w), c), "ma": div(mean(c, w), c), "std": div(std(c, w), c),
        "beta": div(slope(c, w), c), "rsqr": rsquare(c, w), "resi": div(residual(c, w), c),
        "max": div(highest(h, w), c), "min": div(lowest(lo, w), c),
        "qtlu": div(quantile(c, w, 0.8), c), "qtld": div(quantile(c, w, 0.2), c),
        "rank": ts_rank(c, w), "rsv": div(c - lowest(lo, w), highest(h, w) - lowest(lo, w) + EPS),
        "imax": imax, "imin": imin, "imxd": imax - imin,
        "corr": rolling_corr(c, "_lv", w), "cord": rolling_corr("_cr", "_lvr", w),
        "cntp": cntp, "cntn": cntn, "cntd": cntp - cntn,
        "sump": share(up, "_move"), "sumn": share(down, "_move"), "sumd": share(up - down, "_move"),
        "vma": div(mean(v, w), v + EPS), "vstd": div(std(v, w), v + EPS),
        "wvma": div(std("_rv", w), mean("_rv", w) + EPS),
        "vsump": share(vup, "_vmove"), "vsumn": share(vdown, "_vmove"), "vsumd": share(vup - vdown, "_vmove"),
    }


def prepared(panel: DataFrame) -> DataFrame:
    c, v = F.col("close"), F.col("volume")
    dc, dv = c - ref(c, 1), v - ref(v, 1)
    part = lambda d, sign: F.greatest(sign * d, F.lit(0.0))
    keep = lambda d, x: F.when(d.isNotNull(), x)
    ratio = div(c, ref(c, 1))
    return panel.withColumns({
        "_place": F.row_number().over(series()).cast("double"), "_up": keep(dc, part(dc, 1)), "_down": keep(dc, part(dc, -1)), "_move": F.abs(dc),
        "_vup": keep(dv, part(dv, 1)), "_vdown": keep(dv, part(dv, -1)), "_vmove": F.abs(dv),
        "_rose": F.coalesce((dc > 0).cast("double"), F.lit(0.0)), "_fell": F.coalesce((dc < 0).cast("double"), F.lit(0.0)),
        "_lv": ln(v + 1), "_cr": ratio, "_lvr": ln(div(v, ref(v, 1)) + 1), "_rv": F.abs(ratio - 1) * v,
    })


def factor_names(windows: tuple[int, ...] = WINDOWS) -> list[str]:
    """Needs no session."""
    return [*CANDLES, *(f"{n}{w}" for n in FAMILIES for w in windows)]


def all_factors(panel: DataFrame, windows: tuple[int, ...] = WINDOWS, only: list[str] | None = None, as_float: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """entity, date and the factors asked for (all 158 by default); panel: entity, date, OHLC, volume, vwap (open and vwap for candles only); `keep`: columns of it that go along.

    One exchange and one sort by entity; candles are columns, window factors one pass over the sorted series (`sliding`).
    """
    ship(panel.sparkSession)
    candles = candle_factors()
    of = {f"{n}{w}": (n, w) for w in windows for n in FAMILIES}
    names = only or [*candles, *of]
    if unknown := set(names) - candles.keys() - of.keys():
        raise ValueError(f"no factors {sorted(unknown)}")
    asked, plain = [n for n in names if n in of], [n for n in names if n in candles]
    bars = [F.col(c).cast("double").alias(c) for c in BARS]
    rows = panel.select(ENTITY, "date", *bars, F.row_number().over(series()).cast("double").alias("_place"), *(candles[n].alias(f"_{n}") for n in plain), *(F.col(c).alias(f"_{c}") for c in keep))
    schema = StructType([rows.schema[ENTITY], rows.schema["date"], *(StructField(n, DoubleType()) for n in [*asked, *plain]), *(StructField(c, rows.schema[f"_{c}"].dataType) for c in keep)])
    # The window's order is the sort's: no second one.
    made = rows.sortWithinPartitions(ENTITY, "date").mapInArrow(Slide(2, [of[n] for n in asked], to_arrow_schema(schema)), schema)
    kind = "float" if as_float else "double"
    return made.select(ENTITY, "date", *(F.col(n).cast(kind).alias(n) for n in names), *keep)
