"""Intraday-to-daily reducers: functions of a minute table (entity, date, minute, OHLC, volume, turnover)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import div
from .steps import keep_last

REDUCERS: dict[str, Callable[..., DataFrame]] = {}


def reducer(action: str) -> Callable:
    def register(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        REDUCERS[action] = fn
        return fn

    return register


def warm_up(action: str, params: dict) -> int:
    """Trading days before a day that its features are made of."""
    window = int(params.get("std_window", 20))
    pooled = window + int(params.get("pool") or window)
    return {"minute_intraday_aggregate": pooled, "minute_pricejump_aggregate": pooled, "minute_smartmoney": int(params.get("lookback", 10)), "minute_apm_segments": 1}.get(action, 0)


def slots_of(minutes: DataFrame, slots: list[int] | None) -> DataFrame:
    """The minutes of the day: a calendar's, or those there are."""
    return minutes.select("minute").distinct() if slots is None else minutes.sparkSession.createDataFrame([(m,) for m in slots], f"minute {minutes.schema['minute'].dataType.simpleString()}")


def dense(minutes: DataFrame, slots: list[int] | None = None) -> DataFrame:
    """Every entity's own dates by all minutes: frames count calendar rows, not trades."""
    slots = slots_of(minutes, slots)
    # One row a minute of the day: a fixed bound.
    return minutes.select("entity", "date").distinct().crossJoin(F.broadcast(slots)).join(minutes, ["entity", "date", "minute"], "left")


def day() -> Window:
    return Window.partitionBy("entity", "date").orderBy("minute")




def interval_moments(flag: Column, prefix: str) -> tuple[Column, Callable[[Column], list[Column]]]:
    """Gap in minutes to the flagged minute before, and aggregates of its first four powers."""
    before = F.last(F.when(flag, F.col("minute")), ignorenulls=True).over(day().rowsBetween(Window.unboundedPreceding, -1))
    gap = F.when(flag, F.col("minute") - before).cast("double")
    sums = lambda g: [F.count(g).cast("double").alias(f"{prefix}_interval_n"), *(F.sum(F.pow(g, F.lit(float(k)))).alias(f"{prefix}_interval_m{k}") for k in range(1, 5))]
    return gap, sums


def pooled_correlation(df: DataFrame, pool: int) -> DataFrame:
    """Over minutes of the day: correlation of the counts of peaks and of ridges in the `pool` days before."""
    past = Window.partitionBy("entity", "minute").orderBy("date").rowsBetween(-pool, -1)
    counts = df.select("entity", "date", F.sum(F.col("_peak").cast("double")).over(past).alias("p"), F.sum(F.col("_ridge").cast("double")).over(past).alias("r"))
    pooled = counts.groupBy("entity", "date").agg(F.covar_pop("p", "r").alias("_c"), F.var_pop("p").alias("_vp"), F.var_pop("r").alias("_vr"))
    return pooled.select("entity", "date", F.when((F.col("_vp") > 0) & (F.col("_vr") > 0), F.col("_c") / F.sqrt(F.col("_vp") * F.col("_vr"))).alias("peakridge_minute_corr_pooled"))


@reducer("minute_intraday_aggregate")
def peak_ridge_valley(minutes: DataFrame, std_window: int = 20, std_threshold: float = 1.0, pool: int | None = None, slots: list[int] | None = None) -> DataFrame:
    """Minutes erupt above their own recent mean; lone ones are peaks, adjoining ones ridges, the rest valleys."""
    same = Window.partitionBy("entity", "minute").orderBy("date").rowsBetween(-std_window, -1)
    v, px, to = F.col("volume"), F.col("close"), F.col("turnover")
    df = dense(keep_last(minutes, ["entity", "date", "minute"], ["turnover", "volume", "close"]), slots)
    full = F.count(v).over(same) == std_window
    df = df.withColumn("_thr", F.when(full, F.avg(v).over(same) + std_threshold * F.stddev_samp(v).over(same)))
    df = df.withColumn("_e", F.coalesce(v > F.col("_thr"), F.lit(False)))
    near = F.coalesce(F.lag("_e").over(day()), F.lit(False)) | F.coalesce(F.lead("_e").over(day()), F.lit(False))
    df = df.withColumn("_near", near)
    df = df.withColumns({"_peak": F.col("_e") & ~F.col("_near"), "_ridge": F.col("_e") & F.col("_near"), "_valley": ~F.col("_e") & v.isNotNull()})
    df = df.withColumn("_ret", div(px, F.lag(px).over(day())) - 1).withColumn("_next", F.coalesce(F.lead(to).over(day()), F.lit(0.0)))
    pgap, psums = interval_moments(F.col("_peak"), "peak")
    rgap, rsums = interval_moments(F.col("_ridge"), "ridge")
    df = df.withColumn("_pg", pgap).withColumn("_rg", rgap)
    kinds = {k: F.col(f"_{k}") for k in ("peak", "ridge", "valley")}
    aggs = [F.sum(f.cast("int")).cast("double").alias(f"{k}_count") for k, f in kinds.items()]
    aggs += [F.sum(F.when(f, v)).alias(f"{k}_volume") for k, f in kinds.items()]
    aggs += [F.sum(F.when(f, to)).alias(f"{k}_turnover") for k, f in kinds.items()]
    aggs += [div(F.sum(F.when(f, px * v)), F.sum(F.when(f, v))).alias(f"{k}_vwap") for k, f in kinds.items()]
    aggs += [F.sum(F.when(kinds["ridge"], F.col("_ret"))).alias("ridge_return_sum"), *psums(F.col("_pg")), *rsums(F.col("_rg"))]
    x, y = F.when(F.col("_e"), to), F.when(F.col("_e"), F.col("_next"))
    aggs += [F.count(x).cast("double").alias("eruption_n"), F.sum(x).alias("eruption_x"), F.sum(x * x).alias("eruption_xx"), F.sum(y).alias("eruption_y"), F.sum(y * y).alias("eruption_yy"), F.sum(x * y).alias("eruption_xy")]
    aggs += [F.max("high").alias("high"), F.min("low").alias("low"), F.max_by(px, F.when(px.isNotNull(), F.col("minute"))).alias("close"), div(F.sum(px * v), F.sum(v)).alias("vwap"), F.sum(v).alias("volume"), F.sum(to).alias("turnover")]
    daily = df.groupBy("entity", "date").agg(*aggs)
    pooled = pooled_correlation(df, pool or std_window)
    out = daily.join(pooled, ["entity", "date"], "left").withColumn("_n", F.row_number().over(Window.partitionBy("entity").orderBy("date")))
    # Without a full warm-up nothing is known.
    names = [c for c in out.columns if c not in ("entity", "date", "_n")]
    return out.select("entity", "date", *(F.when(F.col("_n") > std_window, F.col(c)).alias(c) for c in names))


@reducer("minute_pricejump_aggregate")
def price_jump(minutes: DataFrame, std_window: int = 20, std_threshold: float = 1.0, pool: int | None = None, slots: list[int] | None = None) -> DataFrame:
    """Like eruptions, of amplitude, told apart by whether neighbours are high too and whether prices gap."""
    same = Window.partitionBy("entity", "minute").orderBy("date").rowsBetween(-std_window, -1)
    df = dense(keep_last(minutes, ["entity", "date", "minute"], ["turnover", "volume", "close"]), slots)
    v, to, px = F.col("volume"), F.col("turnover"), F.col("close")
    df = df.withColumn("_a", F.when(px > 0, (F.col("high") - F.col("low")) / px))
    a = F.col("_a")
    df = df.withColumn("_thr", F.when(F.count(a).over(same) == std_window, F.avg(a).over(same) + std_threshold * F.stddev_samp(a).over(same)))
    yes = lambda c: F.coalesce(c, F.lit(False))
    df = df.withColumn("_jump", yes(a > F.col("_thr"))).withColumn("_high", yes(a >= F.col("_thr")))
    lag, lead = (lambda c: F.lag(c).over(day())), (lambda c: F.lead(c).over(day()))
    there = F.col("minute").isNotNull() & lag(F.col("minute")).isNotNull() & lead(F.col("minute")).isNotNull()
    hot, cold = yes(lag("_high")) & yes(lead("_high")), ~yes(lag("_high")) & ~yes(lead("_high"))
    gap = yes(lag("high") < lead("low")) | yes(lead("high") < lag("low"))
    df = df.withColumns({"_both": there, "_hot": hot, "_cold": cold, "_gap": gap})
    j = F.col("_jump") & F.col("_both")
    df = df.withColumns({"_peak": j & ~F.col("_hot") & ~F.col("_gap"), "_ridge": j & ~F.col("_cold") & F.col("_gap"), "_valley": ~F.col("_jump") & v.isNotNull()})
    pgap, psums = interval_moments(F.col("_peak"), "peak")
    rgap, rsums = interval_moments(F.col("_ridge"), "ridge")
    df = df.withColumn("_pg", pgap).withColumn("_rg", rgap)
    kinds = {k: F.col(f"_{k}") for k in ("peak", "ridge", "valley")}
    aggs = [F.sum(f.cast("int")).cast("double").alias(f"{k}_count") for k, f in kinds.items()]
    aggs += [F.sum(F.when(f, v)).alias(f"{k}_volume") for k, f in kinds.items()]
    aggs += [F.sum(F.when(f, to)).alias(f"{k}_turnover") for k, f in kinds.items()]
    aggs += [div(F.sum(F.when(f, px * v)), F.sum(F.when(f, v))).alias(f"{k}_vwap") for k, f in kinds.items()]
    aggs += [*psums(F.col("_pg")), *rsums(F.col("_rg")), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by(px, F.when(px.isNotNull(), F.col("minute"))).alias("close"), div(F.sum(px * v), F.sum(v)).alias("vwap"), F.sum(v).alias("volume"), F.sum(to).alias("turnover")]
    df = df.withColumn("_ret", div(px, F.lag(px).over(day())) - 1).withColumn("_next", F.coalesce(F.lead(to).over(day()), F.lit(0.0)))
    x, y = F.when(F.col("_jump"), to), F.when(F.col("_jump"), F.col("_next"))
    aggs += [F.sum(F.when(F.col("_ridge"), F.col("_ret"))).alias("ridge_return_sum"), F.sum(F.col("_jump").cast("int")).cast("double").alias("jump_count"), F.sum(x).alias("jump_x"), F.sum(x * x).alias("jump_xx"), F.sum(y).alias("jump_y"), F.sum(y * y).alias("jump_yy"), F.sum(x * y).alias("jump_xy")]
    daily = df.groupBy("entity", "date").agg(*aggs).join(pooled_correlation(df, pool or std_window), ["entity", "date"], "left")
    out = daily.withColumn("_n", F.row_number().over(Window.partitionBy("entity").orderBy("date")))
    return out.select("entity", "date", *(F.when(F.col("_n") > std_window, F.col(c)).alias(c) for c in out.columns if c not in ("entity", "date", "_n")))


def trimmed(minutes: DataFrame, drop_open: int, drop_close: int, slots: list[int] | None = None) -> DataFrame:
    """Without the first and last minutes of the day, by place among all minutes there are or the calendar's."""
    slots = slots_of(minutes, slots)
    order = Window.orderBy("minute")
    # Minutes of the day are a fixed, small set.
    slots = slots.withColumn("slot", F.row_number().over(order)).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy()))
    return minutes.join(F.broadcast(slots.where((F.col("slot") > drop_open) & (F.col("slot") <= F.col("_n") - drop_close)).drop("_n")), "minute")


@reducer("minute_tide")
def tide(minutes: DataFrame, neighbour: int = 4, drop_open: int = 4, drop_close: int = 7, min_minutes: int = 200, slots: list[int] | None = None) -> DataFrame:
    """Neighbourhood volume peaks at t; price change a minute from the low before to the low after."""
    df = trimmed(minutes, drop_open, drop_close, slots)
    df = df.withColumn("_pos", F.row_number().over(day())).withColumn("_nb", F.sum("volume").over(day().rowsBetween(-neighbour, neighbour)))
    whole = Window.partitionBy("entity", "date")
    df = df.withColumn("_n", F.count(F.lit(1)).over(whole)).withColumn("_t", -F.max(F.struct(F.col("_nb").alias("v"), (-F.col("_pos")).alias("p"))).over(whole)["p"])
    left, right = F.col("_pos") < F.col("_t"), F.col("_pos") > F.col("_t")
    low = lambda c: F.min(F.when(c, F.struct(F.col("_nb").alias("v"), F.col("_pos").alias("p"), F.col("close").alias("c"))))
    g = df.groupBy("entity", "date").agg(F.max("_n").alias("_n"), F.max("_t").alias("_t"), low(left).alias("m"), low(right).alias("n"), F.max(F.when(F.col("_pos") == F.col("_t"), F.col("close"))).alias("ct"))
    ok = (F.col("_n") >= min_minutes) & F.col("m").isNotNull() & F.col("n").isNotNull()
    per = lambda a, b, steps: div(div(b - a, a), steps)
    rise, ebb = per(F.col("m.c"), F.col("ct"), F.col("_t") - F.col("m.p")), per(F.col("ct"), F.col("n.c"), F.col("n.p") - F.col("_t"))
    strong_rise = F.col("m.v") <= F.col("n.v")
    return g.select("entity", "date", F.when(ok, per(F.col("m.c"), F.col("n.c"), F.col("n.p") - F.col("m.p"))).alias("tide_full"), F.when(ok, F.when(strong_rise, rise).otherwise(ebb)).alias("tide_strong"), F.when(ok, F.when(strong_rise, ebb).otherwise(rise)).alias("tide_weak"))


@reducer("minute_smartmoney")
def smart_money(minutes: DataFrame, beta: float = 0.1, cutoff: float = 0.2, lookback: int = 10) -> DataFrame:
    """Volume-weighted price of the smartest minutes of the last days over that of all: |R| / V^beta, best first.

    Each day is sorted once. The `lookback` days before a target are sorted runs that its window carries as arrays
    (lookback x minutes of a day, a fixed bound); the target merges them and stops at the minute in which the share is reached.
    """
    v, px = F.col("volume"), F.col("close")
    ret = div(px, F.lag(px).over(day())) - 1
    s = F.when(v > 0, F.abs(ret) / F.pow(v, F.lit(beta)))
    rows = minutes.select("entity", "date", "minute", "volume", "close", s.alias("_s"))
    # Ascending by -s, then time; a missing s comes last.
    run = F.sort_array(F.collect_list(F.struct(F.coalesce(-F.col("_s"), F.lit(float("inf"))).alias("k"), "date", "minute", v.cast("double").alias("v"), px.cast("double").alias("c"))))
    days = rows.groupBy("entity", "date").agg(run.alias("_run"))
    w = Window.partitionBy("entity").orderBy("date")
    days = days.withColumn("_runs", F.collect_list("_run").over(w.rowsBetween(1 - lookback, 0))).where(F.size("_runs") > 0)
    days = days.select("entity", "date", F.size("_runs").alias("_k"), F.array_sort(F.flatten("_runs")).alias("_m"))
    total = F.aggregate("_m", F.lit(0.0), lambda a, x: a + F.coalesce(x["v"], F.lit(0.0)))
    days = days.withColumn("_all", total)
    zero = F.struct(F.lit(0.0).alias("cum"), F.lit(0.0).alias("pv"), F.lit(0.0).alias("sv"), F.lit(0.0).alias("apv"), F.lit(0.0).alias("av"))

    def step(a: Column, x: Column) -> Column:
        there = x["v"].isNotNull() & x["c"].isNotNull()
        smart = x["v"].isNotNull() & (a["cum"] < F.col("_all") * cutoff)
        vol, money = F.coalesce(x["v"], F.lit(0.0)), F.when(there, x["v"] * x["c"]).otherwise(0.0)
        return F.struct((a["cum"] + vol).alias("cum"), (a["pv"] + F.when(smart, money).otherwise(0.0)).alias("pv"), (a["sv"] + F.when(smart, vol).otherwise(0.0)).alias("sv"), (a["apv"] + money).alias("apv"), (a["av"] + vol).alias("av"))

    sums = days.select("entity", "date", "_k", F.aggregate("_m", zero, step).alias("a"))
    enough = F.col("_k") >= lookback
    return sums.select("entity", "date", F.when(enough, div("a.pv", "a.sv")).alias("smart_vwap"), F.when(enough, div("a.apv", "a.av")).alias("all_vwap"))


@reducer("minute_dazzle")
def dazzle(minutes: DataFrame, surge_k: float = 1.0, window: int = 5, drop_open: int = 4, drop_close: int = 7, min_minutes: int = 200, slots: list[int] | None = None) -> DataFrame:
    """Mean return at minutes whose volume surges, and mean volatility of returns from there on."""
    df = trimmed(minutes, drop_open, drop_close, slots)
    df = df.withColumn("_dv", F.col("volume") - F.lag("volume").over(day())).withColumn("_r", div("close", F.lag("close").over(day())) - 1)
    whole = Window.partitionBy("entity", "date")
    df = df.withColumn("_surge", F.coalesce(F.col("_dv") > F.avg("_dv").over(whole) + surge_k * F.stddev_samp("_dv").over(whole), F.lit(False)))
    ahead = day().rowsBetween(0, window - 1)
    df = df.withColumn("_vol", F.when(F.count("_r").over(ahead) >= 2, F.stddev_samp("_r").over(ahead)))
    g = df.groupBy("entity", "date").agg(F.count(F.lit(1)).alias("_n"), F.avg(F.when(F.col("_surge"), F.col("_vol"))).alias("v"), F.avg(F.when(F.col("_surge"), F.col("_r"))).alias("r"))
    ok = F.col("_n") >= min_minutes
    return g.select("entity", "date", F.when(ok, F.col("v")).alias("dazzle_vol"), F.when(ok, F.col("r")).alias("dazzle_ret"))


#: Minutes of the day that bound the sessions.
SESSIONS = {"am": (570, 690), "pm": (780, 900), "pm_late": (840, 900)}


@reducer("minute_apm_segments")
def apm_segments(minutes: DataFrame, sessions: dict[str, tuple[int, int]] | None = None, min_bars: int = 100) -> DataFrame:
    """Returns overnight, in the morning, the afternoon and its last part."""
    s = sessions or SESSIONS
    inside = lambda n: F.col("minute").between(*s[n])
    edge = lambda agg, c, n: agg(F.col(c), F.when(inside(n) & F.col(c).isNotNull(), F.col("minute")))
    aggs = [x for n in s for x in (edge(F.min_by, "open", n).alias(f"{n}_open"), edge(F.max_by, "close", n).alias(f"{n}_close"))]
    d = minutes.groupBy("entity", "date").agg(F.count("close").alias("_n"), *aggs)
    prev = F.lag("pm_close").over(Window.partitionBy("entity").orderBy("date"))
    r = {"ret_overnight": div("am_open", prev) - 1, **{f"ret_{n}": div(f"{n}_close", f"{n}_open") - 1 for n in s}}
    return d.withColumns(r).select("entity", "date", *(F.when(F.col("_n") >= min_bars, F.col(c)).alias(c) for c in r))


_MOMENTS = [f"{k}_interval_{x}" for k in ("peak", "ridge") for x in ("n", "m1", "m2", "m3", "m4")]
_KINDS = [f"{k}_{x}" for k in ("peak", "ridge", "valley") for x in ("count", "volume_sum", "turnover_sum", "vwap")]
_DAILY = [f"daily_{x}" for x in ("high", "low", "close", "vwap", "volume", "turnover")]


def _pairs(of: str) -> dict[str, str]:
    """Names of the sums over flagged minutes (x) and those behind them (y)."""
    return {f"{of}_turnover_sum": f"{of}_x", f"{of}_turnover_sumsq": f"{of}_xx", f"{of}_next_turnover_sum": f"{of}_y", f"{of}_next_turnover_sumsq": f"{of}_yy", f"{of}_xy_sum": f"{of}_xy"}


#: Names that specifications use, where a reducer's own are shorter.
NAMES: dict[str, dict[str, str]] = {
    "minute_intraday_aggregate": {"eruption_count": "eruption_n", **_pairs("eruption")},
    "minute_pricejump_aggregate": _pairs("jump"),
    "minute_tide": {"full_tide_rate": "tide_full", "strong_halftide_rate": "tide_strong", "weak_halftide_rate": "tide_weak"},
}
for _action in ("minute_intraday_aggregate", "minute_pricejump_aggregate"):
    NAMES[_action] |= {n: n.removesuffix("_sum") for n in _KINDS if n.endswith("_sum")} | {n: n.removeprefix("daily_") for n in _DAILY}

#: What a specification may ask each reducer for.
FEATURES: dict[str, list[str]] = {
    "minute_intraday_aggregate": [*_KINDS, *_MOMENTS, *_DAILY, "ridge_return_sum", "eruption_count", *_pairs("eruption"), "peakridge_minute_corr_pooled"],
    "minute_pricejump_aggregate": [*_KINDS, *_MOMENTS, *_DAILY, "ridge_return_sum", "jump_count", *_pairs("jump"), "peakridge_minute_corr_pooled"],
    "minute_tide": list(NAMES["minute_tide"]),
    "minute_smartmoney": ["smart_vwap", "all_vwap"],
    "minute_dazzle": ["dazzle_vol", "dazzle_ret"],
    "minute_apm_segments": ["ret_overnight", *(f"ret_{n}" for n in SESSIONS)],
}


def missing_features(action: str, features: list[str]) -> list[str]:
    return sorted(set(features) - set(FEATURES[action]) - set(NAMES.get(action, {}).values()))


def reduce_minutes(minutes: DataFrame, action: str, features: list[str] | None = None, **params) -> DataFrame:
    """A reducer's columns, or those that a specification names. Sums over no minute are 0 once the warm-up is over."""
    out = REDUCERS[action](minutes, **params)
    if not features:
        return out
    if missing := missing_features(action, features):
        raise ValueError(f"{action} has no features {missing}")
    names = NAMES.get(action, {})

    def column(f: str) -> Column:
        c = F.col(names.get(f, f))
        sums = f in FEATURES[action] and (f.endswith(("_sum", "_sumsq")) or f in _MOMENTS)
        return (F.when(F.col("peak_count").isNotNull(), F.coalesce(c, F.lit(0.0))) if sums else c).alias(f)

    return out.select("entity", "date", *map(column, features))


def moment_stats(n: Column, m1: Column, m2: Column, m3: Column, m4: Column) -> dict[str, Column]:
    """Standard deviation, skewness and kurtosis from sums of powers."""
    mu = div(m1, n)
    var = div(m2, n) - mu * mu
    third = div(m3, n) - 3 * mu * div(m2, n) + 2 * mu * mu * mu
    fourth = div(m4, n) - 4 * mu * div(m3, n) + 6 * mu * mu * div(m2, n) - 3 * mu * mu * mu * mu
    ok = lambda x: F.when((n > 1) & (var > 1e-12), x)
    return {"std": ok(F.sqrt(var * n / (n - F.lit(1)))), "skew": ok(third / F.pow(var, F.lit(1.5))), "kurt": ok(fourth / (var * var))}
