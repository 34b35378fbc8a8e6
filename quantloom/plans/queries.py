"""Queries over the driver's tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import div
from ..operators import evaluation as ev
from ..operators import events, minute, steps
from ..operators import panel as pan
from ..sources import tables
from . import spec
from .panels import MINUTES_SQL, PANEL_SQL, minutes, panel

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, keys: str = "entity, date", doubles: str = "", ctes: str = PANEL_SQL) -> Callable[[Query], Query]:
    """Registers a query; both sides round their doubles to six places, as sums differ in order."""

    def put(fn: Query) -> Query:
        ks, ds = [x.strip() for x in keys.split(",") if x.strip()], [x.strip() for x in doubles.split(",") if x.strip()]

        def run(spark: SparkSession, d: str) -> DataFrame:
            return fn(spark, d).select(*ks, *(F.round(F.col(c).cast("double"), 6).alias(c) for c in ds))

        QUERIES[fn.__name__] = run
        if sql:
            cols = ", ".join([*ks, *(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in ds)])
            SQL[fn.__name__] = f"WITH {ctes}, result AS ({sql}) SELECT {cols} FROM result" if ctes else f"WITH result AS ({sql}) SELECT {cols} FROM result"
        return fn

    return put


def frame(n: int) -> str:
    return f"OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def exact_ic(a: str, b: str) -> str:
    """The correlation of whole numbers, from whole sums."""
    centred = lambda x, y: f"(count(*) * sum({x} * {y}) - sum({x}) * sum({y}))"
    return f"CASE WHEN {centred(a, a)} > 0 AND {centred(b, b)} > 0 THEN CAST({centred(a, b)} AS DOUBLE) / sqrt(CAST({centred(a, a)} AS DOUBLE) * CAST({centred(b, b)} AS DOUBLE)) END"


E_ = "OVER (PARTITION BY entity ORDER BY date)"
D_ = "OVER (PARTITION BY date)"


@query(
    f"""SELECT date, count(*) AS n, {exact_ic("a", "b")} AS ic FROM (
SELECT date, CASE WHEN f IS NOT NULL THEN 2 * rank() OVER (PARTITION BY date ORDER BY f NULLS LAST) + count(*) OVER (PARTITION BY date, f) - 1 END AS a, CASE WHEN r IS NOT NULL THEN 2 * rank() OVER (PARTITION BY date ORDER BY r NULLS LAST) + count(*) OVER (PARTITION BY date, r) - 1 END AS b
FROM (SELECT date, close - lag(close) {E_} AS f, lead(close, 2) {E_} / lead(close, 1) {E_} - 1 AS r FROM panel))
WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY date HAVING count(*) >= 2""",
    "date, n", "ic")
def flagship_ic(spark: SparkSession, d: str) -> DataFrame:
    """S/W3/W24/R5: a spec's factor, against the return that follows, as rank correlation by date."""
    recipe = {"factor": {"name": "momentum", "column": "f"}, "calculation_steps": [{"action": "fetch", "api": "get_factor", "fields": "close", "output_column": "close"}, {"action": "transform", "method": "diff", "source_column": "close", "output_column": "f"}]}
    bars = panel(spark, d)
    factor = spec.run(recipe, spec.Context({"daily": bars}))
    returns = ev.forward_returns(bars, [1]).select("entity", "date", "ret")
    return ev.ic_series(factor.join(returns, ["entity", "date"]), "f", "ret", ["date"])


@query(
    f"""SELECT entity, date, close - lag(close, 2) {E_} AS diff2, lead(close, 1) {E_} AS shift_back, (close - lag(close, 4) {E_}) / lag(close, 4) {E_} AS yoy, (close - lag(close) {E_}) / lag(close) {E_} AS qoq,
(close - avg(close) OVER (PARTITION BY entity)) / nullif(stddev_samp(close) OVER (PARTITION BY entity), 0) AS z, close - avg(close) {D_} AS demeaned, abs(open - close) AS absolute,
last_value(gap IGNORE NULLS) OVER (PARTITION BY entity ORDER BY date ROWS UNBOUNDED PRECEDING) AS filled, first_value(gap IGNORE NULLS) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS back_filled,
CASE WHEN quarter LIKE '%q1' THEN volume ELSE volume - lag(volume) {E_} END AS single FROM (SELECT *, CASE WHEN close > open THEN close END AS gap, concat(CAST(year(date) AS VARCHAR), 'q', CAST(quarter(date) AS VARCHAR)) AS quarter FROM panel)""",
    doubles="diff2, shift_back, yoy, qoq, z, demeaned, absolute, filled, back_filled, single")
def transforms(spark: SparkSession, d: str) -> DataFrame:
    """W3-W7, A2, A3."""
    df = panel(spark, d).withColumn("gap", F.when(F.col("close") > F.col("open"), F.col("close"))).withColumn("oc", F.col("open") - F.col("close"))
    df = df.withColumn("quarter", F.concat(F.year("date").cast("string"), F.lit("q"), F.quarter("date").cast("string")))
    for method, source, out, more in (("diff", "close", "diff2", {"periods": 2}), ("shift", "close", "shift_back", {"periods": -1}), ("yoy", "close", "yoy", {}), ("qoq", "close", "qoq", {}), ("zscore", "close", "z", {"group_by": "entity"}), ("cs_demean", "close", "demeaned", {}), ("abs", "oc", "absolute", {}), ("ffill", "gap", "filled", {}), ("bfill", "gap", "back_filled", {}), ("diff_quarterly", "volume", "single", {})):
        df = steps.transform(df, method, source, out, **more)
    return df


@query(
    f"""SELECT entity, date, CASE WHEN mad > 0 THEN greatest(least(close, med + 1.0 * mad), med - 1.0 * mad) ELSE close END AS clipped, (close - avg(close) {D_}) / nullif(stddev_pop(close) {D_}, 0) AS z FROM (
SELECT *, 1.4826 * quantile_cont(abs(close - med), 0.5) {D_} AS mad FROM (SELECT *, quantile_cont(close, 0.5) {D_} AS med FROM panel))""",
    doubles="clipped, z")
def winsorize_zscore(spark: SparkSession, d: str) -> DataFrame:
    """A4, A5."""
    df = steps.winsorize(panel(spark, d), "close", "clipped", ["date"], 1.0)
    return df.withColumn("z", ev.zscore("close", ["date"], 0))


@query(
    """SELECT entity, date, CASE WHEN x IS NOT NULL THEN r + (t - 1) / 2.0 END AS r_average, CASE WHEN x IS NOT NULL THEN r END AS r_min, CASE WHEN x IS NOT NULL THEN r + t - 1 END AS r_max, CASE WHEN x IS NOT NULL THEN dr END AS r_dense, CASE WHEN x IS NOT NULL THEN rn END AS r_first, CASE WHEN x IS NOT NULL THEN (r + (t - 1) / 2.0) / n END AS pct,
CASE WHEN x IS NOT NULL THEN least(floor((r + (t - 1) / 2.0) / n * 5) + 1, 5) END AS bin FROM (SELECT *, rank() OVER (PARTITION BY date ORDER BY x NULLS LAST) AS r, dense_rank() OVER (PARTITION BY date ORDER BY x NULLS LAST) AS dr, row_number() OVER (PARTITION BY date ORDER BY x NULLS LAST, entity) AS rn, count(*) OVER (PARTITION BY date, x) AS t, count(x) OVER (PARTITION BY date) AS n FROM (SELECT entity, date, CASE WHEN volume > 60 THEN floor(volume / 25) END AS x FROM panel))""",
    doubles="r_average, r_min, r_max, r_dense, r_first, pct, bin")
def rank_methods(spark: SparkSession, d: str) -> DataFrame:
    """W8, W9."""
    df = panel(spark, d).withColumn("x", F.when(F.col("volume") > 60, F.floor(F.col("volume") / 25).cast("double")))
    for m in ("average", "min", "max", "dense", "first"):
        df = steps.rank_step(df, "x", f"r_{m}", ["date"], rank_method=m)
    df = steps.rank_step(df, "x", "pct", ["date"], pct=True)
    return steps.rank_step(df, "x", "bin", ["date"], n_bins=5)


@query(
    "SELECT entity, date, " + ", ".join(f"CASE WHEN count(x) {frame(6)} >= 4 THEN {f}(x{', 0.5' if f == 'quantile_cont' else ''}) {frame(6)} END AS {n}" for n, f in (("mean", "avg"), ("std", "stddev_samp"), ("total", "sum"), ("lowest", "min"), ("highest", "max"), ("median", "quantile_cont"), ("present", "count"))) + " FROM (SELECT entity, date, CASE WHEN volume > 100 THEN close END AS x FROM panel)",
    doubles="mean, std, total, lowest, highest, median, present")
def rolling_frames(spark: SparkSession, d: str) -> DataFrame:
    """W1."""
    df = panel(spark, d).withColumn("x", F.when(F.col("volume") > 100, F.col("close")))
    for out, agg in (("mean", "mean"), ("std", "std"), ("total", "sum"), ("lowest", "min"), ("highest", "max"), ("median", "median"), ("present", "count")):
        df = steps.rolling_step(df, "x", out, 6, 4, agg)
    return df


@query(
    """SELECT entity, date, last_value(v IGNORE NULLS) OVER (PARTITION BY entity ORDER BY date ROWS UNBOUNDED PRECEDING) AS x FROM (
SELECT *, CASE WHEN s AND count(close) OVER w >= 2 THEN min(close) OVER w END AS v FROM (SELECT *, (c IS DISTINCT FROM lag(c) OVER (PARTITION BY entity ORDER BY date) OR row_number() OVER (PARTITION BY entity ORDER BY date) = 1) AS s FROM (SELECT *, year(date) AS c FROM panel))
WINDOW w AS (PARTITION BY entity, s ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))""",
    doubles="x")
def rolling_on_change(spark: SparkSession, d: str) -> DataFrame:
    """W2."""
    return steps.rolling_step(panel(spark, d).withColumn("c", F.year("date")), "close", "x", 3, 2, "min", change_on="c")


@query(
    """SELECT entity, date, CASE WHEN volume <> 0 THEN turnover / volume END AS vwap, CASE WHEN close > open THEN ln(close) END AS gated, (CASE WHEN close > open THEN 1 ELSE 0 END) * 2 + sqrt(abs(open - close)) ** 1.5 - exp(-close / 100) AS mixed FROM panel WHERE volume > 50 AND close >= 10""",
    doubles="vwap, gated, mixed")
def formulas(spark: SparkSession, d: str) -> DataFrame:
    """P1, P2, P7."""
    df = steps.filter_rows(panel(spark, d), "(volume > 50) and (close >= 10)")
    df = steps.compute(df, "turnover / volume", ["turnover", "volume"], "vwap")
    df = steps.compute(df, "log(close) / (close > open)", ["close", "open"], "gated")
    return steps.compute(df, "(close > open) * 2 + sqrt(abs(open - close)) ** 1.5 - exp(-close / 100)", ["open", "close"], "mixed")


@query(
    """SELECT p.entity, p.date, coalesce(e.f, 1.0) AS cum_factor, p.close * coalesce(e.f, 1.0) AS adjusted FROM panel p ASOF LEFT JOIN (SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS date, max(sqrt(o_totalprice)) AS f FROM orders GROUP BY 1, 2) e ON p.entity = e.entity AND p.date >= e.date""",
    doubles="cum_factor, adjusted")
def as_of_adjustment(spark: SparkSession, d: str) -> DataFrame:
    """J4, D6, S12."""
    e = tables.read(spark, d, "orders").select(F.col("o_custkey").alias("entity"), F.to_date("o_orderdate").alias("date"), F.sqrt("o_totalprice").alias("cum_factor"))
    return tables.adjusted(panel(spark, d).withColumn("adjusted", F.col("close")), e, ["adjusted"])


ORDERS_SQL = "rep AS (SELECT o_custkey % 20 AS entity, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS lead, max(sqrt(o_totalprice)) AS v FROM orders GROUP BY 1, 2, 3)"


def reports(spark: SparkSession, d: str) -> DataFrame:
    o = tables.read(spark, d, "orders")
    return o.groupBy((F.col("o_custkey") % 20).alias("entity"), F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("lead")).agg(F.max(F.sqrt("o_totalprice")).alias("v"))


@query(
    """SELECT entity, date, count(DISTINCT lead) AS leads FROM (SELECT e.entity, e.date, r.lead FROM (SELECT entity, max(date) AS date FROM rep GROUP BY entity, date_trunc('month', date)) e JOIN rep r ON r.entity = e.entity AND r.date <= e.date AND r.date > e.date - 45) GROUP BY 1, 2""",
    "entity, date, leads", ctes=ORDERS_SQL)
def trailing_leads(spark: SparkSession, d: str) -> DataFrame:
    """J7, A14, A15, C7."""
    r = reports(spark, d)
    return events.lead_counts(r.select("entity", "date").distinct(), r, 45)


@query(
    """SELECT entity, date, count(v) AS n_leads, avg(v) AS view FROM (SELECT e.entity, e.date, r.lead, arg_max(r.v, r.date) AS v FROM (SELECT DISTINCT entity, date FROM rep) e JOIN rep r ON r.entity = e.entity AND r.date <= e.date AND r.date > e.date - 60 GROUP BY 1, 2, 3) GROUP BY 1, 2 HAVING count(v) >= 3""",
    "entity, date, n_leads", "view", ORDERS_SQL)
def consensus_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """C5."""
    return events.snapshots(reports(spark, d), "v", 60, 3)


@query(keys="entity, lead, date", doubles="v, change")
def consensus_revisions(spark: SparkSession, d: str) -> DataFrame:
    """C4: each baseline depends on the one before; tested against a plain loop."""
    return events.revisions(reports(spark, d), "v", ["entity", "lead"])


@query(
    """SELECT entity, quarter, x - coalesce(max(x) OVER (PARTITION BY entity, substr(quarter, 1, 4) ORDER BY quarter ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS single FROM (SELECT entity, quarter, sum(t) OVER (PARTITION BY entity, substr(quarter, 1, 4) ORDER BY quarter) AS x FROM (SELECT entity, concat(CAST(year(date) AS VARCHAR), 'q', CAST(quarter(date) AS VARCHAR)) AS quarter, sum(volume) AS t FROM panel GROUP BY 1, 2))""",
    "entity, quarter", "single")
def single_quarters(spark: SparkSession, d: str) -> DataFrame:
    """C9, D14."""
    q = F.concat(F.year("date").cast("string"), F.lit("q"), F.quarter("date").cast("string"))
    t = panel(spark, d).groupBy("entity", q.alias("quarter")).agg(F.sum("volume").alias("t"))
    w = Window.partitionBy("entity", F.substring("quarter", 1, 4)).orderBy("quarter")
    return events.single_quarter(t.withColumn("net_profit", F.sum("t").over(w)))


@query(
    """SELECT vec_id, list_avg(e) AS mean, list_stddev_samp(e) AS std, list_min(e) AS lowest, list_max(e) AS highest, list_median(e) AS median, list_sum(e) AS total FROM (SELECT vec_id, CAST(embedding[1:8] AS DOUBLE[]) AS e FROM embeddings)""",
    "vec_id", "mean, std, lowest, highest, median, total", "")
def row_aggregates(spark: SparkSession, d: str) -> DataFrame:
    """A1."""
    df = vectors(spark, d)
    for out, agg in (("mean", "mean"), ("std", "std"), ("lowest", "min"), ("highest", "max"), ("median", "median"), ("total", "sum")):
        df = steps.row_aggregate(df, [f"e{i}" for i in range(8)], out, agg)
    return df


def vectors(spark: SparkSession, d: str) -> DataFrame:
    e = tables.read(spark, d, "embeddings")
    return e.select("vec_id", *(F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(8)))


@query(
    """SELECT vec_id, regr_slope(y, x) AS slope FROM (SELECT vec_id, unnest(CAST(embedding[1:8] AS DOUBLE[])) AS y, unnest(range(8)) AS x FROM embeddings) GROUP BY vec_id""",
    "vec_id", "slope", "")
def row_polynomials(spark: SparkSession, d: str) -> DataFrame:
    """R3, of degree one: the slope."""
    return steps.row_polyfit(vectors(spark, d), [f"e{i}" for i in range(8)], "slope", "a1", 1, zscore_y=False, zscore_x=False)


@query(
    """SELECT vec_id, corr(a, b) AS rho FROM (SELECT vec_id, unnest(CAST(embedding[1:4] AS DOUBLE[])) AS a, unnest(CAST(embedding[5:8] AS DOUBLE[])) AS b FROM embeddings) GROUP BY vec_id""",
    "vec_id", "rho", "")
def row_correlations(spark: SparkSession, d: str) -> DataFrame:
    """R4."""
    return steps.row_correlate(vectors(spark, d), [f"e{i}" for i in range(4)], [f"e{i}" for i in range(4, 8)], "rho")


@query(
    f"""SELECT entity, date, CASE WHEN count(*) {D_} >= 8 THEN close - regr_intercept(close, lv) {D_} - regr_slope(close, lv) {D_} * lv END AS residual FROM (SELECT *, ln(volume) AS lv FROM panel)""",
    doubles="residual")
def cross_section_residual(spark: SparkSession, d: str) -> DataFrame:
    """R1 with one regressor."""
    return steps.cross_section_regress(panel(spark, d).withColumn("lv", F.log("volume")), "close", ["lv"], "residual", min_samples=8)


@query(
    f"""SELECT entity, date, CASE WHEN nr = 10 AND n >= 5 AND sqrt(greatest((vd - 2 * beta * c + beta * beta * vg) * n / (n - 1), 0)) > 1e-12 THEN (md - beta * mg) / (sqrt(greatest((vd - 2 * beta * c + beta * beta * vg) * n / (n - 1), 0)) / sqrt(n)) END AS stat FROM (
SELECT entity, date, count(*) {frame(10)} AS nr, count(r1 - r2) {frame(10)} AS n, avg(r1 - r2) {frame(10)} AS md, avg(i1 - i2) {frame(10)} AS mg, var_pop(r1 - r2) {frame(10)} AS vd, var_pop(i1 - i2) {frame(10)} AS vg, covar_pop(r1 - r2, i1 - i2) {frame(10)} AS c,
(2 * count(*) {frame(10)} * sum(i1 * r1 + i2 * r2) {frame(10)} - sum(i1 + i2) {frame(10)} * sum(r1 + r2) {frame(10)}) / (2 * count(*) {frame(10)} * sum(i1 * i1 + i2 * i2) {frame(10)} - pow(sum(i1 + i2) {frame(10)}, 2)) AS beta
FROM (SELECT entity, date, ln(close / open) AS r1, ln(high / low) AS r2, avg(ln(close / open)) {D_} AS i1, avg(ln(high / low)) {D_} AS i2 FROM panel))""",
    doubles="stat")
def rolling_regression(spark: SparkSession, d: str) -> DataFrame:
    """R2, J3."""
    df = panel(spark, d).withColumn("r1", F.log(F.col("close") / F.col("open"))).withColumn("r2", F.log(F.col("high") / F.col("low")))
    w = Window.partitionBy("date")
    df = df.withColumn("i1", F.avg("r1").over(w)).withColumn("i2", F.avg("r2").over(w))
    return steps.rolling_ts_regress(df, "r1", "r2", "i1", "i2", "stat", 10)


@query(
    """SELECT entity, date, (close - open) / open AS kmid, (high - low) / open AS klen, (close - open) / (high - low + 1e-12) AS kmid2, (high - greatest(open, close)) / open AS kup, (least(open, close) - low) / open AS klow, (2 * close - high - low) / open AS ksft, open / close AS open0, high / close AS high0, low / close AS low0, coalesce(CASE WHEN volume <> 0 THEN turnover / volume END, (high + low + close) / 3) / close AS vwap0 FROM panel WHERE high > low""",
    doubles="kmid, klen, kmid2, kup, klow, ksft, open0, high0, low0, vwap0")
def candle_factors(spark: SparkSession, d: str) -> DataFrame:
    """2.14: candles and prices."""
    df = panel(spark, d).where("high > low").withColumn("vwap", div("turnover", "volume"))
    return pan.all_factors(df, (5,), ["kmid", "klen", "kmid2", "kup", "klow", "ksft", "open0", "high0", "low0", "vwap0"])


TREND = {"roc": f"lag(close, 5) {E_} / close", "ma": f"avg(close) {frame(5)} / close", "std": f"stddev_samp(close) {frame(5)} / close", "max": f"max(high) {frame(5)} / close", "min": f"min(low) {frame(5)} / close", "qtlu": f"quantile_cont(close, 0.8) {frame(5)} / close", "qtld": f"quantile_cont(close, 0.2) {frame(5)} / close", "rsv": f"(close - min(low) {frame(5)}) / (max(high) {frame(5)} - min(low) {frame(5)} + 1e-12)", "vma": f"avg(volume) {frame(5)} / (volume + 1e-12)", "vstd": f"stddev_samp(volume) {frame(5)} / (volume + 1e-12)"}


@query("SELECT entity, date, " + ", ".join(f"{v} AS {k}5" for k, v in TREND.items()) + " FROM panel", doubles=", ".join(f"{k}5" for k in TREND))
def trend_factors(spark: SparkSession, d: str) -> DataFrame:
    """W11, 2.14: levels, extremes and quantiles."""
    return pan.all_factors(panel(spark, d).withColumn("vwap", F.col("close")), (5,), [f"{k}5" for k in TREND])


@query(
    f"""SELECT entity, date, CASE WHEN n = 5 THEN s / close END AS beta5, CASE WHEN n = 5 THEN c * c / (vx * vy) END AS rsqr5, CASE WHEN n = 5 THEN (close - m - s * 2) / close END AS resi5 FROM (SELECT *, count(close) {frame(5)} AS n, avg(close) {frame(5)} AS m, regr_slope(close, x) {frame(5)} AS s, covar_pop(close, x) {frame(5)} AS c, var_pop(x) {frame(5)} AS vx, var_pop(close) {frame(5)} AS vy FROM (SELECT *, CAST(row_number() {E_} AS DOUBLE) AS x FROM panel))""",
    doubles="beta5, rsqr5, resi5")
def regression_factors(spark: SparkSession, d: str) -> DataFrame:
    """W12."""
    return pan.all_factors(panel(spark, d).withColumn("vwap", F.col("close")), (5,), ["beta5", "rsqr5", "resi5"])


@query(
    f"""SELECT entity, date, CASE WHEN len(l) = 5 THEN len(list_filter(l, lambda y: y < close)) / 4.0 END AS rank5, list_position(h, list_max(h)) / 5.0 AS imax5, list_position(w, list_min(w)) / 5.0 AS imin5, list_position(h, list_max(h)) / 5.0 - list_position(w, list_min(w)) / 5.0 AS imxd5 FROM (SELECT *, list(close) {frame(5)} AS l, list(high) {frame(5)} AS h, list(low) {frame(5)} AS w FROM panel)""",
    doubles="rank5, imax5, imin5, imxd5")
def position_factors(spark: SparkSession, d: str) -> DataFrame:
    """W13, W14."""
    return pan.all_factors(panel(spark, d).withColumn("vwap", F.col("close")), (5,), ["rank5", "imax5", "imin5", "imxd5"])


@query(
    f"""SELECT entity, date, avg(up) {frame(10)} AS cntp10, avg(dn) {frame(10)} AS cntn10, sum(greatest(dc, 0)) {frame(10)} / (sum(abs(dc)) {frame(10)} + 1e-12) AS sump10, sum(greatest(-dv, 0)) {frame(10)} / (sum(abs(dv)) {frame(10)} + 1e-12) AS vsumn10, stddev_samp(rv) {frame(10)} / (avg(rv) {frame(10)} + 1e-12) AS wvma10, CASE WHEN count(close) {frame(10)} >= 5 THEN corr(close, ln(volume + 1)) {frame(10)} END AS corr10
FROM (SELECT *, close - lag(close) {E_} AS dc, volume - lag(volume) {E_} AS dv, CASE WHEN close > lag(close) {E_} THEN 1 ELSE 0 END AS up, CASE WHEN close < lag(close) {E_} THEN 1 ELSE 0 END AS dn, abs(close / lag(close) {E_} - 1) * volume AS rv FROM panel)""",
    doubles="cntp10, cntn10, sump10, vsumn10, wvma10, corr10")
def flow_factors(spark: SparkSession, d: str) -> DataFrame:
    """W15, 2.14: counts, sums and correlations."""
    return pan.all_factors(panel(spark, d).withColumn("vwap", F.col("close")), (10,), ["cntp10", "cntn10", "sump10", "vsumn10", "wvma10", "corr10"])


@query(doubles=", ".join(pan.factor_names()))
def factor_library(spark: SparkSession, d: str) -> DataFrame:
    """K3: all 158 in one select; families have twins of their own."""
    return pan.all_factors(panel(spark, d).withColumn("vwap", div("turnover", "volume")))


M_ = "OVER (PARTITION BY entity, date ORDER BY minute)"


@query(
    """SELECT entity, date, CASE WHEN n >= 10 THEN ao / lag(pc) OVER (PARTITION BY entity ORDER BY date) - 1 END AS ret_overnight, CASE WHEN n >= 10 THEN ac / ao - 1 END AS ret_am, CASE WHEN n >= 10 THEN pc / po - 1 END AS ret_pm FROM (SELECT entity, date, count(*) AS n, arg_min(open, minute) FILTER (minute BETWEEN 8 AND 11) AS ao, arg_max(close, minute) FILTER (minute BETWEEN 8 AND 11) AS ac, arg_min(open, minute) FILTER (minute BETWEEN 13 AND 17) AS po, arg_max(close, minute) FILTER (minute BETWEEN 13 AND 17) AS pc FROM minutes GROUP BY 1, 2)""",
    doubles="ret_overnight, ret_am, ret_pm", ctes=MINUTES_SQL)
def minute_apm(spark: SparkSession, d: str) -> DataFrame:
    """M6, W21, A7."""
    return minute.apm_segments(minutes(spark, d), {"am": (8, 11), "pm": (13, 17)}, 10)


@query(
    f"""SELECT entity, date, CASE WHEN count(*) >= 10 THEN avg(CASE WHEN s THEN v END) END AS dazzle_vol, CASE WHEN count(*) >= 10 THEN avg(CASE WHEN s THEN r END) END AS dazzle_ret FROM (
SELECT *, coalesce(dv > avg(dv) OVER (PARTITION BY entity, date) + stddev_samp(dv) OVER (PARTITION BY entity, date), false) AS s, CASE WHEN count(r) OVER w >= 2 THEN stddev_samp(r) OVER w END AS v FROM (SELECT *, volume - lag(volume) {M_} AS dv, close / lag(close) {M_} - 1 AS r FROM minutes WHERE minute BETWEEN 1 AND 21) WINDOW w AS (PARTITION BY entity, date ORDER BY minute ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)) GROUP BY 1, 2""",
    doubles="dazzle_vol, dazzle_ret", ctes=MINUTES_SQL)
def minute_dazzle(spark: SparkSession, d: str) -> DataFrame:
    """M5, W20."""
    return minute.dazzle(minutes(spark, d), 1.0, 5, 1, 2, 10)


@query(
    f"""SELECT entity, date, CASE WHEN n >= 10 AND mm IS NOT NULL AND nn IS NOT NULL THEN (nn.c - mm.c) / mm.c / (nn.p - mm.p) END AS tide_full FROM (SELECT entity, date, max(n) AS n, min(CASE WHEN pos < t THEN {{'v': nb, 'p': pos, 'c': close}} END) AS mm, min(CASE WHEN pos > t THEN {{'v': nb, 'p': pos, 'c': close}} END) AS nn FROM (
SELECT *, -max({{'v': nb, 'p': -pos}}) OVER (PARTITION BY entity, date).p AS t FROM (SELECT *, row_number() {M_} AS pos, count(*) OVER (PARTITION BY entity, date) AS n, sum(volume) OVER (PARTITION BY entity, date ORDER BY minute ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS nb FROM minutes WHERE minute BETWEEN 1 AND 21)) GROUP BY 1, 2)""".replace("-max({'v': nb, 'p': -pos}) OVER (PARTITION BY entity, date).p", "-(max({'v': nb, 'p': -pos}) OVER (PARTITION BY entity, date)).p"),
    doubles="tide_full", ctes=MINUTES_SQL)
def minute_tide(spark: SparkSession, d: str) -> DataFrame:
    """M3, W19, T8."""
    return minute.tide(minutes(spark, d), 2, 1, 2, 10)


@query(
    f"""SELECT entity, date, CASE WHEN k >= 3 THEN sum(close * volume) FILTER (b < 0.2 * a) / sum(volume) FILTER (b < 0.2 * a) END AS smart_vwap, CASE WHEN k >= 3 THEN sum(close * volume) / sum(volume) END AS all_vwap FROM (
SELECT t.entity, t.date, t.k, m.close, m.volume, sum(m.volume) OVER (PARTITION BY t.entity, t.k ORDER BY m.s DESC NULLS LAST, m.date, m.minute ROWS UNBOUNDED PRECEDING) - m.volume AS b, sum(m.volume) OVER (PARTITION BY t.entity, t.k) AS a FROM days t JOIN (SELECT x.*, k AS dk, abs(close / lag(close) OVER (PARTITION BY x.entity, x.date ORDER BY minute) - 1) / pow(volume, 0.1) AS s FROM minutes x JOIN days USING (entity, date)) m ON m.entity = t.entity AND m.dk BETWEEN t.k - 2 AND t.k) GROUP BY entity, date, k""",
    doubles="smart_vwap, all_vwap", ctes=MINUTES_SQL + ", days AS (SELECT entity, date, row_number() OVER (PARTITION BY entity ORDER BY date) AS k FROM (SELECT DISTINCT entity, date FROM minutes))")
def minute_smart_money(spark: SparkSession, d: str) -> DataFrame:
    """M4, T5."""
    return minute.smart_money(minutes(spark, d), lookback=3)


PRV = ("peak_count", "ridge_count", "valley_count", "peak_volume", "ridge_volume", "valley_volume", "peak_vwap", "ridge_return_sum", "eruption_n", "eruption_xy", "close", "vwap", "volume")


@query(
    f"""SELECT entity, date, {", ".join(f"CASE WHEN row_number() OVER (PARTITION BY entity ORDER BY date) > 5 THEN {c} END AS {c}" for c in PRV)} FROM (SELECT entity, date, count(*) FILTER (e AND NOT nr) AS peak_count, count(*) FILTER (e AND nr) AS ridge_count, count(*) FILTER (NOT e AND volume IS NOT NULL) AS valley_count, sum(volume) FILTER (e AND NOT nr) AS peak_volume, sum(volume) FILTER (e AND nr) AS ridge_volume, sum(volume) FILTER (NOT e) AS valley_volume, sum(close * volume) FILTER (e AND NOT nr) / sum(volume) FILTER (e AND NOT nr) AS peak_vwap, sum(r) FILTER (e AND nr) AS ridge_return_sum, count(*) FILTER (e) AS eruption_n, sum(turnover * nx) FILTER (e) AS eruption_xy, arg_max(close, minute) FILTER (close IS NOT NULL) AS close, sum(close * volume) / sum(volume) AS vwap, sum(volume) AS volume FROM (
SELECT *, coalesce(lag(e) {M_}, false) OR coalesce(lead(e) {M_}, false) AS nr, close / lag(close) {M_} - 1 AS r, coalesce(lead(turnover) {M_}, 0) AS nx FROM (SELECT *, coalesce(volume > CASE WHEN count(volume) OVER w = 5 THEN avg(volume) OVER w + stddev_samp(volume) OVER w END, false) AS e FROM grid WINDOW w AS (PARTITION BY entity, minute ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))) GROUP BY 1, 2)""",
    doubles=", ".join(PRV), ctes=MINUTES_SQL + ", grid AS (SELECT entity, date, minute, high, low, close, volume, turnover FROM (SELECT DISTINCT entity, date FROM minutes) CROSS JOIN (SELECT DISTINCT minute FROM minutes) LEFT JOIN minutes USING (entity, date, minute))")
def minute_peaks(spark: SparkSession, d: str) -> DataFrame:
    """M1, W16-W18, A8-A10."""
    return minute.peak_ridge_valley(minutes(spark, d), 5)


MASK_SQL = ", flags AS (SELECT entity, date, volume < 40 AS is_st, close < 20 AS is_suspended, turnover > 2500 AS is_limit_up, open > 42 AS is_new_stock FROM panel), cal AS (SELECT date, lead(date) OVER (ORDER BY date) AS nxt FROM (SELECT DISTINCT date FROM panel)), mask AS (SELECT f.entity, f.date, NOT (coalesce(n.is_st, false) OR coalesce(n.is_suspended, false) OR coalesce(n.is_new_stock, false)) AS pre, NOT coalesce(n.is_limit_up, false) AS post FROM flags f JOIN cal ON cal.date = f.date LEFT JOIN flags n ON n.entity = f.entity AND n.date = cal.nxt)"


def flags(spark: SparkSession, d: str) -> DataFrame:
    return panel(spark, d).selectExpr("entity", "date", "volume < 40 AS is_st", "close < 20 AS is_suspended", "turnover > 2500 AS is_limit_up", "open > 42 AS is_new_stock")


@query(
    f"""SELECT entity, date, pre, post, CASE WHEN post THEN (w - avg(w) {D_}) / nullif(stddev_pop(w) {D_}, 0) END AS cleaned FROM (SELECT *, CASE WHEN x IS NOT NULL THEN CASE WHEN mad > 0 THEN greatest(least(x, med + 3 * mad), med - 3 * mad) ELSE x END END AS w FROM (SELECT *, 1.4826 * quantile_cont(abs(x - med), 0.5) {D_} AS mad FROM (SELECT *, quantile_cont(x, 0.5) {D_} AS med FROM (SELECT m.*, CASE WHEN pre THEN close END AS x FROM mask m JOIN panel USING (entity, date)))))""",
    "entity, date, pre, post", "cleaned", PANEL_SQL + MASK_SQL)
def cleaned_factor(spark: SparkSession, d: str) -> DataFrame:
    """E1, E2, P5, P6, S13."""
    return ev.prepare_factor(panel(spark, d).select("entity", "date", F.col("close").alias("x")), ev.masks(flags(spark, d)))


IND_SQL = ", ind AS (SELECT p.*, n_regionkey AS industry, s_acctbal AS size FROM panel p JOIN supplier ON entity = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"


def industries(spark: SparkSession, d: str) -> DataFrame:
    s, n = tables.read(spark, d, "supplier"), tables.read(spark, d, "nation")
    dim = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(F.col("s_suppkey").alias("entity"), F.col("n_regionkey").alias("industry"), F.col("s_acctbal").alias("size"))
    return panel(spark, d).join(dim, "entity")


@query(
    f"""SELECT entity, date, CASE WHEN y IS NOT NULL AND n >= greatest(g + 2, 10) THEN dy - coalesce(sum(dx * dy) {D_} / nullif(sum(dx * dx) {D_}, 0), 0) * dx END AS neutral FROM (SELECT *, count(y) {D_} AS n, len(list_distinct(list(CASE WHEN y IS NOT NULL THEN industry END) {D_})) AS g FROM (SELECT *, y - avg(y) OVER (PARTITION BY date, industry) AS dy, x - avg(x) OVER (PARTITION BY date, industry) AS dx FROM (SELECT entity, date, industry, CASE WHEN size > 0 THEN close END AS y, CASE WHEN size > 0 THEN ln(size) END AS x FROM ind)))""",
    doubles="neutral", ctes=PANEL_SQL + IND_SQL)
def neutral_factor(spark: SparkSession, d: str) -> DataFrame:
    """R6, E3, J6."""
    return ev.neutralize(industries(spark, d), "close", "size", "industry", min_samples=10)


@query(f"SELECT entity, date, h AS horizon, CASE h WHEN 1 THEN lead(close, 2) {E_} WHEN 5 THEN lead(close, 6) {E_} END / lead(close, 1) {E_} - 1 AS ret FROM panel CROSS JOIN (SELECT unnest([1, 5]) AS h)".replace("PARTITION BY entity", "PARTITION BY entity, h"), "entity, date, horizon", "ret")
def forward_return_labels(spark: SparkSession, d: str) -> DataFrame:
    """W24, E4, D11."""
    return ev.forward_returns(panel(spark, d), [1, 5])


@query(
    """SELECT 1 AS horizon, count(ic) AS n_days, avg(ic) AS ic_mean, stddev_pop(ic) AS ic_std, avg(ic) / stddev_pop(ic) AS icir, avg(ic) / stddev_pop(ic) * sqrt(count(ic)) AS ic_t, avg(CASE WHEN ic > 0 THEN 1.0 ELSE 0 END) AS pct_positive, skewness(ic) AS ic_skew, kurtosis(ic) AS ic_kurt FROM (SELECT round(ic, 6) AS ic FROM (SELECT date, corr(a, b) AS ic FROM (SELECT date, rank() OVER (PARTITION BY date ORDER BY f) AS a, rank() OVER (PARTITION BY date ORDER BY r) AS b FROM (SELECT date, volume + entity / 1000.0 AS f, lead(close, 2) OVER (PARTITION BY entity ORDER BY date) / lead(close, 1) OVER (PARTITION BY entity ORDER BY date) - 1 AS r FROM panel) WHERE r IS NOT NULL) GROUP BY date HAVING count(*) > 2))""",
    "horizon, n_days", "ic_mean, ic_std, icir, ic_t, pct_positive, ic_skew, ic_kurt")
def ic_report(spark: SparkSession, d: str) -> DataFrame:
    """A12, E5."""
    p = panel(spark, d)
    df = p.select("entity", "date", (F.col("volume") + F.col("entity") / 1000.0).alias("f")).join(ev.forward_returns(p, [1]), ["entity", "date"]).where("ret is not null")
    ics = ev.ic_series(df, "f", "ret", ["horizon", "date"], joint=True, least=3).withColumn("ic", F.round("ic", 6))
    return ev.ic_summary(ics, ["horizon"])


LAYER_SQL = f"""held AS (SELECT o.date, layer, avg(ret) AS ret, count(ret) AS members FROM on_ o JOIN (SELECT per, entity, CAST(least(greatest(ceil(CAST(rn AS DOUBLE) / n * 5) - 1, 0), 4) AS INTEGER) AS layer FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY f, entity) AS rn, count(f) {D_} AS n FROM on_ WHERE dy % 5 = 0)) l ON o.per = l.per AND o.entity = l.entity GROUP BY 1, 2)"""
ON_SQL = f", days AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS dy FROM (SELECT DISTINCT date FROM panel)), on_ AS (SELECT p.entity, p.date, volume AS f, close / lag(close) OVER (PARTITION BY p.entity ORDER BY p.date) - 1 AS ret, dy, dy // 5 AS per FROM panel p JOIN days USING (date))"


def layered(spark: SparkSession, d: str) -> DataFrame:
    p = panel(spark, d)
    w = Window.partitionBy("entity").orderBy("date")
    return ev.layers(p.select("entity", "date", F.col("volume").alias("f"), (F.col("close") / F.lag("close").over(w) - 1).alias("ret")), "f", "ret")


@query("SELECT * FROM held", "date, layer, members", "ret", PANEL_SQL + ON_SQL + ", " + LAYER_SQL)
def layered_backtest(spark: SparkSession, d: str) -> DataFrame:
    """E6, W23, A13, T6."""
    return layered(spark, d)


@query(
    """SELECT layer, count(*) AS days, ln(product(1 + coalesce(ret, 0))) AS log_return, stddev_pop(coalesce(ret, 0)) * sqrt(252) AS vol FROM (SELECT date, layer, ret FROM held UNION ALL SELECT date, -1, max(ret) FILTER (layer = 4) - max(ret) FILTER (layer = 0) FROM held WHERE layer IN (0, 4) GROUP BY date) GROUP BY layer""",
    "layer, days", "log_return, vol", PANEL_SQL + ON_SQL + ", " + LAYER_SQL)
def layered_statistics(spark: SparkSession, d: str) -> DataFrame:
    """E6, W22."""
    return ev.layer_stats(layered(spark, d)).withColumn("log_return", F.log1p("total_return"))


@query(
    """SELECT a.factor AS f1, b.factor AS f2, count(*) AS n, corr(a.value, b.value) AS rho FROM long a JOIN long b ON a.entity = b.entity AND a.date = b.date AND a.factor < b.factor GROUP BY 1, 2""",
    "f1, f2, n", "rho", PANEL_SQL + ", long AS (SELECT entity, date, 'close' AS factor, close AS value FROM panel UNION ALL SELECT entity, date, 'volume', volume FROM panel UNION ALL SELECT entity, date, 'range', high - low FROM panel)")
def factor_correlations(spark: SparkSession, d: str) -> DataFrame:
    """J12, R9, R10, E10."""
    p = panel(spark, d).select("entity", "date", "close", "volume", (F.col("high") - F.col("low")).alias("range"))
    return ev.factor_correlation(p.unpivot(["entity", "date"], ["close", "volume", "range"], "factor", "value"), centred=True)


@query(
    """SELECT entity, date, list_sum(list_transform(range(3), lambda i: pow(2, -i / 2.0) * l[i + 1].s)) AS icm FROM (SELECT entity, date, list_reverse_sort(list({'k': ret, 'p': p, 's': signal}) OVER w) AS l, count(ret) OVER w AS n FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY date) AS p FROM (SELECT entity, date, ret, avg(ret) OVER (PARTITION BY date) AS signal FROM (SELECT entity, date, close / lag(close) OVER (PARTITION BY entity ORDER BY date) - 1 AS ret FROM panel))) WINDOW w AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) WHERE n = 10""",
    doubles="icm")
def co_momentum(spark: SparkSession, d: str) -> DataFrame:
    """X1, T3."""
    w = Window.partitionBy("entity").orderBy("date")
    df = panel(spark, d).withColumn("ret", F.col("close") / F.lag("close").over(w) - 1).withColumn("signal", F.avg("ret").over(Window.partitionBy("date"))).withColumn("amount", F.col("turnover"))
    return events.co_momentum(df, "ICM", "icm", window=10, n_mom=3, n_rev=7).where("icm is not null")


@query(
    f"""SELECT entity, date, position, f FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY f DESC, entity) AS position FROM (SELECT entity, date, ret - avg(CASE WHEN volume > 100 THEN ret END) {D_} AS f FROM (SELECT *, close / lag(close) {E_} - 1 AS ret FROM panel)) WHERE f IS NOT NULL) WHERE position <= 10""",
    "entity, date, position", "f")
def top_signals(spark: SparkSession, d: str) -> DataFrame:
    """L1, L9, T2."""
    w = Window.partitionBy("entity").orderBy("date")
    df = panel(spark, d).withColumn("ret", F.col("close") / F.lag("close").over(w) - 1)
    return ev.top_n(ev.excess_label(df, "ret", F.col("volume") > 100, "f"), "f", 10)


@query(
    """SELECT entity, date, CASE WHEN date <= DATE '1995-12-31' THEN 'train' WHEN date > DATE '1996-01-31' AND date <= DATE '1996-12-31' THEN 'valid' WHEN date > DATE '1997-01-31' THEN 'test' END AS segment, (close - (SELECT m FROM fit)) / nullif(1.4826 * (SELECT quantile_cont(abs(close - (SELECT m FROM fit)), 0.5) FROM panel WHERE date <= DATE '1995-12-31'), 0) AS close FROM panel""",
    "entity, date, segment", "close", PANEL_SQL + ", fit AS (SELECT quantile_cont(close, 0.5) AS m FROM panel WHERE date <= DATE '1995-12-31')")
def ml_dataset(spark: SparkSession, d: str) -> DataFrame:
    """L2, L4."""
    df = ev.split_segments(panel(spark, d), "1995-12-31", "1996-12-31")
    return ev.robust_scale(df, ["close"], F.col("segment") == "train")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""", "l_orderkey, l_linenumber, l_partkey, l_extendedprice", "", "")
def upsert_keep_last(spark: SparkSession, d: str) -> DataFrame:
    """K4, U2."""
    return steps.keep_last(tables.read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])


@query(
    """SELECT c AS name, count(x) AS n, sum(x) AS total, sum(x * x) AS squares, min(x) AS lowest, max(x) AS highest, avg(x) AS mean, stddev_samp(x) AS std FROM (SELECT 'close' AS c, close AS x FROM panel UNION ALL SELECT 'volume', volume FROM panel) GROUP BY 1""",
    "name, n", "total, squares, lowest, highest, mean, std")
def table_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """A16."""
    return tables.fingerprint(panel(spark, d), ["close", "volume"]).withColumnRenamed("column", "name")


@query(
    """SELECT entity, quarter, bin, count(*) AS n FROM (SELECT entity % 7 AS entity, quarter(date) AS quarter, CAST(least(floor(volume / 50), 9) AS BIGINT) AS bin FROM panel) GROUP BY 1, 2, 3""",
    "entity, quarter, bin, n")
def histograms(spark: SparkSession, d: str) -> DataFrame:
    """A17."""
    return panel(spark, d).groupBy((F.col("entity") % 7).alias("entity"), F.quarter("date").cast("long").alias("quarter"), F.least(F.floor(F.col("volume") / 50), F.lit(9)).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, sum(sqrt(abs(value))) AS total FROM events GROUP BY 1, 2""",
    "window_start, event_type, n", "total", "")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    """2.19: the windowed aggregate that also runs on a stream."""
    from ..streaming.incremental import windowed_counts

    return windowed_counts(tables.read(spark, d, "events").withColumn("value", F.sqrt(F.abs("value"))))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
