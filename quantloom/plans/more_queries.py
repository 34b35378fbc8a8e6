"""Further queries with their twins: fundamental factors, evaluation, consensus panels, sources, whole reducers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import div, greater, less
from ..operators import evaluation as ev
from ..operators import attribution, events, learning, minute, steps
from ..operators import panel as pan
from ..operators.sliding import BARS
from ..shipping import shared_dir, stored
from ..sources import tables
from . import spec
from .panels import MINUTES_SQL, PANEL_SQL, minutes, panel
from .queries import D_, E_, IND_SQL, LAYER_SQL, MASK_SQL, ON_SQL, ORDERS_SQL, QUERIES, SQL, exact_ic, flags, frame, industries, layered, query, reports
from .recipes import recipes

# ---- fundamental factors

FIN_SQL = ", fin AS (SELECT entity, date, close AS pe, open AS pb, high * 1000 AS cap, volume AS profit_ttm, low AS cash_flow_ttm, floor(volume / 100) AS roic, entity % 3 AS industry, " + ", ".join(f"lag(turnover - 1000, {k}) {E_} AS profit_q{k}, lag(volume + 1, {k}) {E_} AS equity_q{k}" for k in range(9)) + " FROM panel)"
SMALL = recipes(delta=12, samples=8, group_samples=7, median=(12, 6), bins=2, periods=(4, 2))


def fin(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("entity").orderBy("date")
    back = {f"{n}_q{k}": F.lag(F.col(c) + more, k).over(w) for k in range(9) for n, c, more in (("profit", "turnover", -1000), ("equity", "volume", 1))}
    plain = {"pe": F.col("close"), "pb": F.col("open"), "cap": F.col("high") * 1000, "profit_ttm": F.col("volume"), "cash_flow_ttm": F.col("low"), "roic": F.floor(F.col("volume") / 100).cast("double"), "industry": F.col("entity") % 3}
    return panel(spark, d).withColumns(plain | back).select("entity", "date", *plain, *back)


def made(spark: SparkSession, d: str, *names: str) -> DataFrame:
    """The factors named, on all rows of the table."""
    source = fin(spark, d)
    out = source.select("entity", "date")
    for n in names:
        r = SMALL[n]
        out = out.join(spec.run(r, spec.Context({"daily": source})).withColumnRenamed(r["factor"]["column"], n), ["entity", "date"], "left")
    return out


@query("SELECT entity, date, pe AS pe_ttm_new, cash_flow_ttm AS net_oper_cash_flow_ttm, cap / nullif(profit_q0, 0) AS pe_mrq, profit_q0 / equity_q0 AS roe_mrq_new, pe - lag(pe, 12) OVER (PARTITION BY entity ORDER BY date) AS pe_ttm_delta60 FROM fin", doubles="pe_ttm_new, net_oper_cash_flow_ttm, pe_mrq, roe_mrq_new, pe_ttm_delta60", ctes=PANEL_SQL + FIN_SQL)
def fundamental_ratios(spark: SparkSession, d: str) -> DataFrame:
    """D1-D3."""
    return made(spark, d, "pe_ttm_new", "net_oper_cash_flow_ttm", "pe_mrq", "roe_mrq_new", "pe_ttm_delta60")


def growth_sql(what: str) -> str:
    x = (lambda k: f"profit_q{k}") if what == "npf" else (lambda k: f"(profit_q{k} / equity_q{k})")
    each = [(f"{what}_{b}{s}_mrq", f"({x(0)} - {x(k)}) / nullif(abs({x(k)}), 0)" if b == "a" else f"CASE WHEN {x(k)} > 0 THEN ({x(0)} - {x(k)}) / abs({x(k)}) END") for b in "ap" for s, k in (("yoy", 4), ("qoq", 1))]
    return "SELECT entity, date, " + ", ".join(f"{e} AS {n}" for n, e in each) + " FROM fin"


GROWTH = {w: [f"{w}_{b}{s}_mrq" for b in "ap" for s in ("yoy", "qoq")] for w in ("npf", "roe")}


@query(growth_sql("npf"), doubles=", ".join(GROWTH["npf"]), ctes=PANEL_SQL + FIN_SQL)
def profit_growth(spark: SparkSession, d: str) -> DataFrame:
    """D4."""
    return made(spark, d, *GROWTH["npf"])


@query(growth_sql("roe"), doubles=", ".join(GROWTH["roe"]), ctes=PANEL_SQL + FIN_SQL)
def return_growth(spark: SparkSession, d: str) -> DataFrame:
    """D4."""
    return made(spark, d, *GROWTH["roe"])


def above(first: str, others: list[str]) -> str:
    return f"CASE WHEN {first} IS NOT NULL THEN 1" + "".join(f" + CASE WHEN {first} > {x} THEN 1 ELSE 0 END" for x in others) + " END"


@query(f"SELECT entity, date, {above('profit_q0', [f'profit_q{k}' for k in range(1, 8)])} AS np_rank, {above('(profit_q0 - profit_q1)', [f'(profit_q{k} - profit_q{k + 1})' for k in range(1, 8)])} AS np_delta_rank FROM fin", doubles="np_rank, np_delta_rank", ctes=PANEL_SQL + FIN_SQL)
def profit_ranks(spark: SparkSession, d: str) -> DataFrame:
    """D5."""
    return made(spark, d, "np_rank", "np_delta_rank")


@query(
    f"""SELECT entity, date, CASE WHEN s > 0 THEN (profit_q0 - profit_q4 - m) / s END AS npf_mrq_sue8, CASE WHEN abs(rho) < 0.9 AND sy > 0 THEN quad END AS npf_mrq_accs8 FROM (
SELECT *, list_avg(d) AS m, list_stddev_samp(d) AS s, list_stddev_samp(y) AS sy, (SELECT corr(a, b) FROM (SELECT unnest([profit_q0, profit_q1, profit_q2, profit_q3]) AS a, unnest([profit_q4, profit_q5, profit_q6, profit_q7]) AS b)) AS rho,
list_sum(list_transform(range(8), lambda i: ((i - 3.5) * (i - 3.5) - 5.25) * y[i + 1])) / 168 * 6 / list_stddev_samp(y) AS quad
FROM (SELECT *, list_filter([{", ".join(f"profit_q{k} - profit_q{k + 1}" for k in range(7))}], lambda x: x IS NOT NULL) AS d, CASE WHEN profit_q7 IS NOT NULL THEN [{", ".join(f"profit_q{k}" for k in range(8))}] END AS y FROM fin))""",
    doubles="npf_mrq_sue8, npf_mrq_accs8", ctes=PANEL_SQL + FIN_SQL)
def profit_surprise(spark: SparkSession, d: str) -> DataFrame:
    """D6, D7, R3 of degree two, R4, A1: the squares' coefficient by orthogonal contrasts (sum of squares 168, variance of 0..7 being 6)."""
    return made(spark, d, "npf_mrq_sue8", "npf_mrq_accs8")


@query(
    f"""SELECT b.entity, b.date, reg_pe_hist FROM fin b LEFT JOIN (SELECT entity, date, CASE WHEN c IS NOT NULL AND r IS NOT NULL AND count(CASE WHEN c IS NOT NULL THEN r END) {D_} >= 8 THEN c - regr_intercept(c, r) {D_} - regr_slope(c, r) {D_} * r END AS reg_pe_hist FROM (
SELECT *, CASE WHEN a IS NOT NULL AND t IS NOT NULL AND count(CASE WHEN a IS NOT NULL THEN t END) {D_} >= 8 THEN a - regr_intercept(a, t) {D_} - regr_slope(a, t) {D_} * t END AS r FROM (
SELECT entity, date, ln(profit_q0 / profit_q4) - lag(ln(profit_q0 / profit_q4), 12) {E_} AS a, ln(profit_ttm) - lag(ln(profit_ttm), 12) {E_} AS t, ln(pe) - lag(ln(pe), 12) {E_} AS c FROM fin WHERE profit_q0 > 0 AND profit_q4 > 0 AND profit_ttm > 0 AND pe > 0))) x ON b.entity = x.entity AND b.date = x.date""",
    doubles="reg_pe_hist", ctes=PANEL_SQL + FIN_SQL)
def reg_pe_hist(spark: SparkSession, d: str) -> DataFrame:
    """Rows go before differences are taken, two nested cross-sections."""
    return made(spark, d, "reg_pe_hist")


def clipped_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN CASE WHEN {c}_d > 0 THEN greatest(least({c}, {c}_m + 3 * {c}_d), {c}_m - 3 * {c}_d) ELSE {c} END END AS {c}_w"


@query(
    f"""SELECT b.entity, b.date, reg_pb_gshe FROM fin b LEFT JOIN (SELECT entity, date, CASE WHEN g IS NOT NULL AND count(log_pb_w) OVER k >= 7 THEN log_pb_w - regr_intercept(log_pb_w, roe_w) OVER k - regr_slope(log_pb_w, roe_w) OVER k * roe_w END AS reg_pb_gshe FROM (
SELECT *, CASE WHEN ep_w IS NOT NULL THEN least(floor((rank() OVER (PARTITION BY date ORDER BY ep_w NULLS LAST) + (count(*) OVER (PARTITION BY date, ep_w) - 1) / 2.0) / count(ep_w) {D_} * 2) + 1, 2) END AS g FROM (SELECT *, {", ".join(map(clipped_sql, ("ep", "roe", "log_pb")))} FROM (
SELECT *, {", ".join(f"1.4826 * quantile_cont(abs({c} - {c}_m), 0.5) {D_} AS {c}_d" for c in ("ep", "roe", "log_pb"))} FROM (SELECT *, {", ".join(f"quantile_cont({c}, 0.5) {D_} AS {c}_m" for c in ("ep", "roe", "log_pb"))} FROM (
SELECT entity, date, CASE WHEN count(profit_q0 / cap) {frame(12)} >= 6 THEN quantile_cont(profit_q0 / cap, 0.5) {frame(12)} END AS ep, profit_q0 / equity_q0 AS roe, ln(pb) AS log_pb FROM fin WHERE pb > 0 AND profit_q0 / equity_q0 > 0)))))
WINDOW k AS (PARTITION BY date, g)) x ON b.entity = x.entity AND b.date = x.date""",
    doubles="reg_pb_gshe", ctes=PANEL_SQL + FIN_SQL)
def reg_pb_gshe(spark: SparkSession, d: str) -> DataFrame:
    """Rolling median, clipping, groups, cross-section within groups."""
    return made(spark, d, "reg_pb_gshe")


def on_change_sql(value: str, agg: str) -> str:
    """Rolling over the rows on which roic changes, carried on."""
    return f"""SELECT entity, date, last_value(v IGNORE NULLS) OVER (PARTITION BY entity ORDER BY date ROWS UNBOUNDED PRECEDING) AS v FROM (SELECT *, CASE WHEN s AND count(x) OVER w >= 2 THEN {agg}(x) OVER w END AS v FROM (
SELECT entity, date, {value} AS x, (roic IS DISTINCT FROM lag(roic) {E_} OR row_number() {E_} = 1) AS s FROM fin) WINDOW w AS (PARTITION BY entity, s ORDER BY date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))"""


@query(
    f"""SELECT a.entity, a.date, a.v AS roic_ttm_all_rnk8, b.v AS roic_ttm_ind_rnk8, CASE WHEN c.v <> 0 THEN 1 / c.v END AS roic_ttm_dev_std8 FROM ({on_change_sql("rank() OVER (PARTITION BY date ORDER BY roic DESC)", "min")}) a JOIN ({on_change_sql("rank() OVER (PARTITION BY date, industry ORDER BY roic DESC)", "min")}) b USING (entity, date) JOIN ({on_change_sql("roic", "stddev_samp")}) c USING (entity, date)""",
    doubles="roic_ttm_all_rnk8, roic_ttm_ind_rnk8, roic_ttm_dev_std8", ctes=PANEL_SQL + FIN_SQL)
def roic_factors(spark: SparkSession, d: str) -> DataFrame:
    """D9, W2, W8."""
    return made(spark, d, "roic_ttm_all_rnk8", "roic_ttm_ind_rnk8", "roic_ttm_dev_std8")


# ---- evaluation


@query(
    """SELECT date, layer, ret, sign(nav) * ln(abs(nav)) AS log_nav FROM (SELECT *, product(1 + coalesce(ret, 0)) OVER (PARTITION BY layer ORDER BY date ROWS UNBOUNDED PRECEDING) AS nav FROM (SELECT date, layer, ret FROM held UNION ALL SELECT date, -1, max(ret) FILTER (layer = 4) - max(ret) FILTER (layer = 0) FROM held WHERE layer IN (0, 4) GROUP BY date))""",
    "date, layer", "ret, log_nav", PANEL_SQL + ON_SQL + ", " + LAYER_SQL)
def layer_nav(spark: SparkSession, d: str) -> DataFrame:
    """Running net values."""
    return ev.layer_paths(layered(spark, d)).withColumn("log_nav", F.signum("nav") * F.log(F.abs("nav")))


@query(
    """SELECT 1 AS one, corr(layer, pow(nav, 252.0 / days) - 1) AS monotonicity FROM (SELECT layer, count(*) AS days, product(1 + coalesce(ret, 0)) AS nav FROM held GROUP BY layer)""",
    "one", "monotonicity", PANEL_SQL + ON_SQL + ", " + LAYER_SQL)
def layer_monotonicity(spark: SparkSession, d: str) -> DataFrame:
    """E6."""
    held = layered(spark, d)
    return ev.monotonicity(ev.layer_stats(held)).withColumn("one", F.lit(1))


@query(
    """SELECT per, layer, count(*) AS members, avg(CASE WHEN b IS NULL THEN 1.0 ELSE 0 END) AS turnover FROM (SELECT m.per, m.layer, o.entity AS b FROM mem m LEFT JOIN mem o ON o.entity = m.entity AND o.layer = m.layer AND o.per = m.per - 1) GROUP BY 1, 2""",
    "per, layer, members", "turnover", PANEL_SQL + ", mem AS (SELECT entity, year(date) AS per, CAST(floor(max(volume) / 60) AS INTEGER) AS layer FROM panel GROUP BY 1, 2)")
def layer_turnover(spark: SparkSession, d: str) -> DataFrame:
    """Share of new members."""
    m = panel(spark, d).groupBy("entity", F.year("date").alias("per")).agg(F.floor(F.max("volume") / 60).cast("int").alias("layer"))
    return ev.turnover(m, "layer", "per")


ICS_SQL = f", ics AS (SELECT date, {exact_ic('a', 'b')} AS ic FROM (SELECT date, rank() OVER (PARTITION BY date ORDER BY f) AS a, rank() OVER (PARTITION BY date ORDER BY r) AS b FROM (SELECT date, volume + entity / 1000.0 AS f, lead(close, 2) OVER (PARTITION BY entity ORDER BY date) / lead(close, 1) OVER (PARTITION BY entity ORDER BY date) - 1 AS r FROM panel) WHERE r IS NOT NULL) GROUP BY date HAVING count(*) > 2)"


def scored(spark: SparkSession, d: str) -> DataFrame:
    p = panel(spark, d)
    return p.select("entity", "date", (F.col("volume") + F.col("entity") / 1000.0).alias("f")).join(ev.forward_returns(p, [1]).select("entity", "date", "ret"), ["entity", "date"]).where("ret is not null")


@query("SELECT date, ic, sum(ic) OVER (ORDER BY date) AS ic_total, avg(ic) OVER (PARTITION BY year(date)) AS ic_year FROM ics", "date", "ic, ic_total, ic_year", PANEL_SQL + ICS_SQL)
def ic_paths(spark: SparkSession, d: str) -> DataFrame:
    """Running sum and yearly means."""
    return ev.cumulative_ic(ev.ic_series(scored(spark, d), "f", "ret", ["date"], True, 3), [])


@query("SELECT count(ic) AS months, avg(ic) AS ic_mean, avg(ic) / stddev_samp(ic) * sqrt(12) AS icir_year, avg(CASE WHEN ic > 0 THEN 1.0 ELSE 0 END) AS hit_rate FROM ics", "months", "ic_mean, icir_year, hit_rate", PANEL_SQL + ICS_SQL)
def month_end_ic(spark: SparkSession, d: str) -> DataFrame:
    """E12."""
    return ev.monthly_rank_ic(ev.month_ends(scored(spark, d), None), "f", "ret", 3)


@query("SELECT entity, date, f * (SELECT CASE WHEN avg(ic) < 0 THEN -1 ELSE 1 END FROM ics) AS signed FROM (SELECT entity, date, volume + entity / 1000.0 AS f, lead(close, 2) OVER (PARTITION BY entity ORDER BY date) AS r FROM panel) WHERE r IS NOT NULL", doubles="signed", ctes=PANEL_SQL + ICS_SQL)
def flipped_factor(spark: SparkSession, d: str) -> DataFrame:
    """E7."""
    df = scored(spark, d)
    return ev.flipped(df, ev.ic_series(df, "f", "ret", ["date"], True, 3), "f", "signed")


TWICE_RANK = "CASE WHEN {x} IS NOT NULL THEN 2 * rank() OVER (PARTITION BY {g} ORDER BY {x} NULLS LAST) + count(*) OVER (PARTITION BY {g}, {x}) - 1 END"
LONG_IC = "SELECT {keys}, count(*) AS n, " + exact_ic("a", "b") + " AS ic FROM (SELECT *, " + TWICE_RANK.format(x="value", g="{keys}") + " AS a, " + TWICE_RANK.format(x="ret", g="{keys}") + " AS b FROM ({source})) WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY {keys} HAVING count(*) >= {least}"
FWD_SQL = f", fwd AS (SELECT entity, date, 1 AS horizon, lead(close, 2) {E_} / lead(close, 1) {E_} - 1 AS ret FROM panel UNION ALL SELECT entity, date, 3, lead(close, 4) {E_} / lead(close, 1) {E_} - 1 FROM panel)"
CLEAN_SQL = f""", cleaned AS (SELECT entity, date, CASE WHEN post THEN (w - avg(w) {D_}) / nullif(stddev_pop(w) {D_}, 0) END AS y FROM (SELECT *, CASE WHEN x IS NOT NULL THEN CASE WHEN mad > 0 THEN greatest(least(x, med + 3 * mad), med - 3 * mad) ELSE x END END AS w FROM (SELECT *, 1.4826 * quantile_cont(abs(x - med), 0.5) {D_} AS mad FROM (SELECT *, quantile_cont(x, 0.5) {D_} AS med FROM (SELECT m.*, CASE WHEN pre THEN turnover END AS x FROM mask m JOIN panel USING (entity, date)))))),
neut AS (SELECT entity, date, CASE WHEN y IS NOT NULL AND x IS NOT NULL AND n >= greatest(g + 2, 10) THEN dy - coalesce(sum(dx * dy) {D_} / nullif(sum(dx * dx) {D_}, 0), 0) * dx END AS y FROM (SELECT *, count(CASE WHEN x IS NOT NULL THEN y END) {D_} AS n, len(list_distinct(list(CASE WHEN y IS NOT NULL AND x IS NOT NULL THEN industry END) {D_})) AS g FROM (SELECT *, CASE WHEN x IS NOT NULL THEN y END - avg(CASE WHEN x IS NOT NULL THEN y END) OVER (PARTITION BY date, industry) AS dy, CASE WHEN y IS NOT NULL THEN x END - avg(CASE WHEN y IS NOT NULL THEN x END) OVER (PARTITION BY date, industry) AS dx FROM (SELECT c.*, industry, CASE WHEN size > 0 THEN ln(size) END AS x FROM cleaned c JOIN ind USING (entity, date))))),
variants AS (SELECT entity, date, 'cleaned' AS variant, y AS value FROM cleaned WHERE y IS NOT NULL UNION ALL SELECT entity, date, 'neutral', y FROM neut WHERE y IS NOT NULL),
sic AS ({LONG_IC.format(keys="variant, horizon, date", source="SELECT variant, horizon, date, value, ret FROM variants JOIN fwd USING (entity, date)", least=2)}), way AS (SELECT variant, horizon, CASE WHEN avg(ic) < 0 THEN -1 ELSE 1 END AS direction FROM sic GROUP BY 1, 2)"""


@query(
    """SELECT variant, horizon, direction, count(ic) AS n_days, avg(ic * direction) AS ic_mean, stddev_pop(ic) AS ic_std, avg(ic * direction) / stddev_pop(ic) AS icir, avg(CASE WHEN ic * direction > 0 THEN 1.0 ELSE 0 END) AS pct_positive, avg(CASE WHEN abs(ic) > 0.02 THEN 1.0 ELSE 0 END) AS pct_abs_2, avg(CASE WHEN abs(ic) > 0.05 THEN 1.0 ELSE 0 END) AS pct_abs_5 FROM sic JOIN way USING (variant, horizon) WHERE ic IS NOT NULL GROUP BY 1, 2, 3""",
    "variant, horizon, direction, n_days", "ic_mean, ic_std, icir, pct_positive, pct_abs_2, pct_abs_5", PANEL_SQL + MASK_SQL + IND_SQL + FWD_SQL + CLEAN_SQL)
def factor_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """One call, cleaned and neutral side by side."""
    styles = industries(spark, d).select("entity", "date", "size", "industry")
    p = panel(spark, d)
    return ev.evaluate_factor(p.select("entity", "date", F.col("turnover").alias("x")), ev.masks(flags(spark, d)), p, styles, (1, 3), min_samples=10)


LONG_SQL = ", long AS (SELECT entity, date, 'close' AS factor, close AS value FROM panel UNION ALL SELECT entity, date, 'volume', volume FROM panel UNION ALL SELECT entity, date, 'range', high - low FROM panel)"


def long(spark: SparkSession, d: str) -> DataFrame:
    p = panel(spark, d).select("entity", "date", "close", "volume", (F.col("high") - F.col("low")).alias("range"))
    return p.unpivot(["entity", "date"], ["close", "volume", "range"], "factor", "value")


INV_SQL = f", fic AS ({LONG_IC.format(keys='factor, horizon, date', source='SELECT factor, horizon, date, value, ret FROM long JOIN fwd USING (entity, date) WHERE value IS NOT NULL AND ret IS NOT NULL', least=3)})"


@query("SELECT factor, horizon, count(ic) AS n_days, min(date) AS first_day, max(date) AS last_day, avg(ic) AS ic_mean, stddev_pop(ic) AS ic_std, avg(ic) / stddev_pop(ic) AS icir FROM fic GROUP BY 1, 2", "factor, horizon, n_days, first_day, last_day", "ic_mean, ic_std, icir", PANEL_SQL + LONG_SQL + FWD_SQL + INV_SQL)
def factor_inventory(spark: SparkSession, d: str) -> DataFrame:
    """All factors in one job."""
    return ev.inventory(long(spark, d), panel(spark, d), (1, 3))


def factor_ics(spark: SparkSession, d: str) -> DataFrame:
    on = long(spark, d).join(ev.forward_returns(panel(spark, d), [1]), ["entity", "date"])
    return ev.ic_series(on, "value", "ret", ["factor", "date"], True, 3)


@query("SELECT a.factor AS f1, b.factor AS f2, count(*) AS n, corr(a.ic, b.ic) AS rho FROM (SELECT * FROM fic WHERE horizon = 1 AND ic IS NOT NULL) a JOIN (SELECT * FROM fic WHERE horizon = 1 AND ic IS NOT NULL) b ON a.date = b.date AND a.factor < b.factor GROUP BY 1, 2", "f1, f2, n", "rho", PANEL_SQL + LONG_SQL + FWD_SQL + INV_SQL)
def ic_correlations(spark: SparkSession, d: str) -> DataFrame:
    """R10, E10, on coefficient series."""
    return ev.ic_correlation(factor_ics(spark, d))


@query("SELECT least(g1, g2) AS g1, greatest(g1, g2) AS g2, count(*) AS n_pairs, avg(rho) AS mean_rho FROM (SELECT CASE a.factor WHEN 'volume' THEN 'flow' ELSE 'price' END AS g1, CASE b.factor WHEN 'volume' THEN 'flow' ELSE 'price' END AS g2, sum(a.value * b.value) / sqrt(sum(a.value * a.value) * sum(b.value * b.value)) AS rho FROM long a JOIN long b ON a.entity = b.entity AND a.date = b.date AND a.factor < b.factor GROUP BY a.factor, b.factor) GROUP BY 1, 2", "g1, g2, n_pairs", "mean_rho", PANEL_SQL + LONG_SQL)
def correlation_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Uncentred correlations by blocks of groups."""
    groups = spark.createDataFrame([("close", "price"), ("range", "price"), ("volume", "flow")], "factor string, grp string")
    return ev.block_means(ev.factor_correlation(long(spark, d)), groups)


@query("SELECT cluster, factor, size, icir FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY abs(icir) DESC, factor) AS k, count(*) OVER (PARTITION BY cluster) AS size FROM (SELECT CASE factor WHEN 'volume' THEN 2 ELSE 1 END AS cluster, factor, avg(ic) / stddev_pop(ic) AS icir FROM fic WHERE horizon = 1 GROUP BY factor)) WHERE k = 1", "cluster, factor, size", "icir", PANEL_SQL + LONG_SQL + FWD_SQL + INV_SQL)
def cluster_representatives(spark: SparkSession, d: str) -> DataFrame:
    """The strongest factor of each cluster."""
    clusters = spark.createDataFrame([("close", 1), ("range", 1), ("volume", 2)], "factor string, cluster int")
    return ev.representatives(clusters, ev.inventory(long(spark, d), panel(spark, d), (1,)))


@query(f"SELECT 'gap' AS name, year(date) AS yr, count(*) AS n_rows, count(gap) AS n_present, 1 - count(gap) / count(*) AS missing FROM (SELECT date, CASE WHEN close > open THEN close END AS gap FROM panel) GROUP BY 2 UNION ALL SELECT 'close', year(date), count(*), count(close), 1 - count(close) / count(*) FROM panel GROUP BY 2", "name, yr, n_rows, n_present", "missing")
def column_coverage(spark: SparkSession, d: str) -> DataFrame:
    """A18."""
    df = panel(spark, d).withColumn("gap", F.when(F.col("close") > F.col("open"), F.col("close"))).withColumn("yr", F.year("date"))
    return ev.coverage(df, ["gap", "close"], ["yr"]).withColumnRenamed("column", "name")


@query(
    f"""SELECT entity, date, x / nullif(lag(x) {E_}, 0) - 1 AS plain, fx / nullif(lag(fx) {E_}, 0) - 1 AS padded, close / lag(close, 20) {E_} - 1 AS ret20, lead(close) {E_} / close - 1 AS next_month FROM (SELECT *, last_value(x IGNORE NULLS) OVER (PARTITION BY entity ORDER BY date ROWS UNBOUNDED PRECEDING) AS fx FROM (SELECT *, CASE WHEN close > open THEN close END AS x FROM panel))""",
    doubles="plain, padded, ret20, next_month")
def period_returns(spark: SparkSession, d: str) -> DataFrame:
    """W25 with and without fill, W26, W27."""
    p = panel(spark, d)
    df = p.withColumn("x", F.when(F.col("close") > F.col("open"), F.col("close")))
    df = steps.pct_change(steps.pct_change(steps.pct_change(df, "x", "plain"), "x", "padded", pad=True), "close", "ret20", 20)
    return df.join(ev.next_month_return(p).select("entity", "date", F.col("ret").alias("next_month")), ["entity", "date"])


@query(SQL["neutral_factor"].split("result AS (", 1)[1].rsplit(") SELECT", 1)[0].replace("SELECT entity, date, CASE", "SELECT * FROM (SELECT entity, date, CASE", 1) + ") WHERE neutral IS NOT NULL", doubles="neutral", ctes=PANEL_SQL + IND_SQL)
def monthly_neutral(spark: SparkSession, d: str) -> DataFrame:
    """R8."""
    return ev.monthly_neutral(industries(spark, d), "close", "size", "industry", 10)


# ---- joins, sets, shapes


@query("SELECT entity, date, avg(close) OVER (PARTITION BY date) AS market, avg(close) OVER (PARTITION BY date, industry) AS own FROM ind", doubles="market, own", ctes=PANEL_SQL + IND_SQL)
def index_lookups(spark: SparkSession, d: str) -> DataFrame:
    """A series by date, and the column that a row's key names."""
    df = industries(spark, d).withColumn("key", F.concat(F.lit("r"), F.col("industry").cast("string")))
    wide = df.groupBy("date").pivot("key", [f"r{k}" for k in range(5)]).agg(F.avg("close"))
    out = tables.lookup(df, wide, "key", "own", aliases={"region0": "r0"})
    return tables.by_date(out, df.groupBy("date").agg(F.avg("close").alias("market")))


@query("SELECT 'union' AS how, count(*) AS n, sum(entity) AS total FROM (SELECT entity, date FROM a UNION SELECT entity, date FROM b) UNION ALL SELECT 'intersection', count(*), sum(entity) FROM (SELECT entity, date FROM a INTERSECT SELECT entity, date FROM b) UNION ALL SELECT 'difference', count(*), sum(entity) FROM (SELECT entity, date FROM a EXCEPT SELECT entity, date FROM b)", "how, n", "total", PANEL_SQL + ", a AS (SELECT * FROM panel WHERE volume > 60), b AS (SELECT * FROM panel WHERE close > 30)")
def index_sets(spark: SparkSession, d: str) -> DataFrame:
    """U4, J11."""
    p = panel(spark, d)
    a, b = p.where("volume > 60"), p.where("close > 30")
    parts = [tables.index_of(a, b, how).agg(F.lit(how).alias("how"), F.count(F.lit(1)).alias("n"), F.sum("entity").alias("total")) for how in ("union", "intersection", "difference")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT entity, yr, arg_max(close, date) AS close FROM (SELECT *, year(date) AS yr FROM panel) GROUP BY 1, 2", "entity, yr", "close")
def last_of_year(spark: SparkSession, d: str) -> DataFrame:
    """U6."""
    return tables.last_value(panel(spark, d).withColumn("yr", F.year("date")), ["entity", "yr"], "close", "date")


@query("SELECT CAST(entity AS VARCHAR) AS entity, date, close AS value FROM panel", "entity, date", "value")
def wide_and_back(spark: SparkSession, d: str) -> DataFrame:
    """A column an entity of the panel, in blocks of columns."""
    p = panel(spark, d).select("entity", "date", "close")
    columns = tables.columns_of(p)
    return tables.melt_blocks(tables.pivot_blocks(p, "close", columns), columns)


@query("SELECT p.entity, p.date, e.f AS value FROM panel p ASOF JOIN (SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS date, max(sqrt(o_totalprice)) AS f FROM orders GROUP BY 1, 2) e ON p.entity = e.entity AND p.date >= e.date", doubles="value")
def daily_intervals(spark: SparkSession, d: str) -> DataFrame:
    """A custom fetch through a specification."""
    o = tables.read(spark, d, "orders").select(F.col("o_custkey").alias("entity"), F.to_date("o_orderdate").alias("date"), F.sqrt("o_totalprice").alias("value"))
    recipe = {"factor": {"name": "v", "column": "value"}, "calculation_steps": [{"action": "fetch", "api": "custom", "command": "intervals", "output_column": "value"}]}
    return spec.run(recipe, spec.Context({"daily": panel(spark, d), "intervals": o}))


@query("SELECT CAST(date AS DATE) AS date, place FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS place FROM (SELECT DISTINCT date FROM panel WHERE date >= DATE '1993-01-01' AND date <= DATE '1996-12-31'))", "date, place")
def trading_calendar(spark: SparkSession, d: str) -> DataFrame:
    """S19."""
    return tables.calendar(panel(spark, d), "1993-01-01", "1996-12-31")


@query("SELECT entity, date, close FROM panel JOIN (SELECT DISTINCT s_suppkey AS entity FROM supplier WHERE s_nationkey = 3) USING (entity) WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'", doubles="close")
def universe_fetch(spark: SparkSession, d: str) -> DataFrame:
    """Dates and universe."""
    members = tables.read(spark, d, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_nationkey").cast("string").alias("index_id"))
    recipe = {"factor": {"name": "c", "column": "close"}, "calculation_steps": [{"action": "fetch", "api": "get_factor", "fields": "close", "output_column": "close"}]}
    return spec.run(recipe, spec.Context({"daily": panel(spark, d)}, tables.universe(members, "3"), "1996-01-01", "1996-12-31"))


@query("SELECT entity, quarter, v AS value FROM (SELECT *, row_number() OVER (PARTITION BY entity, quarter ORDER BY info_date DESC) AS rn FROM fina WHERE quarter BETWEEN '1994q1' AND '1995q4') WHERE rn = 1", "entity, quarter", "value", PANEL_SQL + ", fina AS (SELECT entity, concat(CAST(year(date) AS VARCHAR), 'q', CAST(quarter(date) AS VARCHAR)) AS quarter, date AS info_date, close AS v FROM panel)")
def latest_quarters(spark: SparkSession, d: str) -> DataFrame:
    """S3: the last version of each quarter in a range."""
    q = F.concat(F.year("date").cast("string"), F.lit("q"), F.quarter("date").cast("string"))
    fina = panel(spark, d).select("entity", "date", q.alias("quarter"), F.col("date").alias("info_date"), F.col("close").alias("v"))
    ctx = spec.Context({"financials": fina})
    spec.fetch(ctx, {"action": "fetch", "api": "get_pit_financials_ex", "fields": ["v"], "output_column": "value", "keep": ["quarter"], "start_quarter": "1994q1", "end_quarter": "1995q4"})
    return ctx.frames["data"]


@query("SELECT entity, date, CASE WHEN gap IS NOT NULL THEN greatest(gap, low) END AS larger, CASE WHEN gap IS NOT NULL THEN least(gap, open) END AS smaller, CASE WHEN gap > 0 THEN ceil(gap) + floor(open) - sign(open - gap) END AS whole, CASE WHEN gap IS NOT NULL THEN least(greatest(gap, 25), 35) END AS clipped FROM (SELECT *, CASE WHEN close > open THEN close END AS gap FROM panel)", doubles="larger, smaller, whole, clipped")
def missing_values(spark: SparkSession, d: str) -> DataFrame:
    """P11, F1 with missing values."""
    df = panel(spark, d).withColumn("gap", F.when(F.col("close") > F.col("open"), F.col("close")))
    df = df.withColumn("larger", greater("gap", "low")).withColumn("smaller", less("gap", "open"))
    df = steps.compute(df, "ceil(gap) + floor(open) - sign(open - gap)", ["gap", "open"], "whole")
    return steps.compute(df, "clip(gap, 25, 35)", ["gap"], "clipped")


@query("SELECT entity, date, CASE extract(month FROM date) WHEN 1 THEN 'first' WHEN 12 THEN 'last' END AS name FROM panel", "entity, date, name", "")
def recoded(spark: SparkSession, d: str) -> DataFrame:
    """a map of keys to values."""
    return steps.recode(panel(spark, d).withColumn("m", F.month("date")), "m", {1: "first", 12: "last"}, "name")


@query(f"SELECT entity, date, close - mc - (CASE WHEN det > 1e-12 * aa * bb THEN (av * bb - bv * ab) / det * (lv - ml) + (bv * aa - av * ab) / det * (open - mo) END) AS residual FROM (SELECT *, aa * bb - ab * ab AS det FROM (SELECT *, avg(close) {D_} AS mc, avg(lv) {D_} AS ml, avg(open) {D_} AS mo, count(*) {D_} AS n, var_pop(lv) {D_} * count(*) {D_} AS aa, var_pop(open) {D_} * count(*) {D_} AS bb, covar_pop(lv, open) {D_} * count(*) {D_} AS ab, covar_pop(lv, close) {D_} * count(*) {D_} AS av, covar_pop(open, close) {D_} * count(*) {D_} AS bv FROM (SELECT *, ln(volume) AS lv FROM panel))) WHERE n >= 8", doubles="residual")
def cross_section_residual_2(spark: SparkSession, d: str) -> DataFrame:
    """R1 with two regressors, by sums of products."""
    df = panel(spark, d).select("entity", "date", "close", "open", F.log("volume").alias("lv"))
    return steps.cross_section_regress(df, "close", ["lv", "open"], "residual", min_samples=8).where("residual is not null")


@query(f"SELECT entity, date, CASE WHEN count(close) {frame(8)} >= 4 THEN covar_samp(close, volume) {frame(8)} END AS cov8, rank() OVER (PARTITION BY date ORDER BY close) / count(close) {D_} AS place FROM panel", doubles="cov8, place")
def covariance_and_place(spark: SparkSession, d: str) -> DataFrame:
    """W10, W15."""
    return panel(spark, d).select("entity", "date", pan.rolling_cov("close", "volume", 8).alias("cov8"), pan.cross_rank("close").alias("place"))


@query("SELECT 1 AS one, max(abs(close - low)) AS close FROM panel", "one", "close")
def verified_tables(spark: SparkSession, d: str) -> DataFrame:
    """S17."""
    p = panel(spark, d)
    return tables.verify(p.select("entity", "date", "close"), p.select("entity", "date", F.col("low").alias("close")), ["entity", "date"], ["close"]).withColumn("one", F.lit(1))


# ---- consensus

FORE_SQL = ", fore AS (SELECT *, year(date) - 1 - entity % 3 AS report_year, volume AS t1, volume * 1.1 + 5 AS t2, volume * 1.3 - 20 AS t3 FROM panel)"


def forecasts(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("volume")
    return panel(spark, d).withColumns({"report_year": F.year("date") - 1 - F.col("entity") % 3, "t1": v, "t2": v * 1.1 + 5, "t3": v * 1.3 - 20})


@query(
    """SELECT entity, date, CASE WHEN np > 0 THEN high * 1e8 / np END AS pe_fy1_new, fy1, CASE WHEN t1 + t2 + t3 <> 0 THEN (t1 + 2 * t2 + 3 * t3) / (t1 + t2 + t3) END AS years FROM (SELECT *, least(date_diff('day', date, make_date(year(date), 12, 31)) / 365.0, 1) * CASE year(date) - report_year WHEN 1 THEN t1 WHEN 2 THEN t2 WHEN 3 THEN t3 END + (1 - least(date_diff('day', date, make_date(year(date), 12, 31)) / 365.0, 1)) * CASE year(date) - report_year WHEN 0 THEN t1 WHEN 1 THEN t2 WHEN 2 THEN t3 END AS np, CASE WHEN f > 0 THEN f END AS fy1 FROM (SELECT *, CASE year(date) - report_year WHEN 1 THEN t1 WHEN 2 THEN t2 WHEN 3 THEN t3 END AS f FROM fore))""",
    doubles="pe_fy1_new, fy1, years", ctes=PANEL_SQL + FORE_SQL)
def forecast_multiples(spark: SparkSession, d: str) -> DataFrame:
    """C1, C2, C8."""
    args = tuple(F.col(c) for c in ("date", "report_year", "t1", "t2", "t3"))
    df = events.price_to_forecast(forecasts(spark, d), "high", events.forward_profit(*args), "pe_fy1_new")
    return df.withColumn("fy1", events.this_year_profit(*args)).withColumn("years", events.duration(*args[2:]))


@query(
    f"""SELECT entity, date, CASE WHEN a IS NOT NULL AND b IS NOT NULL AND count(CASE WHEN b IS NOT NULL THEN a END) {D_} >= 8 THEN a - regr_intercept(a, b) {D_} - regr_slope(a, b) {D_} * b END AS reg_pe_fy1 FROM (SELECT *, ln(close) - lag(ln(close), 12) {E_} AS a, ln(years) - lag(ln(years), 12) {E_} AS b FROM (SELECT *, (volume + 2 * turnover + 3 * open) / (volume + turnover + open) AS years FROM panel))""",
    doubles="reg_pe_fy1")
def duration_adjusted(spark: SparkSession, d: str) -> DataFrame:
    """C8, R7."""
    df = panel(spark, d).withColumn("years", events.duration(F.col("volume"), F.col("turnover"), F.col("open")))
    return events.duration_adjusted(df, "close", "years", "reg_pe_fy1", 12, 8)


@query(
    """SELECT d.entity, d.date, c.leads FROM (SELECT DISTINCT entity, date FROM rep) d ASOF JOIN cnt c ON d.entity = c.entity AND d.date >= c.date JOIN (SELECT entity, max(date) AS e FROM cnt GROUP BY 1) m ON m.entity = d.entity WHERE d.date <= m.e""",
    "entity, date, leads", ctes=ORDERS_SQL + ", cnt AS (SELECT e.entity, e.date, count(DISTINCT r.lead) AS leads FROM (SELECT entity, max(date) AS date FROM rep GROUP BY entity, date_trunc('month', date)) e JOIN rep r ON r.entity = e.entity AND r.date <= e.date AND r.date > e.date - 45 GROUP BY 1, 2)")
def filled_lead_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts at month ends, carried on."""
    r = reports(spark, d)
    return events.filled_counts(r.select("entity", "date").distinct(), r, 45)


@query(
    """SELECT d.entity, d.date, d.yr, CASE WHEN d.date - s.date < 120 THEN s.view END AS view FROM (SELECT DISTINCT entity, date, year(date) - CASE WHEN month(date) < 5 THEN 1 ELSE 0 END AS yr FROM rep) d ASOF JOIN (SELECT entity, year(date) AS yr, date, max(v) AS view FROM rep GROUP BY 1, 2, 3) s ON s.entity = d.entity AND s.yr = d.yr AND d.date >= s.date WHERE d.date - s.date < 120""",
    "entity, date, yr", "view", ORDERS_SQL)
def revision_panels(spark: SparkSession, d: str) -> DataFrame:
    """A fiscal year's views on the days on which it is the next to be reported, until they expire."""
    r = reports(spark, d)
    snaps = r.groupBy("entity", F.year("date").alias("year"), "date").agg(F.max("v").alias("view"))
    return events.revision_panel(r.select("entity", "date").distinct(), snaps, 120).withColumnRenamed("year", "yr")


@query(
    """SELECT entity, info_date, (actual - f) / nullif(abs(f), 0) AS surprise FROM (SELECT entity, info_date, actual, count(f) AS n, avg(f) AS f FROM (SELECT a.entity, a.info_date, a.actual, r.lead, arg_max(r.v, r.date) AS f FROM act a JOIN rep r ON r.entity = a.entity AND r.date < a.info_date AND r.date >= a.info_date - 90 GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3) WHERE n >= 3""",
    "entity, info_date", "surprise", ORDERS_SQL + ", act AS (SELECT entity, max(date) AS info_date, max(v) AS actual FROM rep GROUP BY entity, year(date))")
def forecast_surprise(spark: SparkSession, d: str) -> DataFrame:
    """C9."""
    r = reports(spark, d)
    actual = r.groupBy("entity", F.year("date").alias("_y")).agg(F.max("date").alias("info_date"), F.max("v").alias("actual"))
    return events.surprise(actual, r.withColumnRenamed("v", "forecast"))


@query("""SELECT cust AS id, lpad(regexp_extract(cust, '([0-9]+)', 1), 6, '0') AS code, trim(split_part(names, ',', 1)) AS lead FROM (SELECT concat('R', CAST(c_custkey AS VARCHAR), '-x') AS cust, CASE WHEN c_custkey % 5 = 0 THEN ' , b' ELSE concat(' ', c_mktsegment, ', b') END AS names FROM customer) WHERE trim(split_part(names, ',', 1)) <> ''""", "id, code, lead", "", "")
def cleaned_reports(spark: SparkSession, d: str) -> DataFrame:
    """C3, F3."""
    k = F.col("c_custkey").cast("string")
    c = tables.read(spark, d, "customer").select(F.concat(F.lit("R"), k, F.lit("-x")).alias("report_main_id"), F.when(F.col("c_custkey") % 5 == 0, " , b").otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(", b"))).alias("author"))
    return events.clean_reports(c).withColumnRenamed("report_main_id", "id")


# ---- whole reducers and families

KINDS = ("peak", "ridge", "valley")
GRID_SQL = MINUTES_SQL + ", grid AS (SELECT entity, date, minute, high, low, close, volume, turnover FROM (SELECT DISTINCT entity, date FROM minutes) CROSS JOIN (SELECT DISTINCT minute FROM minutes) LEFT JOIN minutes USING (entity, date, minute))"
_M = "OVER (PARTITION BY entity, date ORDER BY minute)"
KIND_COLS = [f"{k}_{x}" for k in KINDS for x in ("count", "volume", "turnover", "vwap")] + [f"{k}_interval_{x}" for k in KINDS[:2] for x in ("n", "m1", "m2", "m3", "m4")] + ["high", "low", "close", "vwap", "volume", "turnover"]
KIND_AGG = ", ".join(f"count(*) FILTER ({k}) AS {k}_count, sum(volume) FILTER ({k}) AS {k}_volume, sum(turnover) FILTER ({k}) AS {k}_turnover, sum(close * volume) FILTER ({k}) / nullif(sum(volume) FILTER ({k}), 0) AS {k}_vwap" for k in KINDS)
KIND_AGG += ", " + ", ".join(f"count({k}_g) AS {k}_interval_n, " + ", ".join(f"sum(pow({k}_g, {p})) AS {k}_interval_m{p}" for p in range(1, 5)) for k in KINDS[:2])
KIND_AGG += ", max(high) AS high, min(low) AS low, arg_max(close, minute) FILTER (close IS NOT NULL) AS close, sum(close * volume) / sum(volume) AS vwap, sum(volume) AS volume, sum(turnover) AS turnover"
GAPS = ", ".join(f"CASE WHEN {k} THEN minute - max(CASE WHEN {k} THEN minute END) OVER (PARTITION BY entity, date ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS {k}_g" for k in KINDS[:2])
WARM = "CASE WHEN row_number() OVER (PARTITION BY entity ORDER BY date) > 5 THEN {c} END AS {c}"

ERUPT = ["ridge_return_sum", "eruption_n", "eruption_x", "eruption_xx", "eruption_y", "eruption_yy", "eruption_xy"]
ERUPT_AGG = ", sum(r) FILTER (ridge) AS ridge_return_sum, count(turnover) FILTER (e) AS eruption_n, sum(turnover) FILTER (e) AS eruption_x, sum(turnover * turnover) FILTER (e) AS eruption_xx, sum(nx) FILTER (e) AS eruption_y, sum(nx * nx) FILTER (e) AS eruption_yy, sum(turnover * nx) FILTER (e) AS eruption_xy"
ERUPT_FLAGS = f"SELECT *, e AND NOT nr AS peak, e AND nr AS ridge, NOT e AND volume IS NOT NULL AS valley FROM (SELECT *, coalesce(lag(e) {_M}, false) OR coalesce(lead(e) {_M}, false) AS nr, close / lag(close) {_M} - 1 AS r, coalesce(lead(turnover) {_M}, 0) AS nx FROM (SELECT *, coalesce(volume > CASE WHEN count(volume) OVER w = 5 THEN avg(volume) OVER w + stddev_samp(volume) OVER w END, false) AS e FROM grid WINDOW w AS (PARTITION BY entity, minute ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)))"


@query(
    f"SELECT entity, date, {', '.join(WARM.format(c=c) for c in [*KIND_COLS, *ERUPT])} FROM (SELECT entity, date, {KIND_AGG}{ERUPT_AGG} FROM (SELECT *, {GAPS} FROM ({ERUPT_FLAGS})) GROUP BY 1, 2)",
    doubles=", ".join([*KIND_COLS, *ERUPT]), ctes=GRID_SQL)
def minute_peaks_all(spark: SparkSession, d: str) -> DataFrame:
    """M1: all columns but the pooled one, A9."""
    return minute.peak_ridge_valley(minutes(spark, d), 5)


@query(
    f"SELECT entity, date, CASE WHEN row_number() OVER (PARTITION BY entity ORDER BY date) > 5 THEN c END AS pooled FROM (SELECT entity, date, CASE WHEN var_pop(p) > 0 AND var_pop(q) > 0 THEN covar_pop(p, q) / sqrt(var_pop(p) * var_pop(q)) END AS c FROM (SELECT entity, date, sum(CAST(peak AS INTEGER)) OVER w AS p, sum(CAST(ridge AS INTEGER)) OVER w AS q FROM ({ERUPT_FLAGS}) WINDOW w AS (PARTITION BY entity, minute ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)) GROUP BY 1, 2)",
    doubles="pooled", ctes=GRID_SQL)
def minute_pooled_counts(spark: SparkSession, d: str) -> DataFrame:
    """Peaks and ridges of the days before, over minutes of the day."""
    return minute.peak_ridge_valley(minutes(spark, d), 5).withColumnRenamed("peakridge_minute_corr_pooled", "pooled")


JUMP_FLAGS = f"""SELECT *, j AND NOT hot AND NOT gap AS peak, j AND NOT cold AND gap AS ridge, NOT jump AND volume IS NOT NULL AS valley FROM (SELECT *, jump AND lag(minute) {_M} IS NOT NULL AND lead(minute) {_M} IS NOT NULL AS j, coalesce(lag(hi) {_M}, false) AND coalesce(lead(hi) {_M}, false) AS hot, NOT coalesce(lag(hi) {_M}, false) AND NOT coalesce(lead(hi) {_M}, false) AS cold, coalesce(lag(high) {_M} < lead(low) {_M}, false) OR coalesce(lead(high) {_M} < lag(low) {_M}, false) AS gap FROM (
SELECT *, coalesce(a > thr, false) AS jump, coalesce(a >= thr, false) AS hi FROM (SELECT *, CASE WHEN count(a) OVER w = 5 THEN avg(a) OVER w + stddev_samp(a) OVER w END AS thr FROM (SELECT *, CASE WHEN close > 0 THEN (high - low) / close END AS a FROM grid) WINDOW w AS (PARTITION BY entity, minute ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))))"""


@query(
    f"SELECT entity, date, {', '.join(WARM.format(c=c) for c in KIND_COLS)} FROM (SELECT entity, date, {KIND_AGG} FROM (SELECT *, {GAPS} FROM ({JUMP_FLAGS})) GROUP BY 1, 2)",
    doubles=", ".join(KIND_COLS), ctes=GRID_SQL)
def minute_price_jumps(spark: SparkSession, d: str) -> DataFrame:
    """M2: kinds, intervals and the day."""
    return minute.price_jump(minutes(spark, d), 5).select("entity", "date", *KIND_COLS)


JUMP_COLS = ["ridge_return_sum", "jump_count", "jump_turnover_sum", "jump_turnover_sumsq", "jump_next_turnover_sum", "jump_next_turnover_sumsq", "jump_xy_sum"]
JUMP_AGG = "coalesce(sum(r) FILTER (ridge), 0) AS ridge_return_sum, count(*) FILTER (jump) AS jump_count, coalesce(sum(turnover) FILTER (jump), 0) AS jump_turnover_sum, coalesce(sum(turnover * turnover) FILTER (jump), 0) AS jump_turnover_sumsq, coalesce(sum(nx) FILTER (jump), 0) AS jump_next_turnover_sum, coalesce(sum(nx * nx) FILTER (jump), 0) AS jump_next_turnover_sumsq, coalesce(sum(turnover * nx) FILTER (jump), 0) AS jump_xy_sum"
JUMP_POOL = "SELECT entity, date, CASE WHEN var_pop(p) > 0 AND var_pop(q) > 0 THEN covar_pop(p, q) / sqrt(var_pop(p) * var_pop(q)) END AS pooled FROM (SELECT entity, date, sum(CAST(peak AS INTEGER)) OVER w AS p, sum(CAST(ridge AS INTEGER)) OVER w AS q FROM jf WINDOW w AS (PARTITION BY entity, minute ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)) GROUP BY 1, 2"


@query(
    f"SELECT entity, date, {', '.join(WARM.format(c=c) for c in [*JUMP_COLS, 'pooled'])} FROM (SELECT entity, date, {JUMP_AGG} FROM (SELECT *, close / lag(close) {_M} - 1 AS r, coalesce(lead(turnover) {_M}, 0) AS nx FROM jf) GROUP BY 1, 2) LEFT JOIN ({JUMP_POOL}) USING (entity, date)",
    doubles=", ".join([*JUMP_COLS, "pooled"]), ctes=GRID_SQL + f", jf AS ({JUMP_FLAGS})")
def minute_jump_moments(spark: SparkSession, d: str) -> DataFrame:
    """M2: jumps, what follows them, returns on ridges, pooled counts; by the names that specifications use."""
    out = minute.reduce_minutes(minutes(spark, d), "minute_pricejump_aggregate", [*JUMP_COLS, "peakridge_minute_corr_pooled"], std_window=5)
    return out.withColumnRenamed("peakridge_minute_corr_pooled", "pooled")


@query(
    f"""SELECT entity, date, CASE WHEN ok THEN CASE WHEN mm.v <= nn.v THEN rise ELSE ebb END END AS tide_strong, CASE WHEN ok THEN CASE WHEN mm.v <= nn.v THEN ebb ELSE rise END END AS tide_weak FROM (SELECT *, n >= 10 AND mm IS NOT NULL AND nn IS NOT NULL AS ok, (ct - mm.c) / mm.c / (t - mm.p) AS rise, (nn.c - ct) / ct / (nn.p - t) AS ebb FROM (
SELECT entity, date, max(n) AS n, max(t) AS t, max(CASE WHEN pos = t THEN close END) AS ct, min(CASE WHEN pos < t THEN {{'v': nb, 'p': pos, 'c': close}} END) AS mm, min(CASE WHEN pos > t THEN {{'v': nb, 'p': pos, 'c': close}} END) AS nn FROM (SELECT *, -(max({{'v': nb, 'p': -pos}}) OVER (PARTITION BY entity, date)).p AS t FROM (SELECT *, row_number() {_M} AS pos, count(*) OVER (PARTITION BY entity, date) AS n, sum(volume) OVER (PARTITION BY entity, date ORDER BY minute ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS nb FROM minutes WHERE minute BETWEEN 1 AND 21)) GROUP BY 1, 2))""",
    doubles="tide_strong, tide_weak", ctes=MINUTES_SQL)
def minute_tide_sides(spark: SparkSession, d: str) -> DataFrame:
    """M3: the other two."""
    return minute.tide(minutes(spark, d), 2, 1, 2, 10)


CO_SQL = "SELECT entity, date, {expr} AS x FROM (SELECT entity, date, list_sort(list({{'k': {key}, 'p': p, 's': signal}}) OVER w) AS l, count({key}) OVER w AS n FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY date) AS p FROM (SELECT entity, date, turnover, ret, avg(ret) OVER (PARTITION BY date) AS signal FROM (SELECT entity, date, turnover, close / lag(close) OVER (PARTITION BY entity ORDER BY date) - 1 AS ret FROM panel))) WINDOW w AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) WHERE n = 10"
TOP, BOTTOM = "list_sum(list_transform(range(3), lambda i: pow(2, -i / 2.0) * l[10 - i].s))", "list_sum(list_transform(range(7), lambda i: pow(2, -i / 6.0) * l[i + 1].s))"
CO_KEY = "ret * turnover"


@query(
    f"SELECT a.entity, a.date, a.x AS vicm, b.x AS vicr, c.x AS cmc FROM ({CO_SQL.format(expr=TOP, key=CO_KEY)}) a JOIN ({CO_SQL.format(expr=BOTTOM, key=CO_KEY)}) b USING (entity, date) JOIN ({CO_SQL.format(expr=f'{TOP} - {BOTTOM}', key=CO_KEY)}) c USING (entity, date)",
    doubles="vicm, vicr, cmc")
def co_momentum_all(spark: SparkSession, d: str) -> DataFrame:
    """The three that are ranked by return times turnover, through specifications that start with the action."""
    w = Window.partitionBy("entity").orderBy("date")
    r = panel(spark, d).select("entity", "date", (F.col("close") / F.lag("close").over(w) - 1).alias("ret"), F.col("turnover").alias("amount"))
    ctx = {"returns": r, "market": r.groupBy("date").agg(F.avg("ret").alias("signal"))}
    out = None
    for sub in ("VICM", "VICR", "CMC"):
        one = {"factor": {"name": sub, "column": sub.lower()}, "calculation_steps": [{"action": "industry_co_momentum", "sub_factor": sub, "signal_source": "market", "window": 10, "n_mom": 3, "n_rev": 7, "output_column": sub.lower()}]}
        made_ = spec.run(one, spec.Context(ctx))
        out = made_ if out is None else out.join(made_, ["entity", "date"])
    return out.where("vicm is not null")


@query("SELECT a.factor AS f1, b.factor AS f2, count(*) AS n, sum(a.value * b.value) / sqrt(sum(a.value * a.value) * sum(b.value * b.value)) AS rho FROM long a JOIN long b ON a.entity = b.entity AND a.date = b.date AND a.factor < b.factor GROUP BY 1, 2", "f1, f2, n", "rho", PANEL_SQL + LONG_SQL)
def uncentred_correlations(spark: SparkSession, d: str) -> DataFrame:
    """R9."""
    return ev.factor_correlation(long(spark, d))


@query(
    """SELECT entity, date, segment, label, (close - m.c) / nullif(s.c, 0) AS close, (volume - m.v) / nullif(s.v, 0) AS volume FROM seg, (SELECT quantile_cont(close, 0.5) AS c, quantile_cont(volume, 0.5) AS v FROM seg WHERE segment = 'train') m, (SELECT 1.4826 * quantile_cont(abs(close - (SELECT quantile_cont(close, 0.5) FROM seg WHERE segment = 'train')), 0.5) AS c, 1.4826 * quantile_cont(abs(volume - (SELECT quantile_cont(volume, 0.5) FROM seg WHERE segment = 'train')), 0.5) AS v FROM seg WHERE segment = 'train') s""",
    "entity, date, segment", "label, close, volume", PANEL_SQL + MASK_SQL + f", seg AS (SELECT entity, date, close, volume, r AS label, CASE WHEN date <= DATE '1995-12-31' THEN 'train' WHEN date > DATE '1996-01-31' AND date <= DATE '1996-12-31' THEN 'valid' WHEN date > DATE '1997-01-31' THEN 'test' END AS segment FROM (SELECT *, lead(close, 2) {E_} / lead(close, 1) {E_} - 1 AS r FROM panel) JOIN mask USING (entity, date) WHERE pre AND r IS NOT NULL)")
def learning_dataset(spark: SparkSession, d: str) -> DataFrame:
    """Usable cells with a label, features scaled on the training segment."""
    p = panel(spark, d)
    label = ev.forward_returns(p, [1]).select("entity", "date", F.col("ret").alias("label"))
    return learning.build_dataset(long(spark, d), ev.masks(flags(spark, d)), label, ["close", "volume"], "1995-12-31", "1996-12-31")


@query(doubles="score")
def boosted_scores(spark: SparkSession, d: str) -> DataFrame:
    """Trees trained on one segment, live scores of all usable cells; rows only (trees have no twin)."""
    data = stored(learning_dataset(spark, d), "dataset")
    features = ["close", "volume"]
    model = learning.train_boosted(data, features, rounds=10)
    raw = long(spark, d)
    wide = raw.where(F.col("date") <= F.lit("1995-12-31").cast("date")).groupBy("entity", "date").pivot("factor", features).agg(F.max("value"))
    return learning.predict_live(model, learning.scaler_table(wide, features), raw, ev.masks(flags(spark, d)), features, "1997-01-01")


@query(keys="feature, n", doubles="mean_abs, skew, q05, q50, q95, rank_corr")
def attribution_report(spark: SparkSession, d: str) -> DataFrame:
    """What each feature adds to the trees' predictions; no SQL (trees)."""
    data, features = stored(learning_dataset(spark, d), "dataset"), ["close", "volume"]
    model = learning.train_boosted(data, features, rounds=5)
    attributed = attribution.attributions(model, data, features, shared_dir(spark))
    return attribution.attribution_statistics(stored(attributed, "shap"), data, features)


@query(keys="cluster, factor, size", doubles="icir")
def clustered_factors(spark: SparkSession, d: str) -> DataFrame:
    """From the factors of one width to clusters to each cluster's strongest; no SQL (a dendrogram)."""
    names = [f"{n}5" for n in pan.FAMILIES]
    # Two jobs read the bars; the factors, many times their size, are made in each and stay beside each other.
    bars = stored(panel(spark, d).select("entity", "date", *BARS), "bars").withColumn("ret", ev.ahead(1))
    every = pan.all_factors(bars, (5,), names, keep=("ret",))
    found = ev.clusters(ev.wide_correlation(every, names), names)
    return ev.representatives(found, ev.wide_inventory(every, names, {1: "ret"}))


@query("SELECT entity, date, volume * open AS money FROM panel WHERE close > 0 AND volume > 0 OR open > 1000", doubles="money", ctes=PANEL_SQL)
def merged_frames(spark: SparkSession, d: str) -> DataFrame:
    """Two frames merged, a panel loaded, a filter with words."""
    p = panel(spark, d)
    fetch = {"action": "fetch", "api": "get_factor"}
    todo = [
        fetch | {"fields": "close", "output_column": "close"},
        fetch | {"fields": "volume", "output_column": "volume", "output_dataframe": "other"},
        {"action": "merge", "target_dataframe": "data", "source_dataframe": "other", "on": ["entity", "date"], "columns": ["volume"]},
        {"action": "load_panel", "panel_config": "opens", "output_column": "open"},
        {"action": "filter", "condition": "close > 0 and volume > 0 or open > 1000"},
        {"action": "compute", "formula": "volume * open", "source_columns": ["volume", "open"], "output_column": "money"},
    ]
    recipe = {"factor": {"name": "m", "column": "money"}, "calculation_steps": todo}
    return spec.run(recipe, spec.Context({"daily": p, "opens": p.select("entity", "date", F.col("open").alias("value"))}))


@query("SELECT 1 AS one, min(d) AS last_day FROM (SELECT factor, max(date) AS d FROM long GROUP BY factor)", "one, last_day", "", PANEL_SQL + LONG_SQL)
def common_last_day(spark: SparkSession, d: str) -> DataFrame:
    """The day to which live scores go."""
    return learning.common_last_day(long(spark, d), ["close", "volume", "range"]).withColumn("one", F.lit(1))


# ---- the factor families at their other widths


def widths(w: int) -> dict[str, str]:
    f = frame(w)
    return {
        "roc": f"lag(close, {w}) {E_} / close", "ma": f"avg(close) {f} / close", "std": f"stddev_samp(close) {f} / close", "max": f"max(high) {f} / close", "min": f"min(low) {f} / close",
        "qtlu": f"quantile_cont(close, 0.8) {f} / close", "qtld": f"quantile_cont(close, 0.2) {f} / close", "rsv": f"(close - min(low) {f}) / (max(high) {f} - min(low) {f} + 1e-12)",
        "beta": f"CASE WHEN count(close) {f} = {w} THEN regr_slope(close, x) {f} / close END", "rsqr": f"CASE WHEN count(close) {f} = {w} THEN pow(covar_pop(close, x) {f}, 2) / (var_pop(x) {f} * var_pop(close) {f}) END", "resi": f"CASE WHEN count(close) {f} = {w} THEN (close - avg(close) {f} - regr_slope(close, x) {f} * {(w - 1) / 2}) / close END",
        "rank": f"CASE WHEN count(*) {f} = {w} THEN len(list_filter(list(close) {f}, lambda y: y < close)) / {w - 1.0} END",
        "imax": f"list_position(list(high) {f}, max(high) {f}) / {float(w)}", "imin": f"list_position(list(low) {f}, min(low) {f}) / {float(w)}", "imxd": f"list_position(list(high) {f}, max(high) {f}) / {float(w)} - list_position(list(low) {f}, min(low) {f}) / {float(w)}",
        "corr": f"CASE WHEN count(close) {f} >= {max(2, w // 2)} THEN corr(close, lv) {f} END", "cord": f"CASE WHEN count(cr) {f} >= {max(2, w // 2)} THEN corr(cr, lvr) {f} END",
        "cntp": f"avg(up) {f}", "cntn": f"avg(dn) {f}", "cntd": f"avg(up) {f} - avg(dn) {f}",
        "sump": f"sum(greatest(dc, 0)) {f} / (sum(abs(dc)) {f} + 1e-12)", "sumn": f"sum(greatest(-dc, 0)) {f} / (sum(abs(dc)) {f} + 1e-12)", "sumd": f"(sum(greatest(dc, 0)) {f} - sum(greatest(-dc, 0)) {f}) / (sum(abs(dc)) {f} + 1e-12)",
        "vma": f"avg(volume) {f} / (volume + 1e-12)", "vstd": f"stddev_samp(volume) {f} / (volume + 1e-12)", "wvma": f"stddev_samp(rv) {f} / (avg(rv) {f} + 1e-12)",
        "vsump": f"sum(greatest(dv, 0)) {f} / (sum(abs(dv)) {f} + 1e-12)", "vsumn": f"sum(greatest(-dv, 0)) {f} / (sum(abs(dv)) {f} + 1e-12)", "vsumd": f"(sum(greatest(dv, 0)) {f} - sum(greatest(-dv, 0)) {f}) / (sum(abs(dv)) {f} + 1e-12)",
    }


PREPARED_SQL = f"SELECT *, CAST(row_number() {E_} AS DOUBLE) AS x, ln(volume + 1) AS lv, close / lag(close) {E_} AS cr, ln(volume / lag(volume) {E_} + 1) AS lvr, CASE WHEN lag(close) {E_} IS NOT NULL THEN close - lag(close) {E_} END AS dc, CASE WHEN lag(volume) {E_} IS NOT NULL THEN volume - lag(volume) {E_} END AS dv, CASE WHEN close > lag(close) {E_} THEN 1 ELSE 0 END AS up, CASE WHEN close < lag(close) {E_} THEN 1 ELSE 0 END AS dn, abs(close / lag(close) {E_} - 1) * volume AS rv FROM panel"


def family(w: int) -> None:
    names = [f"{n}{w}" for n in pan.FAMILIES]

    def run(spark: SparkSession, d: str) -> DataFrame:
        """2.14 at one width."""
        return pan.all_factors(panel(spark, d).withColumn("vwap", F.col("close")), (w,), names)

    run.__name__ = f"factors_of_width_{w}"
    query("SELECT entity, date, " + ", ".join(f"{e} AS {n}{w}" for n, e in widths(w).items()) + f" FROM ({PREPARED_SQL})", doubles=", ".join(names))(run)


for _w in pan.WINDOWS:
    family(_w)

__all__ = ["QUERIES", "SMALL"]
