"""Masks, cleaning, neutralisation, forward returns, information coefficients, layered back-tests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.expr import clean, div, ln
from ..functions.windows import rank, series, zscore
from .steps import winsorize


def grid(df: DataFrame, entity: str = "entity", date: str = "date") -> DataFrame:
    """All dates for all entities of df; both are dimension-sized."""
    return df.select(date).distinct().crossJoin(df.select(entity).distinct())


def masks(flags: DataFrame) -> DataFrame:
    """pre: usable on the next day's flags; post: not at its limit. Flags are read one calendar day ahead.

    A day on which an entity has no row has no flags; neither has the day after the last.
    """
    names = ("is_st", "is_suspended", "is_new_stock", "is_limit_up")
    days = flags.select("date").distinct()
    # The calendar: one row a date.
    before = days.withColumn("_before", F.lag("date").over(Window.orderBy("date")))
    ahead = flags.join(F.broadcast(before), "date").select("entity", F.col("_before").alias("date"), *(F.coalesce(F.col(c), F.lit(False)).alias(f"_{c}") for c in names))
    df = flags.select("entity", "date").join(ahead, ["entity", "date"], "left")
    st, suspended, new, limit = (F.coalesce(F.col(f"_{c}"), F.lit(False)) for c in names)
    return df.select("entity", "date", (~(st | suspended | new)).alias("pre"), (~limit).alias("post"))


def prepare_factor(factor: DataFrame, mask: DataFrame, source: str = "x", output: str = "cleaned", n: float = 3.0) -> DataFrame:
    """Clean, pre-mask, clip by MAD, standardise (population), post-mask; all by date over one exchange."""
    df = mask.join(factor, ["entity", "date"], "left")
    df = df.withColumn("_x", F.when(F.coalesce("pre", F.lit(False)), clean(source)))
    df = winsorize(df, "_x", "_w", ["date"], n)
    df = df.withColumn("_z", zscore("_w", ["date"], ddof=0))
    return df.withColumn(output, F.when(F.coalesce("post", F.lit(True)), F.col("_z"))).drop("_x", "_w", "_z")


def neutralize(df: DataFrame, y: str, size: str, industry: str, output: str = "neutral", min_samples: int = 30, re_zscore: bool = False) -> DataFrame:
    """Residual of y on industry dummies and log size: both demeaned within (date, industry), then one slope a date."""
    x = ln(size)
    ok = F.col(y).isNotNull() & x.isNotNull() & F.col(industry).isNotNull()
    df = df.withColumn("_y", F.when(ok, F.col(y))).withColumn("_x", F.when(ok, x))
    # By date, then industry: the exchange by date serves both levels.
    inner = Window.partitionBy("date", industry)
    day = Window.partitionBy("date")
    df = df.withColumn("_dy", F.col("_y") - F.avg("_y").over(inner)).withColumn("_dx", F.col("_x") - F.avg("_x").over(inner))
    n, groups = F.count("_y").over(day), F.size(F.collect_set(F.when(ok, F.col(industry))).over(day))
    beta = F.coalesce(div(F.sum(F.col("_dx") * F.col("_dy")).over(day), F.sum(F.col("_dx") * F.col("_dx")).over(day)), F.lit(0.0))
    df = df.withColumn(output, F.when(ok & (n >= F.greatest(groups + 2, F.lit(min_samples))), F.col("_dy") - beta * F.col("_dx")))
    df = df.withColumn(output, zscore(output, ["date"], 0)) if re_zscore else df
    return df.drop("_y", "_x", "_dy", "_dx")


def ahead(horizon: int, price: str = "close") -> Column:
    w = series()
    return div(F.lead(price, horizon + 1).over(w), F.lead(price, 1).over(w)) - 1


def forward_returns(prices: DataFrame, horizons: list[int], price: str = "close") -> DataFrame:
    """Long: entity, date, horizon, ret = p[t + 1 + h] / p[t + 1] - 1."""
    each = F.array(*(F.struct(F.lit(h).alias("horizon"), ahead(h, price).alias("ret")) for h in horizons))
    return prices.select("entity", "date", each.alias("r")).select("entity", "date", F.inline("r"))


def ic_series(df: DataFrame, factor: str, ret: str, groups: list[str], joint: bool = False, least: int = 2) -> DataFrame:
    """Rank correlation per group. Ranks are of each side's own values, or (joint) of those where both are there.

    Twice an average rank is whole, so the moments are whole numbers and a coefficient of 0 is 0.
    """
    ok = F.col(factor).isNotNull() & F.col(ret).isNotNull()
    a, b = (F.when(ok, F.col(factor)), F.when(ok, F.col(ret))) if joint else (F.col(factor), F.col(ret))
    ranked = df.withColumn("_fv", a).withColumn("_rv", b)
    twice = lambda c: (rank(c, groups) * 2).cast("long")
    ranked = ranked.select(*groups, twice("_fv").alias("_a"), twice("_rv").alias("_b")).where("_a is not null and _b is not null")
    total = lambda c: F.sum(c).cast("decimal(19,0)")
    x, y = F.col("_a"), F.col("_b")
    out = ranked.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), total(x).alias("_x"), total(y).alias("_y"), total(x * x).alias("_xx"), total(y * y).alias("_yy"), total(x * y).alias("_xy"))
    n = F.col("n").cast("decimal(18,0)")
    centred = lambda xy, u, v: n * F.col(xy) - F.col(u) * F.col(v)
    xx, yy, xy = centred("_xx", "_x", "_x"), centred("_yy", "_y", "_y"), centred("_xy", "_x", "_y")
    ic = F.when((xx > 0) & (yy > 0), xy.cast("double") / F.sqrt(xx.cast("double") * yy.cast("double")))
    return out.where(F.col("n") >= least).select(*groups, "n", ic.alias("ic"))


def wide_ic_series(wide: DataFrame, factors: list[str], rets: dict[int, str], least: int = 2, at_once: int = 16) -> DataFrame:
    """factor, horizon, date, n, ic: joint `ic_series` by date of many factors that stand beside each other; rets: the returns' columns by horizon.

    A value crosses one exchange once, with the returns once for `at_once` factors, where rows of one factor each cross one for every rank
    and join. A group is a date's cross-section of so many factors, 8 bytes a value; ranks are numpy's. Keys that are NULL
    join with nothing, so such rows have no coefficient.
    """
    most = -(-len(factors) // -(-len(factors) // at_once))  # in parts of about one length
    parts, none = [factors[k : k + most] for k in range(0, len(factors), most)], F.lit(None).cast("double")
    each = F.array(*(F.struct(F.lit(k).alias("part"), *((F.col(part[i]).cast("double") if i < len(part) else none).alias(f"x{i}") for i in range(most))) for k, part in enumerate(parts)))
    there = wide.where(F.col("entity").isNotNull() & F.col("date").isNotNull() & F.coalesce(*rets.values()).isNotNull())
    split = there.select("date", *(F.col(c).cast("double").alias(f"r{h}") for h, c in rets.items()), F.inline(each))

    def twice(v: np.ndarray) -> np.ndarray:
        """Twice the average rank less its mean: whole numbers that sum up to 0. NaN is equal to NaN and above all."""
        order = np.argsort(v)
        s = v[order]
        starts = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) & ~np.isnan(s[:-1])]))
        times = np.diff(np.append(starts, len(s)))
        out = np.empty(len(s), np.int64)
        out[order] = np.repeat(2 * starts + times - len(s), times)
        return out

    def coefficients(key: tuple, rows: pa.Table) -> pa.Table:
        there = {c: rows[c].is_valid().to_numpy() for c in rows.column_names}
        value = lambda c: rows[c].fill_null(0.0).to_numpy()
        # Products in pieces that 64 bits hold; their sums are Python's whole numbers.
        total = lambda a, b: sum(int(a[k : k + 16384] @ b[k : k + 16384]) for k in range(0, len(a), 16384))
        made = []
        for i, name in enumerate(parts[key[1].as_py()]):
            x = value(f"x{i}")
            for h in rets:
                ok = there[f"x{i}"] & there[f"r{h}"]
                n = int(ok.sum())
                if n >= max(least, 1):
                    a, b = twice(x[ok]), twice(value(f"r{h}")[ok])
                    xx, yy, xy = n * total(a, a), n * total(b, b), n * total(a, b)
                    made.append((name, h, key[0].as_py(), n, float(xy) / float(np.sqrt(float(xx) * float(yy))) if xx and yy else None))
        return pa.Table.from_pylist([dict(zip(arrow.names, x, strict=True)) for x in made], arrow)

    schema = StructType().add("factor", "string").add("horizon", "integer").add(wide.schema["date"]).add("n", "long").add("ic", "double")
    arrow = to_arrow_schema(schema)
    return split.groupBy("date", "part").applyInArrow(coefficients, schema)


def ic_summary(ics: DataFrame, groups: list[str]) -> DataFrame:
    """Mean, deviation (population), ratio, t, shares, and bias-corrected skewness and excess kurtosis."""
    x, n = F.col("ic"), F.col("n_days")
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    s = ics.where(x.isNotNull()).groupBy(*groups).agg(F.count(x).alias("n_days"), F.avg(x).alias("ic_mean"), F.stddev_pop(x).alias("ic_std"), share(x > 0).alias("pct_positive"), share(F.abs(x) > 0.02).alias("pct_abs_2"), share(F.abs(x) > 0.05).alias("pct_abs_5"), F.skewness(x).alias("_g1"), F.kurtosis(x).alias("_g2"))
    icir = div("ic_mean", "ic_std")
    skew = F.when(n > 2, F.col("_g1") * F.sqrt((n * (n - 1)).cast("double")) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)).cast("double") * ((n + 1) * F.col("_g2") + 6))
    return s.select(*groups, "n_days", "ic_mean", "ic_std", icir.alias("icir"), (icir * F.sqrt(n.cast("double"))).alias("ic_t"), "pct_positive", "pct_abs_2", "pct_abs_5", skew.alias("ic_skew"), kurt.alias("ic_kurt"))


def layers(df: DataFrame, factor: str, ret: str, every: int = 5, groups: int = 5) -> DataFrame:
    """Every `every`-th date is ranked into groups that are held until the next: date, layer, mean return, members."""
    dates = df.select("date").distinct()
    # One row a date: the calendar is dimension-sized.
    dates = dates.withColumn("_day", F.row_number().over(Window.orderBy("date")) - 1).withColumn("_period", F.floor(F.col("_day") / every))
    on = df.join(dates, "date")
    formed = on.where(F.col("_day") % every == 0).withColumn("_pct", rank(factor, ["date"], method="first", pct=True, tie=["entity"]))
    formed = formed.select("_period", "entity", F.least(F.greatest(F.ceil(F.col("_pct") * groups) - 1, F.lit(0)), F.lit(groups - 1)).cast("int").alias("layer")).where("layer is not null")
    return on.join(formed, ["_period", "entity"]).groupBy("date", "layer").agg(F.avg(ret).alias("ret"), F.count(ret).alias("members"))


def layer_stats(held: DataFrame, groups: int = 5, year: int = 252) -> DataFrame:
    """Per layer, and for the top less the bottom (layer -1): total and annual return, volatility, Sharpe."""
    spread = held.where(F.col("layer").isin(0, groups - 1)).groupBy("date").agg((F.max(F.when(F.col("layer") == groups - 1, F.col("ret"))) - F.max(F.when(F.col("layer") == 0, F.col("ret")))).alias("ret")).select("date", F.lit(-1).alias("layer"), "ret")
    every = held.select("date", "layer", "ret").unionByName(spread)
    r = F.coalesce("ret", F.lit(0.0))
    s = every.groupBy("layer").agg(F.count(F.lit(1)).alias("days"), F.product(1 + r).alias("nav"), (F.stddev_pop(r) * float(np.sqrt(year))).alias("vol"), (F.avg(r) * year).alias("mean_ann"))
    ann = F.when(F.col("nav") > 0, F.pow("nav", F.lit(float(year)) / F.col("days")) - 1)
    return s.select("layer", "days", (F.col("nav") - 1).alias("total_return"), ann.alias("ann_return"), "vol", div(ann, F.col("vol")).alias("sharpe"))


def turnover(df: DataFrame, layer: str, period: str) -> DataFrame:
    """Share of each layer's members that weren't in it a period before."""
    before = df.select("entity", F.col(layer).alias("_l"), (F.col(period) + 1).alias("_p"))
    on = df.join(before, (df["entity"] == before["entity"]) & (df[layer] == before["_l"]) & (df[period] == before["_p"]), "left")
    return on.groupBy(period, layer).agg(F.count(F.lit(1)).alias("members"), F.avg(F.when(F.col("_p").isNull(), 1.0).otherwise(0.0)).alias("turnover"))


def factor_correlation(long: DataFrame, centred: bool = False, names: list[str] | None = None) -> DataFrame:
    """rho of all pairs of factors (f1 < f2) over cells where both are present; centred: Pearson.

    One exchange makes a row a cell; tasks multiply their cells' matrix by itself and send sums of products only,
    a row a pair of factors. names: the factors, a few hundred; looked up where they aren't given.
    """
    there = long.where(F.col("value").isNotNull())
    names = sorted(names or [r.factor for r in there.select("factor").distinct().collect()])
    return wide_correlation(there.groupBy("entity", "date").pivot("factor", names).agg(F.first("value")), names, centred)


def wide_correlation(cells: DataFrame, names: list[str], centred: bool = False) -> DataFrame:
    """`factor_correlation` of columns that stand beside each other, a row a cell: nothing is exchanged but sums."""
    names = sorted(names)
    wide = cells.select(*(F.col(f"`{n}`").cast("double").alias(f"c{k}") for k, n in enumerate(names)))
    columns = ["n", "sx", "sy", "sxx", "syy", "sxy"]

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        i, j = np.triu_indices(len(names), 1)
        total = np.zeros((len(columns), len(i)))
        for b in batches:
            x = b.to_numpy(float, na_value=np.nan)
            m = np.isfinite(x).astype(float)
            x = np.where(m > 0, x, 0.0)
            total += [y[i, j] for y in (m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x)]
        keep = total[0] > 0
        yield pd.DataFrame({"i": i[keep], "j": j[keep]} | {c: v[keep] for c, v in zip(columns, total, strict=True)})

    s = wide.mapInPandas(gram, "i long, j long, " + ", ".join(f"{c} double" for c in columns)).groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in columns))
    name = F.array(*map(F.lit, names))
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    vx, vy, c = (F.col("sxx") - sx * sx / n, F.col("syy") - sy * sy / n, F.col("sxy") - sx * sy / n) if centred else (F.col("sxx"), F.col("syy"), F.col("sxy"))
    flat = (vx > 1e-12 * F.col("sxx")) & (vy > 1e-12 * F.col("syy"))
    return s.select(F.get(name, F.col("i").cast("int")).alias("f1"), F.get(name, F.col("j").cast("int")).alias("f2"), n.cast("long").alias("n"), F.when(flat, div(c, F.sqrt(vx * vy))).alias("rho"))


def average_linkage(names: list[str], rho: dict[tuple[str, str], float], cut: float = 0.4) -> list[set[str]]:
    """Clusters of a few hundred factors by mean distance 1 - rho, merged while it stays at or under `cut`.

    Chains of nearest neighbours: two clusters that are each other's nearest merge at once, as no later merge brings another
    nearer to either. A merged cluster's distances are the weighted means of its parts', so each merge is one row's update. Unknown
    pairs are at distance 1.
    """
    names = sorted(names)
    far = np.array([[1 - rho.get((min(a, b), max(a, b)), 0.0) if a != b else np.inf for b in names] for a in names], float).reshape(len(names), len(names))
    far[np.isnan(far)] = 1.0
    members, alive, chain = [{n} for n in names], list(range(len(names))), []
    while len(alive) > 1:
        chain = chain or [alive[0]]
        top = chain[-1]
        near = min(alive, key=lambda k: (far[top, k], len(chain) < 2 or k != chain[-2], k))
        if len(chain) < 2 or near != chain[-2]:
            if far[top, near] > cut:
                # Nothing comes nearer than the nearest of a pair in the chain's end: this cluster stays.
                alive.remove(top)
                chain.pop()
                continue
            chain.append(near)
            continue
        i, j = sorted((top, near))
        n, m = len(members[i]), len(members[j])
        far[i] = far[:, i] = (n * far[i] + m * far[j]) / (n + m)
        far[i, i] = np.inf
        members[i] |= members[j]
        alive.remove(j)
        far[j] = far[:, j] = np.inf
        chain = chain[:-2]
    return sorted((members[k] for k in range(len(names)) if not any(members[k] < o for o in members)), key=min)


def clusters(rho: DataFrame, names: list[str], cut: float = 0.4) -> DataFrame:
    """factor, cluster (numbered by first name) from correlations (f1, f2, rho); a matrix of a few hundred names comes to the driver."""
    found = average_linkage(names, {(min(r.f1, r.f2), max(r.f1, r.f2)): r.rho for r in rho.collect() if r.rho is not None}, cut)
    return rho.sparkSession.createDataFrame([(n, k) for k, c in enumerate(found, 1) for n in sorted(c)], "factor string, cluster int")


def excess_label(df: DataFrame, ret: str, mask: Column, output: str = "label") -> DataFrame:
    """The return less the mean of the usable universe on that date."""
    return df.withColumn(output, F.col(ret) - F.avg(F.when(mask, F.col(ret))).over(Window.partitionBy("date")))


def top_n(df: DataFrame, score: str, n: int) -> DataFrame:
    """The n best of each date; ties by entity; without missing scores."""
    w = Window.partitionBy("date").orderBy(F.desc(score), "entity")
    return df.where(F.col(score).isNotNull()).withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)


def exact_quantile(df: DataFrame, columns: list[str], q: float = 0.5, small: int = 20_000, error: float = 3e-4) -> DataFrame:
    """feature, value: exact interpolated quantiles of whole columns, without one task that holds a column.

    A sketch of each column, merged from its tasks, brackets the quantile's rank, whatever the distribution; its rank error is a third
    of `error`. Then what lies below is counted, and only distinct values within the bracket, a few ten-thousandths of the
    rows, go on with their counts. Columns of up to `small` values are their own bracket.
    """
    long = df.select(*(F.col(c).cast("double").alias(c) for c in columns)).unpivot([], columns, "feature", "x").where("x is not null")
    shares = F.array(F.lit(max(q - error, 0.0)), F.lit(min(q + error, 1.0)))
    ends = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.percentile_approx("x", shares, 10_000).alias("at"))
    wide = F.col("n") <= small
    ends = ends.select("feature", "n", F.when(wide | F.lit(q <= error), F.col("lo")).otherwise(F.col("at")[0]).alias("lo"), F.when(wide | F.lit(q >= 1 - error), F.col("hi")).otherwise(F.col("at")[1]).alias("hi"))
    # A row a column.
    rows = long.join(F.broadcast(ends), "feature")
    # What lies below the bracket is one row a task.
    cells = rows.where("x <= hi").select("feature", "n", F.when(F.col("x") >= F.col("lo"), F.col("x")).alias("x")).groupBy("feature", "n", "x").agg(F.count(F.lit(1)).alias("times"))
    upto = F.sum("times").over(Window.partitionBy("feature").orderBy(F.col("x").asc_nulls_first()))
    at = (F.col("n") - 1) * F.lit(q)
    of = lambda k: F.max(F.when((F.col("upto") - F.col("times") <= k) & (F.col("upto") > k), F.col("x")))
    placed = cells.withColumn("upto", upto).groupBy("feature").agg(of(F.floor(at)).alias("a"), of(F.ceil(at)).alias("z"), F.first("n").alias("n"))
    return placed.select("feature", (F.col("a") + (F.col("z") - F.col("a")) * (at - F.floor(at))).alias("value"))


def robust_scale(df: DataFrame, columns: list[str], train: Column) -> DataFrame:
    """(x - median) / (1.4826 MAD) with both from the training rows only; a zero MAD gives NULL."""
    fit = df.where(train)
    row = lambda q, kind: q.agg(*(F.max(F.when(F.col("feature") == c, F.col("value"))).alias(f"_{kind}_{c}") for c in columns))
    med = row(exact_quantile(fit, columns), "m")
    mad = row(exact_quantile(fit.crossJoin(F.broadcast(med)).select(*(F.abs(F.col(c) - F.col(f"_m_{c}")).alias(c) for c in columns)), columns), "s")
    # Both are one row.
    on = df.crossJoin(F.broadcast(med)).crossJoin(F.broadcast(mad))
    return on.withColumns({c: div(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}") * 1.4826) for c in columns}).select(*df.columns)


def split_segments(df: DataFrame, train_end: str, valid_end: str, embargo_months: int = 1) -> DataFrame:
    """train, valid, test, or NULL within the embargo after each boundary."""
    d = F.col("date")
    after = lambda x: F.add_months(F.lit(x).cast("date"), embargo_months)
    return df.withColumn("segment", F.when(d <= F.lit(train_end).cast("date"), "train").when((d > after(train_end)) & (d <= F.lit(valid_end).cast("date")), "valid").when(d > after(valid_end), "test"))


def layer_paths(held: DataFrame, groups: int = 5) -> DataFrame:
    """date, layer, ret, nav: each layer's running product, and that of top less bottom (layer -1)."""
    spread = held.where(F.col("layer").isin(0, groups - 1)).groupBy("date").agg((F.max(F.when(F.col("layer") == groups - 1, F.col("ret"))) - F.max(F.when(F.col("layer") == 0, F.col("ret")))).alias("ret")).select("date", F.lit(-1).alias("layer"), "ret")
    every = held.select("date", "layer", "ret").unionByName(spread)
    # One row a date and layer.
    w = Window.partitionBy("layer").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return every.withColumn("nav", F.product(1 + F.coalesce("ret", F.lit(0.0))).over(w))


def monotonicity(stats: DataFrame) -> DataFrame:
    """Correlation of the layers' numbers with their annual returns, one row."""
    return stats.where("layer >= 0").agg(F.corr(F.col("layer").cast("double"), "ann_return").alias("monotonicity"))


def cumulative_ic(ics: DataFrame, groups: list[str]) -> DataFrame:
    """The series with its running sum and its mean by year."""
    w = Window.partitionBy(*groups).orderBy("date") if groups else Window.orderBy("date")
    year = Window.partitionBy(*groups, F.year("date"))
    return ics.withColumn("ic_total", F.sum("ic").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("ic_year", F.avg("ic").over(year))


def direction(ics: DataFrame, groups: list[str]) -> DataFrame:
    """1, or -1 where the mean coefficient is negative."""
    return ics.groupBy(*groups).agg(F.avg("ic").alias("ic_mean")).select(*groups, F.when(F.col("ic_mean") < 0, -1).otherwise(1).alias("direction"))


def flipped(factor: DataFrame, ics: DataFrame, source: str, output: str, groups: list[str] | None = None) -> DataFrame:
    """The factor times its direction; one row a group is broadcast."""
    d = direction(ics, groups or [])
    on = factor.crossJoin(F.broadcast(d)) if not groups else factor.join(F.broadcast(d), groups)
    return on.withColumn(output, F.col(source) * F.col("direction")).drop("direction")


def evaluate_factor(factor: DataFrame, mask: DataFrame, prices: DataFrame, styles: DataFrame, horizons: tuple[int, ...] = (5, 10, 20), source: str = "x", min_samples: int = 30) -> DataFrame:
    """One row a variant (cleaned, neutral) and horizon: direction and the summary of the flipped series.

    styles: entity, date, size, industry. Both variants go through the same jobs, told apart by a column.
    """
    cleaned = prepare_factor(factor, mask, source).select("entity", "date", "cleaned")
    both = neutralize(cleaned.join(styles, ["entity", "date"], "left"), "cleaned", "size", "industry", min_samples=min_samples)
    long = both.unpivot(["entity", "date"], ["cleaned", "neutral"], "variant", "value").where("value is not null")
    ics = ic_series(long.join(forward_returns(prices, list(horizons)), ["entity", "date"]), "value", "ret", ["variant", "horizon", "date"])
    way = direction(ics, ["variant", "horizon"])
    signed = ics.join(F.broadcast(way), ["variant", "horizon"]).withColumn("ic", F.col("ic") * F.col("direction"))
    return ic_summary(signed, ["variant", "horizon", "direction"])


def inventory(long: DataFrame, prices: DataFrame, horizons: tuple[int, ...] = (5, 10, 20), joint: bool = True) -> DataFrame:
    """Per factor and horizon: dates, first and last day, mean, deviation and ratio of its coefficients; one job for all factors."""
    on = long.join(forward_returns(prices, list(horizons)), ["entity", "date"])
    return inventory_of(ic_series(on, "value", "ret", ["factor", "horizon", "date"], joint, 3))


def wide_inventory(wide: DataFrame, factors: list[str], rets: dict[int, str]) -> DataFrame:
    """`inventory` of factors and returns (their columns by horizon) that stand beside each other."""
    return inventory_of(wide_ic_series(wide, factors, rets, 3))


def inventory_of(ics: DataFrame) -> DataFrame:
    return ics.groupBy("factor", "horizon").agg(F.count("ic").alias("n_days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.avg("ic").alias("ic_mean"), F.stddev_pop("ic").alias("ic_std")).withColumn("icir", div("ic_mean", "ic_std"))


def coverage(df: DataFrame, columns: list[str], groups: list[str] | None = None) -> DataFrame:
    """Rows, present values and the share of missing ones of each column (a row a column)."""
    x = F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).isNotNull().alias("there")) for c in columns)))
    g = df.select(*(groups or []), x).groupBy(*(groups or []), "column")
    return g.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("there").cast("long")).alias("n_present"), F.avg((~F.col("there")).cast("double")).alias("missing"))


def month_ends(df: DataFrame, entity: str | None = "entity") -> DataFrame:
    """Rows of the last date of each month that the entity (or, with None, the table) has."""
    keys = [entity] if entity else []
    last = df.groupBy(*keys, F.trunc("date", "month").alias("_m")).agg(F.max("date").alias("date")).drop("_m")
    return df.join(last if entity else F.broadcast(last), [*keys, "date"], "left_semi")


def next_month_return(prices: DataFrame, price: str = "close") -> DataFrame:
    """Month-end prices with the return to the entity's next month-end."""
    w = Window.partitionBy("entity").orderBy("date")
    return month_ends(prices).withColumn("ret", div(F.lead(price).over(w), price) - 1)


def monthly_rank_ic(df: DataFrame, factor: str, ret: str, least: int = 2) -> DataFrame:
    """Month-end rank correlations, one row: months, mean, ratio times the root of 12, share above zero."""
    s = ic_series(df, factor, ret, ["date"], True, least).where("ic is not null")
    return s.agg(F.count("ic").alias("months"), F.avg("ic").alias("ic_mean"), (div(F.avg("ic"), F.stddev_samp("ic")) * float(np.sqrt(12))).alias("icir_year"), F.avg((F.col("ic") > 0).cast("double")).alias("hit_rate"))


def monthly_neutral(df: DataFrame, y: str, size: str, industry: str, least: int = 100, output: str = "neutral") -> DataFrame:
    """Neutralised at month ends that have at least `least` entities; other dates go."""
    return neutralize(month_ends(df, None), y, size, industry, output, least).where(F.col(output).isNotNull())


def ic_correlation(ics: DataFrame) -> DataFrame:
    """Pearson correlation of daily coefficient series (factor, date, ic), all pairs f1 < f2 over common dates."""
    return factor_correlation(ics.select(F.lit(0).alias("entity"), "date", "factor", F.col("ic").alias("value")), centred=True)


def block_means(rho: DataFrame, groups: DataFrame) -> DataFrame:
    """Mean correlation within and between groups of factors (factor, grp), each unordered pair of groups once."""
    a, b = (groups.select(F.col("factor").alias(f), F.col("grp").alias(g)) for f, g in (("f1", "ga"), ("f2", "gb")))
    # A few hundred factors.
    on = rho.join(F.broadcast(a), "f1").join(F.broadcast(b), "f2")
    return on.groupBy(F.least("ga", "gb").alias("g1"), F.greatest("ga", "gb").alias("g2")).agg(F.count("rho").alias("n_pairs"), F.avg("rho").alias("mean_rho"), F.sum((F.abs("rho") > 0.6).cast("long")).alias("n_high"))


def representatives(clusters: DataFrame, summary: DataFrame) -> DataFrame:
    """Of each cluster (factor, cluster) the factor of the highest absolute ratio; ties to the first name."""
    best = Window.partitionBy("cluster").orderBy(F.abs("icir").desc_nulls_last(), "factor")
    return clusters.join(summary.select("factor", "icir"), "factor").withColumn("_k", F.row_number().over(best)).withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("cluster"))).where("_k = 1").select("cluster", "factor", "icir", "size")
