"""The declarative steps as functions of DataFrames. All are lazy; none needs a Python worker but
`cross_section_regress` with more than two regressors, for a small system a group."""

from __future__ import annotations

import functools
import itertools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..functions.expr import col, compile_formula, div
from ..functions.windows import AGGREGATES, bins, last_rows, rank, rolling, series, zscore


def compute(df: DataFrame, formula: str, source_columns: list[str], output: str) -> DataFrame:
    return df.withColumn(output, compile_formula(formula, source_columns).cast("double"))


def filter_rows(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which the condition holds; a comparison with a missing value doesn't."""
    return df.where(compile_formula(condition, df.columns))


def winsorize(df: DataFrame, source: str, output: str, groups: list[str], n: float = 3.0) -> DataFrame:
    """Median and MAD per group in two passes over one exchange; a zero MAD leaves the group alone."""
    w = Window.partitionBy(*groups)
    x = F.col(source)
    df = df.withColumn("_med", F.percentile(x, F.lit(0.5)).over(w))
    df = df.withColumn("_mad", F.percentile(F.abs(x - F.col("_med")), F.lit(0.5)).over(w) * 1.4826)
    clipped = F.greatest(F.least(x, F.col("_med") + n * F.col("_mad")), F.col("_med") - n * F.col("_mad"))
    return df.withColumn(output, F.when(x.isNotNull(), F.when(F.col("_mad") > 0, clipped).otherwise(x))).drop("_med", "_mad")


def transform(df: DataFrame, method: str, source: str, output: str, periods: int | None = None, group_by: str | list[str] | None = None, n: float = 3.0, entity: str = "entity", date: str = "date") -> DataFrame:
    x = F.col(source)
    by = [group_by] if isinstance(group_by, str) else group_by
    w = series(by or [entity], date)
    back = lambda p: F.lag(x, p).over(w) if p >= 0 else F.lead(x, -p).over(w)
    change = lambda p: div(x - back(p), back(p))
    made = {
        "diff": lambda: x - back(periods or 1),
        "shift": lambda: back(1 if periods is None else periods),
        "yoy": lambda: change(periods or 4),
        "qoq": lambda: change(periods or 1),
        "zscore": lambda: zscore(x, by),
        "cs_demean": lambda: x - F.avg(x).over(Window.partitionBy(*(by or [date]))),
        "abs": lambda: F.abs(x),
        "ffill": lambda: F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "bfill": lambda: F.first(x, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)),
        "diff_quarterly": lambda: F.when(F.col("quarter").endswith("q1"), x).otherwise(x - back(1)),
    }
    if method == "zscore" and not by:
        # One row for the whole table, not a window without keys.
        whole = df.agg(F.avg(x).alias("_mean"), F.stddev_samp(x).alias("_std"))
        return df.crossJoin(F.broadcast(whole)).withColumn(output, div(x - F.col("_mean"), "_std")).drop("_mean", "_std")
    if method == "winsorize":
        return winsorize(df, source, output, by or [date], n)
    if method not in made:
        raise ValueError(f"no transform {method}")
    return df.withColumn(output, made[method]())


def rank_step(df: DataFrame, source: str, output: str, group_by: list[str], ascending: bool = True, pct: bool = False, rank_method: str = "average", n_bins: int | None = None, tie: tuple[str, ...] = ("entity",)) -> DataFrame:
    if not group_by:
        raise ValueError("rank needs group_by")
    how = {"ascending": ascending, "method": rank_method, "tie": list(tie)}
    return df.withColumn(output, bins(source, group_by, n_bins, **how) if n_bins else rank(source, group_by, pct=pct, **how))


def rolling_step(df: DataFrame, source: str, output: str, window: int, min_periods: int | None = None, agg: str = "min", group_by: str | list[str] = "entity", change_on: str | None = None, fill_method: str | None = "ffill", date: str = "date") -> DataFrame:
    """Plain: frames of rows. change_on: frames over the rows on which that column changes, then filled."""
    w = series(group_by, date)
    x = F.col(source)
    if change_on is None:
        return df.withColumn(output, rolling(x, window, agg, min_periods, w))
    keys = [group_by] if isinstance(group_by, str) else group_by
    c = F.col(change_on)
    # Every missing value counts as a change, and so does an entity's first row.
    changed = c.isNull() | ~c.eqNullSafe(F.lag(c).over(w)) | (F.row_number().over(w) == 1)
    df = df.withColumn("_sampled", changed & x.isNotNull())
    # Sampled rows of an entity are windows of their own, so no join back is needed.
    own = last_rows(window, Window.partitionBy(*keys, "_sampled").orderBy(date))
    value = F.when(F.col("_sampled") & (F.count(x).over(own) >= (min_periods or window)), AGGREGATES[agg](x).over(own))
    df = df.withColumn("_value", value)
    fill = {
        None: F.col("_value"),
        "ffill": F.last("_value", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "bfill": F.first("_value", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)),
    }[fill_method]
    return df.withColumn(output, fill).drop("_sampled", "_value")


def merge(target: DataFrame, source: DataFrame, on: list[str], columns: list[str], how: str = "left") -> DataFrame:
    if clash := set(columns) & set(target.columns):
        raise ValueError(f"columns are there already: {sorted(clash)}")
    return target.join(source.select(*on, *columns), on, how)


def row_aggregate(df: DataFrame, sources: list[str], output: str, agg: str, ddof: int = 1, skipna: bool = True) -> DataFrame:
    values = F.array_compact(F.array(*(F.col(c).cast("double") for c in sources)))
    n = F.size(values)
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    mean = div(total, n)
    var = F.when(n > ddof, F.aggregate(values, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / (n - ddof))
    ordered = F.array_sort(values)
    middle = F.when(n > 0, (F.get(ordered, ((n - 1) / 2).cast("int")) + F.get(ordered, (n / 2).cast("int"))) / 2)
    made = {"mean": mean, "sum": total, "var": var, "std": F.sqrt(var), "min": F.array_min(values), "max": F.array_max(values), "median": middle, "count": n.cast("double")}[agg]
    return df.withColumn(output, made if skipna or agg == "count" else F.when(n == len(sources), made))


def row_polyfit(df: DataFrame, sources: list[str], output: str, coefficient: str, degree: int = 2, x_pattern: str = "equispaced", zscore_y: bool = True, zscore_x: bool = True) -> DataFrame:
    """One coefficient of a least-squares polynomial over fixed x: a dot product with weights known here."""
    if x_pattern != "equispaced":
        raise NotImplementedError(x_pattern)
    x = np.arange(len(sources), dtype=float)
    if zscore_x:
        x = (x - x.mean()) / x.std(ddof=1)
    weights = np.linalg.pinv(np.vander(x, degree + 1))[degree - int(coefficient.removeprefix("a"))]
    ys = [F.col(c).cast("double") for c in sources]
    n, total = len(ys), lambda xs: functools.reduce(operator.add, xs)
    value = total([y * float(w) for y, w in zip(ys, weights, strict=True)])
    if zscore_y:
        # Standardising comes out of the dot product: one division a row.
        mean = total(ys) / n
        spread = total([(y - mean) * (y - mean) for y in ys])
        value = F.when(spread > 0, (value - mean * float(weights.sum())) / F.sqrt(spread / (n - 1)))
    return df.withColumn(output, value)


def row_correlate(df: DataFrame, a: list[str], b: list[str], output: str, method: str = "pearson") -> DataFrame:
    if method != "pearson" or len(a) != len(b) or len(a) < 2:
        raise ValueError("two lists of equal length, at least 2, and pearson")
    n = len(a)
    total = lambda xs: functools.reduce(operator.add, xs)
    xs, ys = [F.col(c).cast("double") for c in a], [F.col(c).cast("double") for c in b]
    mx, my = total(xs) / n, total(ys) / n
    xy = total([(x - mx) * (y - my) for x, y in zip(xs, ys, strict=True)])
    xx, yy = total([(x - mx) * (x - mx) for x in xs]), total([(y - my) * (y - my) for y in ys])
    return df.withColumn(output, div(xy, F.sqrt(xx * yy)))


def cross_section_regress(df: DataFrame, y: str, xs: list[str], output: str, add_intercept: bool = True, date: str = "date", group: str | None = None, min_samples: int = 30) -> DataFrame:
    """Least-squares residual within each date (and group). One or two regressors: window sums; more: co-moments by group, solved, and joined."""
    keys = [date, *([group] if group else [])]
    ok = functools.reduce(operator.and_, (F.col(c).isNotNull() for c in [y, *xs, *keys]))
    need = max(len(xs) + add_intercept + 5, min_samples)
    if len(xs) == 1:
        w = Window.partitionBy(*keys)
        a, b = F.when(ok, F.col(xs[0])), F.when(ok, F.col(y))
        ma, mb = (F.avg(a).over(w), F.avg(b).over(w)) if add_intercept else (F.lit(0.0), F.lit(0.0))
        # Centred sums: the mean is a column before its deviations are summed.
        df = df.withColumn("_ma", ma).withColumn("_mb", mb).withColumn("_n", F.count(a).over(w))
        da, db = a - F.col("_ma"), b - F.col("_mb")
        beta = F.coalesce(div(F.sum(da * db).over(w), F.sum(da * da).over(w)), F.lit(0.0))
        return df.withColumn(output, F.when(ok & (F.col("_n") >= need), db - beta * da)).drop("_ma", "_mb", "_n")
    if len(xs) == 2:
        w = Window.partitionBy(*keys)
        cols = {"_a": F.when(ok, F.col(xs[0]).cast("double")), "_b": F.when(ok, F.col(xs[1]).cast("double")), "_y": F.when(ok, F.col(y).cast("double"))}
        df = df.withColumns(cols).withColumns({f"_m{n}": F.avg(n).over(w) if add_intercept else F.lit(0.0) for n in cols} | {"_n": F.count("_y").over(w)})
        a, b, v = (F.col(n) - F.col(f"_m{n}") for n in cols)
        s = {f"_{p}{q}": F.sum(x * z).over(w) for (p, x), (q, z) in itertools.combinations_with_replacement((("a", a), ("b", b), ("v", v)), 2)}
        df = df.withColumns(s)
        aa, ab, av, bb, bv = (F.col(f"_{n}") for n in ("aa", "ab", "av", "bb", "bv"))
        det = aa * bb - ab * ab
        alone = F.when(aa > 0, div(av, aa)).otherwise(F.lit(0.0)), F.when(aa > 0, F.lit(0.0)).otherwise(F.coalesce(div(bv, bb), F.lit(0.0)))
        # Regressors that are multiples of each other explain what one of them does.
        apart = det > 1e-12 * aa * bb
        p, q = F.when(apart, (av * bb - bv * ab) / det).otherwise(alone[0]), F.when(apart, (bv * aa - av * ab) / det).otherwise(alone[1])
        return df.withColumn(output, F.when(ok & (F.col("_n") >= need), v - p * a - q * b)).drop(*cols, *(f"_m{n}" for n in cols), *s, "_n")
    names = [*xs, y]
    at = list(itertools.combinations_with_replacement(range(len(names)), 2))
    # Co-moments by date: one row of p^2 numbers, combined within tasks first.
    x = [F.when(ok, F.col(c).cast("double")) for c in names]
    moment = (lambda a, b: F.covar_pop(a, b)) if add_intercept else (lambda a, b: F.avg(a * b))
    gram = df.where(ok).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.array(*((F.avg(v) if add_intercept else F.lit(0.0)) for v in x)).alias("_means"), F.array(*(moment(x[i], x[j]) for i, j in at)).alias("_moments")).where(F.col("_n") >= need)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slopes = []
            for m in b.column(b.schema.get_field_index("_moments")).to_pylist():
                full = np.zeros((len(names),) * 2)
                for (i, j), v in zip(at, m, strict=True):
                    full[i, j] = full[j, i] = v
                scale = np.sqrt(np.maximum(np.diag(full)[:-1], 0.0))
                scale = np.where(scale > 0, scale, 1.0)
                # Any least-squares solution leaves the same residual; directions without variance are left out.
                slopes.append((np.linalg.pinv(full[:-1, :-1] / np.outer(scale, scale), rcond=1e-10, hermitian=True) @ (full[:-1, -1] / scale) / scale).tolist())
            kept = [c for n, c in zip(b.schema.names, b.columns, strict=True) if n not in ("_n", "_moments")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(slopes, pa.list_(pa.float64()))], names=solved.names)

    solved = StructType([*(gram.schema[k] for k in keys), StructField("_means", ArrayType(DoubleType())), StructField("_slopes", ArrayType(DoubleType()))])
    on = df.join(gram.mapInArrow(solve, solved), keys, "left")
    fitted = functools.reduce(operator.add, (F.get("_slopes", F.lit(i)) * (F.col(c) - F.get("_means", F.lit(i))) for i, c in enumerate(xs)))
    residual = F.when(ok, F.col(y) - F.get("_means", F.lit(len(xs))) - fitted)
    return on.withColumn(output, residual).select(*df.columns, output)


def rolling_ts_regress(df: DataFrame, seg1: str, seg2: str, index1: str, index2: str, output: str, window: int = 20, min_obs: int | None = None, group_by: str = "entity", date: str = "date") -> DataFrame:
    """Standardised mean difference of two segments' residuals against an index, per window.

    Both segments' points are regressed together; their moments are added in one frame, nothing is exploded.
    """
    need = max(window // 2, 5) if min_obs is None else min_obs
    w = last_rows(window, series(group_by, date))
    r1, r2, i1, i2 = (F.col(c).cast("double") for c in (seg1, seg2, index1, index2))
    ok1, ok2 = r1.isNotNull() & i1.isNotNull(), r2.isNotNull() & i2.isNotNull()
    s = lambda x1, x2: F.coalesce(F.sum(F.when(ok1, x1)).over(w), F.lit(0.0)) + F.coalesce(F.sum(F.when(ok2, x2)).over(w), F.lit(0.0))
    one = F.lit(1.0)
    df = df.withColumns({"_n": s(one, one), "_x": s(i1, i2), "_y": s(r1, r2), "_xx": s(i1 * i1, i2 * i2), "_xy": s(i1 * r1, i2 * r2), "_rows": F.count(F.lit(1)).over(w)})
    slope_den = F.col("_n") * F.col("_xx") - F.col("_x") * F.col("_x")
    df = df.withColumn("_beta", F.when(F.abs(slope_den) > 1e-12, (F.col("_n") * F.col("_xy") - F.col("_x") * F.col("_y")) / slope_den).otherwise(0.0))
    ok = ok1 & ok2
    d, g = F.when(ok, r1 - r2), F.when(ok, i1 - i2)
    beta, n = F.col("_beta"), F.count(d).over(w)
    mean = F.avg(d).over(w) - beta * F.avg(g).over(w)
    var = (F.var_pop(d).over(w) - 2 * beta * F.covar_pop(d, g).over(w) + beta * beta * F.var_pop(g).over(w)) * n / F.nullif(n - 1, F.lit(0))
    sd = F.sqrt(F.greatest(var, F.lit(0.0)))
    value = F.when((F.col("_rows") == window) & (n >= need) & (sd > 1e-12), mean / (sd / F.sqrt(n.cast("double"))))
    return df.withColumn(output, value).drop("_n", "_x", "_y", "_xx", "_xy", "_rows", "_beta")


def as_of(rows: DataFrame, events: DataFrame, value: str, entity: str = "entity", date: str = "date", default: Column | float | None = None, output: str | None = None) -> DataFrame:
    """The latest event at or before each row's date, by one sort of the union; `default` before the first."""
    output = output or value
    e = events.groupBy(entity, date).agg(F.max(value).alias("_v")).select(entity, date, F.lit(0).alias("_kind"), "_v")
    d = rows.withColumn("_row", F.struct(*rows.columns)).select(entity, date, F.lit(1).alias("_kind"), "_row")
    w = Window.partitionBy(entity).orderBy(date, "_kind").rowsBetween(Window.unboundedPreceding, 0)
    both = e.unionByName(d, allowMissingColumns=True).withColumn("_at", F.last("_v", ignorenulls=True).over(w))
    at = F.col("_at") if default is None else F.coalesce("_at", default if isinstance(default, Column) else F.lit(default))
    return both.where("_kind = 1").select("_row.*", at.alias(output))


def trailing(days: DataFrame, events: DataFrame, width: int, entity: str = "entity", date: str = "date", bucket: int | None = None) -> DataFrame:
    """Pairs of a day and each event of its entity in (day - width, day]: an equi-join on time buckets."""
    bucket = bucket or width
    e = events.withColumnRenamed(date, "event_date").withColumn("_b", F.floor(F.unix_date("event_date") / bucket))
    d = days.withColumn("_b", F.explode(F.sequence(F.floor((F.unix_date(date) - width + 1) / bucket), F.floor(F.unix_date(date) / bucket))))
    inside = (F.col("event_date") <= F.col(date)) & (F.col("event_date") > F.date_sub(F.col(date), width))
    return d.join(e, [entity, "_b"]).where(inside).drop("_b")


def keep_last(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row a key, the last in order."""
    newest = [col(c).desc() for c in order]
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))).where("_rn = 1").drop("_rn")


def pct_change(df: DataFrame, source: str, output: str, periods: int = 1, pad: bool = False, entity: str = "entity", date: str = "date") -> DataFrame:
    """Change against so many rows before; pad: missing values are those before them, on both sides."""
    w = series(entity, date)
    x = F.last(source, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)) if pad else F.col(source)
    df = df.withColumn("_x", x)
    return df.withColumn(output, div("_x", F.lag("_x", periods).over(w)) - 1).drop("_x")


def recode(df: DataFrame, source: str, mapping: dict, output: str) -> DataFrame:
    """Values by a map; keys that it lacks give NULL."""
    of = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    return df.withColumn(output, F.try_element_at(of, F.col(source)))
