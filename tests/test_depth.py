"""Attributions, clusters, regressions on many columns, exact quantiles, folds and filters against plain versions."""

import itertools
import math
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quantloom.operators import attribution, evaluation, events, learning, minute, steps
from quantloom.plans import spec

NAMES = [f"f{k}" for k in range(6)]


@pytest.fixture(scope="module")
def trained(spark):
    r = np.random.default_rng(0)
    x = r.normal(0, 1, (600, 6)).round(2)
    y = x[:, 0] * (x[:, 1] > 0) + np.sin(2 * x[:, 2]) + 0.1 * r.normal(0, 1, 600)
    rows = [(f"e{i % 20}", str(i // 20), "valid" if i % 5 == 0 else "train", float(v), *map(float, f)) for i, (f, v) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, f"entity string, date string, segment string, label double, {', '.join(f'{n} double' for n in NAMES)}").repartition(3)
    return df, learning.train_boosted(df, NAMES, rounds=6, depth=4, rate=0.3)


def expectation(nodes, known, x, k=0):
    prediction, rows, left, right, feature, threshold = nodes[k]
    if left < 0:
        return prediction
    if feature in known:
        return expectation(nodes, known, x, left if x[feature] <= threshold else right)
    return sum(nodes[c][1] / rows * expectation(nodes, known, x, c) for c in (left, right))


def test_attributions_match_all_subsets():
    """A made tree that asks one feature twice on a path, against the definition over all 64 subsets."""
    nodes = {0: (0, 100, 1, 2, 0, 0.5), 1: (0, 60, 3, 4, 1, 0.0), 2: (0, 40, 5, 6, 0, 1.5), 3: (2.0, 20, -1, -1, -1, 0), 4: (0, 40, 7, 8, 3, 0.2), 5: (-1.0, 25, -1, -1, -1, 0), 6: (0, 15, 9, 10, 4, 0.0), 7: (5.0, 10, -1, -1, -1, 0), 8: (1.0, 30, -1, -1, -1, 0), 9: (7.0, 5, -1, -1, -1, 0), 10: (-3.0, 10, -1, -1, -1, 0)}
    x = np.random.default_rng(1).normal(0.5, 1, (50, 6))
    got, base = attribution.shapley(x, attribution.leaves(nodes, 0.7))
    assert base == pytest.approx(0.7 * expectation(nodes, set(), x[0]))
    for row, mine in zip(x, got, strict=True):
        for j in range(6):
            others = [i for i in range(6) if i != j]
            value = sum(math.factorial(k) * math.factorial(5 - k) / math.factorial(6) * (expectation(nodes, {*s, j}, row) - expectation(nodes, set(s), row)) for k in range(6) for s in itertools.combinations(others, k))
            assert mine[j] == pytest.approx(0.7 * value, abs=1e-12)


def test_attributions_add_up_to_predictions(trained, tmp_path):
    df, model = trained
    got = attribution.attributions(model, df, NAMES, str(tmp_path))
    assert got.columns == ["entity", "date", "segment", "label", "base", "shap"]
    on = got.join(learning.predict(model, df, NAMES).select("entity", "date", "score"), ["entity", "date"]).collect()
    assert len(on) == 600 and max(abs(r.base + sum(r.shap) - r.score) for r in on) < 1e-9
    top = attribution.top_by_attribution(got, NAMES, 3).collect()
    shap = np.array([r.shap for r in on])
    assert [t.feature for t in top] == [NAMES[k] for k in np.argsort(-np.abs(shap).mean(0))[:3]] and {t.feature for t in top} == {"f0", "f1", "f2"}
    stats = {r.feature: r for r in attribution.attribution_statistics(got, df, NAMES).collect()}
    x = df.select("entity", "date", *NAMES).toPandas().merge(pd.DataFrame([(r.entity, r.date, *r.shap) for r in on], columns=["entity", "date", *(f"s{k}" for k in range(6))]), on=["entity", "date"])
    for k, n in enumerate(NAMES):
        s, v = x[f"s{k}"], x[n]
        assert stats[n].mean_abs == pytest.approx(s.abs().mean()) and stats[n].q50 == pytest.approx(s.median(), abs=1e-12) and stats[n].q95 == pytest.approx(s.quantile(0.95), abs=1e-12)
        if s.std() > 1e-9:
            assert stats[n].skew == pytest.approx(s.skew(), rel=1e-6)
            assert stats[n].rank_corr == pytest.approx(v.rank().corr(s.rank()), abs=1e-9)


def plain_linkage(names, rho, cut):
    clusters = [{n} for n in sorted(names)]
    far = lambda p, q: np.mean([1 - rho.get((min(a, b), max(a, b)), 0.0) for a in p for b in q])
    while len(clusters) > 1:
        d, i, j = min((far(p, q), i, j) for i, p in enumerate(clusters) for j, q in enumerate(clusters[:i]))
        if d > cut:
            break
        clusters[j] |= clusters.pop(i)
    return sorted(map(sorted, clusters))


@pytest.mark.parametrize(("n", "seed"), [(150, 0), (40, 1), (41, 2), (2, 3), (1, 4)])
def test_chains_of_neighbours_are_average_linkage(n, seed):
    r = np.random.default_rng(seed)
    base = r.normal(0, 1, (max(1, n // 6), 60))
    x = base[r.integers(0, len(base), n)] + r.normal(0, 0.7, (n, 60))
    c = np.corrcoef(x) if n > 1 else np.ones((1, 1))
    names = [f"n{k:03d}" for k in range(n)]
    rho = {(names[i], names[j]): float(c[i, j]) for i in range(n) for j in range(i + 1, n) if (i + j) % 11}
    for cut in (0.2, 0.4, 0.9):
        assert sorted(map(sorted, evaluation.average_linkage(names, rho, cut))) == plain_linkage(names, rho, cut)


def test_regression_on_five_collinear_columns(spark):
    r = np.random.default_rng(2)
    rows, plain = [], {}
    for day in range(4):
        n = (60, 45, 8, 50)[day]
        x = r.normal(5, 2, (n, 5))
        x[:, 4] = 2 * x[:, 0] - x[:, 1]
        x[:, 3] = x[:, 3] if day else 7.0
        y = x @ r.normal(0, 1, 5) + r.normal(0, 1, n)
        for i in range(n):
            values = [float(y[i]), *map(float, x[i])]
            if i % 17 == 5:
                values[i % 6] = None
            rows.append((day if i % 23 != 7 else None, i, *values))
        good = [i for i in range(n) if i % 17 != 5 and i % 23 != 7]
        for intercept in (True, False):
            a = np.column_stack([x[good], np.ones(len(good))]) if intercept else x[good]
            e = y[good] - a @ np.linalg.lstsq(a, y[good], rcond=None)[0]
            plain |= {(intercept, day, i): v for i, v in zip(good, e, strict=True) if len(good) >= 30}
    df = spark.createDataFrame(rows, "date int, entity int, y double, a double, b double, c double, d double, e double").repartition(3)
    for intercept in (True, False):
        out = steps.cross_section_regress(df, "y", list("abcde"), "r", intercept)
        assert out.columns == [*df.columns, "r"]
        got = {(intercept, x.date, x.entity): x.r for x in out.where("r is not null").collect()}
        mine = {k: v for k, v in plain.items() if k[0] == intercept}
        assert got.keys() == mine.keys() and max(abs(got[k] - mine[k]) for k in mine) < 1e-7
        assert out.count() == len(rows)


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.999, 1.0])
def test_exact_quantiles_of_any_shape(spark, q):
    r = np.random.default_rng(4)
    n = 60_000
    x = pd.DataFrame({"lognormal": np.exp(r.normal(0, 3, n)), "outlier": np.where(np.arange(n) == 5, 1e15, r.normal(0, 1, n)), "ties": r.integers(0, 3, n).astype(float), "short": np.where(np.arange(n) < 7, np.arange(n) * 1.0, np.nan), "none": np.nan})
    df = spark.createDataFrame(x).select(*(F.when(~F.isnan(c), F.col(c)).alias(c) for c in x.columns)).repartition(5)
    got = {y.feature: y.value for y in evaluation.exact_quantile(df, list(x.columns), q).collect()}
    assert got.keys() == {"lognormal", "outlier", "ties", "short"}
    assert all(got[c] == pytest.approx(x[c].quantile(q), rel=1e-12, abs=1e-12) for c in got)


def test_a_long_list_of_reports_is_folded_in_seconds(spark):
    n = 100_000
    df = spark.range(n).select(F.lit("a").alias("entity"), F.lit(None).cast("string").alias("lead"), F.expr("date_add(DATE'1800-01-01', cast(id as int))").alias("date"), (100 + 5 * F.sin("id")).alias("v"))
    began = time.time()
    got = events.revisions(df, "v", ["entity", "lead"]).agg(F.count("change").alias("n"), F.sum("change").alias("s")).first()
    took, base, changes = time.time() - began, None, []
    for k in range(n):
        v = 100 + 5 * math.sin(k)
        c = (v - base) / abs(base) if base is not None else None
        if base is None or abs(c) >= 0.01:
            changes += [c] if c is not None else []
            base = v
    assert got.n == len(changes) and got.s == pytest.approx(sum(changes), abs=1e-9) and took < 20


def test_filters_take_words(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None), (-1.0, 5.0), (3.0, -2.0)], "a double, b double")
    keep = lambda c: [(r.a, r.b) for r in steps.filter_rows(df, c).collect()]
    assert keep("a > 0 and b > 0") == keep("a > 0 & b > 0") == keep("(a > 0) & (b > 0)") == [(1.0, 2.0)]
    assert keep("a < 0 or not b > 0") == [(1.0, None), (-1.0, 5.0), (3.0, -2.0)] and keep("0 < a < 2") == [(1.0, 2.0), (1.0, None)]
    with pytest.raises(ValueError):
        keep("a and b")


def test_a_zero_rank_correlation_is_zero(spark):
    """Four names whose ranks are uncorrelated, in every order of rows."""
    rows = [(day, i, f, g) for day in range(12) for i, (f, g) in enumerate(zip((1.0, 2.0, 3.0, 4.0), (2.0, 4.0, 1.0, 3.0), strict=True))]
    df = spark.createDataFrame(rows, "date int, entity int, f double, ret double").repartition(7)
    ics = evaluation.ic_series(df, "f", "ret", ["date"])
    assert [r.ic for r in ics.collect()] == [0.0] * 12 and evaluation.ic_summary(ics.withColumn("k", F.lit(1)), ["k"]).first().pct_positive == 0.0


def test_minute_features_are_checked_before_a_run():
    step = {"action": "minute_pricejump_aggregate", "cache_key": "k", "features": ["peak_count", "jump_xy_sum"]}
    recipe = {"factor": {"name": "x", "column": "jump_xy_sum"}, "calculation_steps": [step]}
    assert spec.validate(recipe)
    with pytest.raises(spec.SpecError, match="no features"):
        spec.validate(recipe | {"calculation_steps": [step | {"features": ["eruption_xy_sum", "jump_xy_sum"]}]})
    assert set(minute.FEATURES) == set(minute.REDUCERS)


def test_every_feature_that_a_specification_may_name_is_made(spark):
    rows = [("a", f"2024-01-{d:02d}", m, 10.0 + m, 11.0 + m + d % 3, 9.0 + m, 10.5 + m, float(1 + (m * 7 + d * 3) % 11), 5.0 + m) for d in range(1, 9) for m in range(570, 590)]
    df = spark.createDataFrame(rows, "entity string, date string, minute int, open double, high double, low double, close double, volume double, turnover double").withColumn("date", F.to_date("date"))
    for action, names in minute.FEATURES.items():
        params = {"std_window": 3} if "aggregate" in action else {"lookback": 2} if "smart" in action else {"min_minutes": 5, "drop_open": 1, "drop_close": 1} if "apm" not in action else {"min_bars": 5}
        out = minute.reduce_minutes(df, action, names, **params)
        assert out.columns == ["entity", "date", *names] and out.count() == 8
