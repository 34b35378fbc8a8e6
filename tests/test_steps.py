import datetime as dt

import numpy as np
import pytest

from quantloom.functions.expr import FormulaError
from quantloom.operators import evaluation, events, steps
from quantloom.plans import spec


def day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def column(df, name, *order):
    return [r[name] for r in df.orderBy(*order).collect()]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_rank_descending_and_within_groups(spark):
    df = frame(spark, [(str(i), day(0), g, x) for i, (g, x) in enumerate([("a", 0.15), ("a", 0.12), ("a", 0.10), ("b", 0.3), ("b", 0.2), ("b", 0.1)])], "entity string, date date, industry string, x double")
    assert column(steps.rank_step(df, "x", "r", ["date", "industry"], False, rank_method="min"), "r", "entity") == [1, 2, 3, 1, 2, 3]
    with pytest.raises(ValueError, match="group_by"):
        steps.rank_step(df, "x", "r", [])


def test_bins_and_missing(spark):
    df = frame(spark, [(i, day(0), float(i)) for i in range(10)] + [(99, day(0), None)], "entity int, date date, x double")
    assert column(steps.rank_step(df, "x", "b", ["date"], n_bins=5), "b", "entity") == [1, 2, 2, 3, 3, 4, 4, 5, 5, 5, None]


def test_fill_and_changes(spark):
    df = frame(spark, [("A", day(0), 1.0), ("A", day(1), None), ("A", day(2), None), ("B", day(0), None), ("B", day(1), 2.0), ("B", day(2), None)], "entity string, date date, v double")
    assert column(steps.transform(df, "ffill", "v", "o"), "o", "entity", "date") == [1, 1, 1, None, 2, 2]
    x = frame(spark, [("A", day(i), v) for i, v in enumerate([100.0, 110.0, 120.0, 130.0, 200.0, 220.0])], "entity string, date date, x double")
    assert column(steps.transform(x, "yoy", "x", "o"), "o", "date") == [None] * 4 + [1.0, 1.0]
    q = frame(spark, [("A", day(i), f"2024q{i + 1}", v) for i, v in enumerate([10.0, 25.0, 45.0, 70.0])], "entity string, date date, quarter string, x double")
    assert column(steps.transform(q, "diff_quarterly", "x", "o"), "o", "date") == [10, 15, 20, 25]
    d = frame(spark, [(i, day(0), v) for i, v in enumerate([1.0, 2.0, 3.0])] + [(i, day(1), v) for i, v in enumerate([10.0, 20.0, 30.0])], "entity int, date date, x double")
    assert column(steps.transform(d, "cs_demean", "x", "o"), "o", "date", "entity") == [-1, 0, 1, -10, 0, 10]


def test_rolling_plain_and_on_change(spark):
    df = frame(spark, [(e, day(i), (i + 1.0) * m) for e, m in (("A", 1), ("B", 10)) for i in range(5)], "entity string, date date, x double")
    assert column(steps.rolling_step(df, "x", "o", 3, 3, "mean"), "o", "entity", "date") == [None, None, 2, 3, 4, None, None, 20, 30, 40]
    rows = [(("A"), day(i), r, k) for i, (r, k) in enumerate([(0.1, 5.0)] * 3 + [(0.2, 8.0)] * 3 + [(0.3, 12.0)] * 3)]
    df = frame(spark, rows, "entity string, date date, roic double, rk double")
    assert column(steps.rolling_step(df, "rk", "o", 2, 1, "min", change_on="roic"), "o", "date") == [5] * 6 + [8] * 3
    assert column(steps.rolling_step(df, "rk", "o", 5, 5, "min", change_on="roic"), "o", "date") == [None] * 9


def test_formulas(spark):
    df = frame(spark, [(1, 4.0, 2.0), (2, 1.0, 0.0), (3, None, 1.0)], "entity int, a double, b double")
    assert column(steps.compute(df, "a / b", ["a", "b"], "o"), "o", "entity") == [2.0, None, None]
    assert column(steps.compute(df, "(a > b) + 1", ["a", "b"], "o"), "o", "entity") == [2.0, 2.0, 1.0]
    assert column(steps.compute(df, "log(b) / (a > 2)", ["a", "b"], "o"), "o", "entity")[1:] == [None, None]
    for bad in ("__import__('os')", "c + 1", "a.b", "a if b else 1"):
        with pytest.raises(FormulaError):
            steps.compute(df, bad, ["a", "b"], "o")


def test_row_operations(spark):
    df = frame(spark, [(1, 1.0, 4.0, 9.0, 16.0), (2, 1.0, None, 3.0, 2.0)], "entity int, a double, b double, c double, d double")
    cols = list("abcd")
    assert column(steps.row_aggregate(df, cols, "o", "median"), "o", "entity") == [6.5, 2.0]
    assert column(steps.row_aggregate(df, cols, "o", "sum", skipna=False), "o", "entity") == [30.0, None]
    got = column(steps.row_polyfit(df, cols, "o", "a2", zscore_y=False, zscore_x=False), "o", "entity")
    assert got[0] == pytest.approx(1.0) and got[1] is None
    assert column(steps.row_correlate(df, ["a", "b"], ["c", "d"], "o"), "o", "entity") == [pytest.approx(1.0), None]


def test_regressions_against_numpy(spark):
    r = np.random.default_rng(1)
    rows = [(i, day(d), *map(float, r.normal(size=3))) for d in range(2) for i in range(40)]
    df = frame(spark, rows, "entity int, date date, y double, x double, z double")
    for xs in (["x"], ["x", "z"]):
        got = column(steps.cross_section_regress(df, "y", xs, "o"), "o", "date", "entity")
        want = []
        for d in range(2):
            m = np.array([q[2:] for q in rows[d * 40 : d * 40 + 40]])
            a = np.column_stack([m[:, 1 : 1 + len(xs)], np.ones(40)])
            want += list(m[:, 0] - a @ np.linalg.lstsq(a, m[:, 0], rcond=None)[0])
        assert np.allclose(got, want)
    assert set(column(steps.cross_section_regress(df, "y", ["x"], "o", min_samples=50), "o", "entity")) == {None}


def test_rolling_regression_against_polyfit_with_gaps(spark):
    r = np.random.default_rng(2)
    v = r.normal(size=(40, 4))
    v[7, 0] = np.nan
    rows = [("A", day(i), *(None if np.isnan(x) else float(x) for x in v[i])) for i in range(40)]
    df = frame(spark, rows, "entity string, date date, r1 double, r2 double, i1 double, i2 double")
    got = column(steps.rolling_ts_regress(df, "r1", "r2", "i1", "i2", "o", 20), "o", "date")
    assert got[:19] == [None] * 19
    for t in range(19, 40):
        w = v[t - 19 : t + 1]
        y, x = np.r_[w[:, 0], w[:, 1]], np.r_[w[:, 2], w[:, 3]]
        b, a = np.polyfit(x[~np.isnan(y)], y[~np.isnan(y)], 1)
        d = (w[:, 0] - a - b * w[:, 2]) - (w[:, 1] - a - b * w[:, 3])
        d = d[~np.isnan(d)]
        assert got[t] == pytest.approx(d.mean() / (d.std(ddof=1) / np.sqrt(len(d))), abs=1e-8)


def test_as_of_ties_and_default(spark):
    rows = frame(spark, [("A", day(0)), ("A", day(2)), ("A", day(5)), ("B", day(1))], "entity string, date date")
    ev = frame(spark, [("A", day(2), 2.0), ("A", day(3), 3.0)], "entity string, date date, f double")
    assert column(steps.as_of(rows, ev, "f", default=1.0), "f", "entity", "date") == [1.0, 2.0, 3.0, 1.0]


def test_trailing_interval(spark):
    days = frame(spark, [("A", day(10))], "entity string, date date")
    ev = frame(spark, [("A", day(i), i) for i in range(20)], "entity string, date date, k int")
    assert sorted(column(steps.trailing(days, ev, 4), "k", "k")) == [7, 8, 9, 10]


def test_neutralize_against_dummies(spark):
    r = np.random.default_rng(3)
    n, g = 60, 6
    size, y, ind = r.uniform(20, 5000, n), r.normal(size=n), np.arange(n) % g
    df = frame(spark, [(i, day(0), float(y[i]), float(size[i]), int(ind[i])) for i in range(n)], "entity int, date date, y double, size double, industry int")
    got = column(evaluation.neutralize(df, "y", "size", "industry"), "neutral", "entity")
    a = np.column_stack([np.log(size), np.eye(g)[ind]])
    assert np.allclose(got, y - a @ np.linalg.lstsq(a, y, rcond=None)[0])


def test_forward_return_and_ic(spark):
    prices = frame(spark, [(e, day(i), 100 * 1.01**i) for e in "AB" for i in range(10)], "entity string, date date, close double")
    got = [r.ret for r in evaluation.forward_returns(prices, [1]).orderBy("entity", "date").collect()][:8]
    assert np.allclose(got, 0.01)
    r = np.random.default_rng(4)
    df = frame(spark, [(i, day(d), float(x), -float(x)) for d in range(3) for i, x in enumerate(r.normal(size=30))], "entity int, date date, f double, g double")
    assert np.allclose([x.ic for x in evaluation.ic_series(df, "f", "f", ["date"]).collect()], 1)
    assert np.allclose([x.ic for x in evaluation.ic_series(df, "f", "g", ["date"]).collect()], -1)


def test_layers_are_monotone(spark):
    r = np.random.default_rng(5)
    df = frame(spark, [(i, day(d), float(i), 0.001 * i + 0.0001 * float(r.normal())) for d in range(20) for i in range(50)], "entity int, date date, f double, ret double")
    stats = {x.layer: x.ann_return for x in evaluation.layer_stats(evaluation.layers(df, "f", "ret")).collect()}
    assert stats[0] < stats[1] < stats[2] < stats[3] < stats[4] and stats[-1] > 0


def test_revisions_follow_a_moving_baseline(spark):
    df = frame(spark, [("A", "x", day(i), v) for i, v in enumerate([100.0, 100.5, 101.5, 101.0, 90.0])], "entity string, lead string, date date, v double")
    got = {r.date: r.change for r in events.revisions(df, "v", ["entity", "lead"]).collect()}
    assert got == {day(2): pytest.approx(0.015), day(4): pytest.approx((90 - 101.5) / 101.5)}


def test_average_linkage():
    assert sorted(map(sorted, evaluation.average_linkage(["a", "b", "c"], {("a", "b"): 0.9, ("a", "c"): 0.1, ("b", "c"): 0.2}))) == [["a", "b"], ["c"]]


def test_spec_validation_and_run(spark):
    good = {"factor": {"name": "f", "column": "r"}, "calculation_steps": [
        {"action": "fetch", "api": "get_factor", "fields": ["x"], "output_columns": {"x": "x"}},
        {"action": "transform", "method": "diff", "source_column": "x", "output_column": "d"},
        {"action": "rank", "source_column": "d", "output_column": "r", "group_by": ["date"], "pct": True},
    ]}
    df = frame(spark, [(e, day(i), float(i * m)) for m, e in enumerate("ABC") for i in range(3)], "entity string, date date, x double")
    out = spec.run(good, spec.Context({"daily": df}))
    assert out.columns == ["entity", "date", "r"] and out.where("r is null").count() == 3
    steps_ = good["calculation_steps"]
    for bad in (
        {"factor": {"name": "f"}, "calculation_steps": steps_},
        good | {"calculation_steps": []},
        good | {"calculation_steps": [*steps_, {"action": "nothing"}]},
        good | {"calculation_steps": [*steps_, steps_[1]]},
        good | {"calculation_steps": [steps_[0], {**steps_[1], "source_column": "absent"}]},
        good | {"factor": {"name": "f", "column": "absent"}},
        good | {"calculation_steps": [*steps_, steps_[0]]},
    ):
        with pytest.raises(spec.SpecError):
            spec.validate(bad)
