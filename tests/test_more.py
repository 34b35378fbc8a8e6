"""Specifications that run, sources and sinks, learning, the command line."""

import datetime as dt
import glob
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quantloom.__main__ import options, run
from quantloom.functions import expr
from quantloom.operators import events, learning, minute, steps
from quantloom.operators import evaluation as ev
from quantloom.plans import spec
from quantloom.plans.recipes import recipes
from quantloom.sources import tables
from quantloom.streaming import incremental


def day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


@pytest.fixture(scope="module")
def bars(spark):
    r = np.random.default_rng(0)
    rows = [(f"e{k}", day(i), *map(float, r.uniform(9, 11, 4)), float(r.integers(1, 99)), float(r.uniform(1, 9))) for k in range(12) for i in range(40)]
    return spark.createDataFrame(rows, "entity string, date date, open double, high double, low double, close double, volume double, turnover double").cache()


def bar_minutes(spark, days):
    r = np.random.default_rng(1)
    rows = [(f"e{k}", day(i), m, *map(float, r.uniform(9, 11, 4)), float(r.integers(1, 99)), float(r.uniform(1, 9))) for k in range(3) for i in range(days) for m in (570, 600, 690, 780, 850, 900)]
    return spark.createDataFrame(rows, "entity string, date date, minute int, open double, high double, low double, close double, volume double, turnover double").cache()


def test_all_recipes_validate_and_run(spark, bars):
    fields = {f"{n}_q{k}": F.col("close") + k for n in ("profit", "equity") for k in range(9)} | {c: F.col("close") for c in ("pe", "pb", "cap", "profit_ttm", "cash_flow_ttm", "roic")}
    daily = bars.withColumns(fields).withColumn("industry", F.lit("x"))
    made = recipes()
    assert len(made) == 22
    for r in made.values():
        assert spec.run(spec.validate(r), spec.Context({"daily": daily})).columns == ["entity", "date", r["factor"]["column"]]


def test_specs_use_their_own_key_names_and_refuse_what_cannot_run(spark, bars):
    steps_ = [{"name": "prices", "action": "fetch", "api": "get_factor", "fields": "close", "output_column": "close"}, {"action": "rolling", "source_column": "close", "output_column": "m", "window": 3, "agg": "mean", "group_by": "code"}]
    recipe = {"factor": {"name": "m", "column": "m"}, "calculation_steps": steps_}
    with pytest.raises(spec.SpecError, match="code"):
        spec.validate(recipe)
    got = spec.run(recipe, spec.Context({"daily": bars}, bars.select("entity").where("entity = 'e1'"), "2024-01-05", None, {"code": "entity"}))
    assert got.count() == 36 and got.where("m is not null").count() == 34
    for bad in ({"api": "nothing"}, {"api": "custom"}):
        with pytest.raises(spec.SpecError):
            spec.validate({"factor": {"name": "x", "column": "close"}, "calculation_steps": [steps_[0] | bad]})
    with pytest.raises(spec.SpecError):
        spec.validate({"factor": {"name": "x", "column": "close"}, "calculation_steps": [steps_[0], {"action": "filter", "condition": "other > 0"}]})
    one = {"factor": {"name": "x", "column": "close"}, "calculation_steps": [steps_[0] | {"date": "2024-01-07"}]}
    assert spec.run(one, spec.Context({"daily": bars})).count() == 12


def test_minute_steps_take_dates_universe_and_adjustment(spark):
    m = bar_minutes(spark, 8)
    recipe = {"factor": {"name": "r", "column": "ret_overnight"}, "calculation_steps": [{"action": "minute_apm_segments", "cache_key": "k", "features": ["ret_overnight"], "min_bars": 1}]}
    whole = {(r.entity, r.date): r.ret_overnight for r in spec.run(recipe, spec.Context({"minutes": m})).collect()}
    part = spec.run(recipe, spec.Context({"minutes": m}, m.select("entity").where("entity <> 'e2'"), "2024-01-04", "2024-01-06")).collect()
    assert len(part) == 6 and all(whole[r.entity, r.date] == r.ret_overnight is not None for r in part)
    split = spark.createDataFrame([("e0", day(4), 2.0)], "entity string, date date, cum_factor double")
    adjusted = {(r.entity, r.date): r.ret_overnight for r in spec.run(recipe, spec.Context({"minutes": m, "factors": split})).collect()}
    assert adjusted["e0", day(4)] == pytest.approx(2 * (whole["e0", day(4)] + 1) - 1) and adjusted["e1", day(4)] == whole["e1", day(4)]


def test_index_series_come_by_date(spark, bars):
    seg = [{"action": "fetch", "api": "get_factor", "fields": ["open", "close"], "output_columns": {"open": "a", "close": "b"}}, {"action": "rolling_ts_regress", "source_column_seg1": "a", "source_column_seg2": "b", "index_col_seg1": "ia", "index_col_seg2": "ib", "window": 10, "output_column": "stat", "group_by": "entity"}]
    index = bars.groupBy("date").agg(F.avg("open").alias("ia"), F.avg("close").alias("ib"))
    got = spec.run({"factor": {"name": "s", "column": "stat"}, "calculation_steps": seg}, spec.Context({"daily": bars, "index_series": index}))
    assert got.where("stat is not null").count() == 12 * 31


def test_revisions_match_a_plain_loop(spark):
    r = np.random.default_rng(3)
    rows = [(e, a, day(int(d)), float(v)) for e in "AB" for a in "xy" for d, v in zip(r.integers(0, 60, 40), r.uniform(90, 110, 40), strict=True)]
    got = {(x.entity, x.lead, x.date): x.change for x in events.revisions(spark.createDataFrame(rows, "entity string, lead string, date date, v double"), "v", ["entity", "lead"], least=0.03).collect()}
    want = {}
    for e in "AB":
        for a in "xy":
            last = {}
            for ee, aa, d, v in rows:
                if (ee, aa) == (e, a):
                    last[d] = max(v, last.get(d, -1))
            base = None
            for d in sorted(last):
                if base is None:
                    base = last[d]
                    continue
                change = (last[d] - base) / abs(base)
                if abs(change) >= 0.03:
                    want[e, a, d] = pytest.approx(change)
                    base = last[d]
    assert got == want and len(want) > 20


def test_sinks_and_catalogue(spark, bars, tmp_path):
    root = f"{tmp_path}/panels"
    p = bars.select("entity", "date", F.when(F.col("close") > 10, F.col("close")).alias("value"))
    assert tables.write_panel(p, root, "raw", "s", "g", "f1") and not tables.write_panel(p, root, "raw", "s", "g", "f1", skip_existing=True)
    tables.write_panel(p, root, "cleaned", "s", "g", "f1")
    tables.write_panel(p, root, "raw", "s", "g", "g2")
    assert {tuple(r) for r in tables.discover(spark, root, "f%").collect()} == {("raw", "s", "g", "f1"), ("cleaned", "s", "g", "f1")}
    assert tables.read_panels(spark, root, "f%").count() == p.where("value is not null").count()
    days = f"{tmp_path}/days"
    tables.write_days(bars.where("date < '2024-01-10'"), days)
    tables.write_days(bars.withColumn("close", F.lit(0.0)), days)
    got = spark.read.parquet(days)
    assert got.count() == bars.count() and got.where("close = 0").select("date").distinct().count() == 31
    tables.write_partitioned(bars.where("date = '2024-01-03'"), f"{tmp_path}/p")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 12
    ranked = ev.top_n(bars, "close", 2)
    tables.write_signal(ranked, f"{tmp_path}/signal")
    (one,) = [f for f in glob.glob(f"{tmp_path}/signal/day=2024-01-02/*.txt")]
    assert len(open(one).read().split()) == 2 and open(one).read().startswith("2024-01-02_e")
    tables.write_signal(ranked, f"{tmp_path}/merged", merged=True)
    lines = [x for f in sorted(glob.glob(f"{tmp_path}/merged/*.txt")) for x in open(f).read().split()]
    assert lines == sorted(lines, key=lambda x: x[:10]) and len(lines) == 80
    for stamp in ("1", "2"):
        tables.write_report(spark.createDataFrame([(stamp, 1.23456)], "k string, x double"), f"{tmp_path}/report", stamp=stamp)
    assert [tuple(r) for r in tables.latest(spark, f"{tmp_path}/report").collect()] == [("2", "1.2346")]
    assert tables.cache_path("r", "k", {"a": 1}) == tables.cache_path("r/", "k", {"a": 1}) != tables.cache_path("r", "k", {"a": 2})
    assert tables.labels_or(spark, f"{tmp_path}/none", lambda: bars).count() == bars.count()


def test_sources(spark, bars):
    fetch = lambda ids: pd.DataFrame({"entity": ids, "x": [float(len(ids))] * len(ids)})
    got = tables.batches(fetch, [f"i{k}" for k in range(11)], spark, "entity string, x double", 4)
    assert sorted(r.x for r in got.collect()) == [3.0] * 3 + [4.0] * 8
    a = {tuple(r) for r in tables.sampled(bars, ["entity", "date"], 0.3).select("entity", "date").collect()}
    b = {tuple(r) for r in tables.sampled(bars.repartition(7), ["entity", "date"], 0.3).select("entity", "date").collect()}
    assert a == b and 80 < len(a) < 220
    odd = spark.createDataFrame([("a", "2024-01-01", float("nan")), ("b", "2024-01-01", float("inf")), ("c", "2024-01-01", 1.0)], "code string, day string, x double")
    assert [r.x for r in tables.normalise(odd, "code", "day", ["x"]).orderBy("entity").collect()] == [None, None, 1.0]
    grid = ev.grid(bars.where("entity in ('e1', 'e2')").limit(3))
    assert grid.columns == ["date", "entity"]
    assert expr.names_in("log(a) + b") == {"a", "b"}


def test_masks_read_the_next_day_of_the_calendar(spark):
    rows = [("a", day(0), False), ("a", day(1), True), ("a", day(2), False), ("b", day(0), False), ("b", day(2), True)]
    flags = spark.createDataFrame(rows, "entity string, date date, is_st boolean").withColumns({c: F.lit(False) for c in ("is_suspended", "is_new_stock", "is_limit_up")})
    got = {(r.entity, r.date): r.pre for r in ev.masks(flags).collect()}
    assert got == {("a", day(0)): False, ("a", day(1)): True, ("a", day(2)): True, ("b", day(0)): True, ("b", day(2)): True}


def test_learning_keeps_what_predicts(spark, tmp_path):
    r = np.random.default_rng(5)
    rows = [(f"e{k}", day(i), float(x := r.normal()), float(r.normal()), 2 * x + float(r.normal(0, 0.1))) for k in range(20) for i in range(60)]
    df = spark.createDataFrame(rows, "entity string, date date, good double, noise double, label double").cache()
    long = df.unpivot(["entity", "date"], ["good", "noise"], "factor", "value")
    mask = df.select("entity", "date", F.lit(True).alias("pre"))
    data = learning.build_dataset(long, mask, df.select("entity", "date", "label"), ["good", "noise"], "2024-01-30", "2024-02-15", 0)
    model = learning.train_boosted(data, ["good", "noise"], rounds=8, depth=3, rate=0.3)
    (best, share), *_ = learning.top_features(model, ["good", "noise"], 1)
    assert best == "good" and share > 0.9
    ic = learning.model_ic(learning.predict(model, data.where("segment = 'test'"), ["good", "noise"]), 10).first()
    assert ic.ic_mean > 0.9 and ic.n_days > 10
    scaler = learning.scaler_table(df.where("date <= '2024-01-30'"), ["good", "noise"])
    learning.save(model, scaler, ["good", "noise"], str(tmp_path))
    model, scaler, names = learning.load(spark, str(tmp_path))
    live = learning.predict_live(model, scaler, long, mask, names, "2024-02-20")
    assert names == ["good", "noise"] and live.count() == 20 * 10


def test_reducers_moments_and_sessions(spark):
    row = spark.range(1).select(*(v.alias(k) for k, v in minute.moment_stats(*map(F.lit, (4.0, 10.0, 30.0, 100.0, 354.0))).items())).first()
    x = np.array([1.0, 2.0, 3.0, 4.0])
    assert row["std"] == pytest.approx(x.std(ddof=1)) and row["skew"] == pytest.approx(0) and row["kurt"] == pytest.approx(((x - 2.5) ** 4).mean() / x.var() ** 2)
    ts = dt.datetime(2024, 1, 1)
    e = spark.createDataFrame([(ts, 1), (ts + dt.timedelta(minutes=10), 1), (ts + dt.timedelta(hours=2), 1)], "ts timestamp, user_id int")
    assert sorted(r.n for r in incremental.sessions(e).collect()) == [1, 2]


def test_two_regressors_by_sums_and_collinear_ones(spark):
    r = np.random.default_rng(9)
    rows = [(f"e{k}", day(i), *map(float, r.normal(size=3))) for i in range(3) for k in range(40)]
    df = spark.createDataFrame(rows, "entity string, date date, y double, a double, b double").withColumn("c", 2 * F.col("a"))
    for xs, intercept in ((["a", "b"], True), (["a", "b"], False), (["a", "c"], True)):
        got = {(x.entity, x.date): x.o for x in steps.cross_section_regress(df, "y", xs, "o", intercept).collect()}
        for d in {row[1] for row in rows}:
            part = [row for row in rows if row[1] == d]
            cols = {"a": [p[3] for p in part], "b": [p[4] for p in part], "c": [2 * p[3] for p in part]}
            m = np.column_stack([cols[x] for x in xs] + [np.ones(len(part))] * intercept)
            y = np.array([p[2] for p in part])
            for p, want in zip(part, y - m @ np.linalg.lstsq(m, y, rcond=None)[0], strict=True):
                assert got[p[0], d] == pytest.approx(want)


def test_command_line(spark, bars, tmp_path):
    data = f"{tmp_path}/data"
    daily = bars.withColumn("vwap", F.col("close"))
    daily.write.parquet(f"{data}/daily.parquet")
    bars.select("entity", "date", *(F.lit(False).alias(c) for c in ("is_st", "is_suspended", "is_new_stock", "is_limit_up"))).write.parquet(f"{data}/flags.parquet")
    bars.select("entity", "date", F.col("volume").alias("size"), F.lit("x").alias("industry")).write.parquet(f"{data}/styles.parquet")
    bar_minutes(spark, 4).write.parquet(f"{data}/minutes.parquet")
    recipe = {"factor": {"name": "d", "column": "d"}, "calculation_steps": [{"action": "fetch", "api": "get_factor", "fields": "close", "output_column": "close"}, {"action": "transform", "method": "diff", "source_column": "close", "output_column": "d"}]}
    (tmp_path / "spec.json").write_text(json.dumps(recipe))
    call = lambda *a: run(spark, options([*a[:1], "--data", data, *a[1:]]))
    panels = f"{tmp_path}/panels"
    assert call("factor", "--out", panels, "--spec", str(tmp_path / "spec.json")) == ["d"]
    assert call("library", "--out", panels, "--only", "kmid", "ma5", "d") == ["kmid", "ma5"]
    assert call("library", "--out", panels, "--only", "kmid", "std5", "--dry-run") == ["std5"]
    stored = f"{panels}/stage=raw/source=spec/grp=own/factor=d"
    call("evaluate", "--out", f"{tmp_path}/report", "--panel", stored, "--min-samples", "5")
    assert spark.read.json(f"{tmp_path}/report").count() == 6
    call("signal", "--out", f"{tmp_path}/signal", "--panel", stored, "--top", "3", "--start", "2024-01-10")
    assert len(glob.glob(f"{tmp_path}/signal/day=*")) == 31
    call("refresh", "--out", f"{tmp_path}/cache")
    assert spark.read.parquet(f"{tmp_path}/cache").count() == 12


def test_quantiles_and_scales_of_whole_columns(spark):
    r = np.random.default_rng(11)
    cols = {"a": r.normal(size=501), "b": np.repeat([1.0, 2.0, 3.0], 167), "c": np.r_[r.normal(size=500), 1e9]}
    df = spark.createDataFrame([(i, *map(float, v), None) for i, v in enumerate(zip(*cols.values(), strict=True))], "k int, a double, b double, c double, d double").repartition(5)
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        got = {x.feature: x.value for x in ev.exact_quantile(df, ["a", "b", "c", "d"], q, 16).collect()}
        assert set(got) == {"a", "b", "c"} and all(got[n] == pytest.approx(np.quantile(v, q)) for n, v in cols.items())
    scaled = {x.k: x for x in ev.robust_scale(df, ["a", "d"], F.col("k") < 300).collect()}
    train = cols["a"][:300]
    mad = np.median(np.abs(train - np.median(train)))
    assert all(scaled[i].a == pytest.approx((v - np.median(train)) / (1.4826 * mad)) and scaled[i].d is None for i, v in enumerate(cols["a"]))
    assert ev.robust_scale(df, ["a"], F.lit(False)).where("a is null").count() == 501
