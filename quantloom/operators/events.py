"""Event-driven producers (analyst reports and the like) and industry co-momentum."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.expr import div, ln
from .steps import as_of, cross_section_regress, keep_last, trailing


def forward_profit(date: Column, report_year: Column, t1: Column, t2: Column, t3: Column) -> Column:
    """Next twelve months' profit: this and next fiscal year's forecasts weighed by the days left in the year."""
    off = F.year(date) - report_year
    at = lambda k: F.when(off + k == 1, t1).when(off + k == 2, t2).when(off + k == 3, t3)
    left = F.greatest(F.least(F.datediff(F.make_date(F.year(date), F.lit(12), F.lit(31)), date) / 365.0, F.lit(1.0)), F.lit(0.0))
    return left * at(0) + (1 - left) * at(1)


def clean_reports(reports: DataFrame) -> DataFrame:
    """code: the id's digits, padded to six; lead: the first author."""
    return reports.withColumn("code", F.lpad(F.regexp_extract("report_main_id", r"(\d+)", 1), 6, "0")).withColumn("lead", F.trim(F.get(F.split("author", ","), F.lit(0)))).where("lead <> ''")


def revisions(reports: DataFrame, value: str, keys: list[str], date: str = "date", least: float = 0.01) -> DataFrame:
    """Per report its change against the analyst's baseline, which moves only when the change is large enough.

    The baseline depends on all reports before, so a key's reports are folded in order, the one serial operator. Tasks take
    their keys' reports as a sorted stream and carry one baseline; no key's list is held.
    """
    last = keep_last(reports, [*keys, date], [value]).select(*keys, F.col(date).cast("date").alias("date"), F.col(value).cast("double").alias("v"))
    ordered = last.repartition(*keys).sortWithinPartitions(*keys, "date")
    schema = StructType([*ordered.schema.fields, StructField("change", DoubleType())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, base = None, None
        for b in batches:
            changes = []
            for *k, v in zip(*(b.column(i).to_pylist() for i in range(len(keys))), b.column(len(keys) + 1).to_pylist(), strict=True):
                if k != key:
                    key, base = k, None
                change = (v - base) / abs(base) if base and v is not None else None
                moved = base is None or change is not None and abs(change) >= least
                changes.append(change if moved else None)
                base = v if moved else base
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(changes, pa.float64())], names=schema.names)

    return ordered.mapInArrow(fold, schema).where("change is not null")


def snapshots(events: DataFrame, value: str, lookback: int = 180, least_leads: int = 3) -> DataFrame:
    """At each event date of an entity, the mean of each lead's latest view within the look-back."""
    days = events.select("entity", "date").distinct()
    seen = trailing(days, events.select("entity", "date", "lead", value), lookback)
    latest = seen.groupBy("entity", "date", "lead").agg(F.max_by(value, "event_date").alias("v"))
    return latest.groupBy("entity", "date").agg(F.count("v").alias("n_leads"), F.avg("v").alias("view")).where(F.col("n_leads") >= least_leads)


def daily_view(days: DataFrame, snaps: DataFrame, lookback: int = 180) -> DataFrame:
    """Snapshots carried to every day until they expire."""
    s = snaps.withColumn("_e", F.struct(F.col("date").alias("d"), F.col("view").alias("v")))
    on = as_of(days, s, "_e")
    return on.select(*days.columns, F.when(F.datediff(F.col("date"), F.col("_e.d")) < lookback, F.col("_e.v")).alias("view"))


def lead_counts(days: DataFrame, events: DataFrame, width: int = 90) -> DataFrame:
    """Distinct leads in the trailing days at each month's last day in `days`."""
    ends = days.groupBy("entity", F.trunc("date", "month").alias("_m")).agg(F.max("date").alias("date")).drop("_m")
    seen = trailing(ends, events.select("entity", "date", "lead"), width)
    return seen.groupBy("entity", "date").agg(F.countDistinct("lead").alias("leads"))


def filled_counts(days: DataFrame, events: DataFrame, width: int = 90) -> DataFrame:
    """Counts at month ends, carried to the entity's days up to its last month end."""
    counts = lead_counts(days, events, width)
    end = counts.groupBy("entity").agg(F.max("date").alias("_end"))
    return as_of(days.join(end, "entity"), counts, "leads").where((F.col("date") <= F.col("_end")) & F.col("leads").isNotNull()).drop("_end")


def revision_panel(days: DataFrame, snaps: DataFrame, lookback: int = 180, ahead: int = 1) -> DataFrame:
    """Daily views of a fiscal year's snapshots (year), each while it is that year: from May to April.

    ahead 1 is the first fiscal year not reported yet, 2 the one after. Views expire after the look-back.
    """
    d = days.withColumn("year", F.year("date") - F.when(F.month("date") < 5, 1).otherwise(0) + (ahead - 1))
    keyed = lambda df: df.withColumn("_key", F.struct("entity", "year"))
    s = keyed(snaps).withColumn("_e", F.struct(F.col("date").alias("d"), F.col("view").alias("v"))).select("_key", "date", "_e")
    on = as_of(keyed(d), s, "_e", entity="_key")
    return on.select("entity", "date", "year", F.when(F.datediff(F.col("date"), F.col("_e.d")) < lookback, F.col("_e.v")).alias("view")).where("view is not null")


def this_year_profit(date: Column, report_year: Column, t1: Column, t2: Column, t3: Column) -> Column:
    """The forecast of the calendar year itself, where it is positive."""
    off = F.year(date) - report_year
    value = F.when(off == 1, t1).when(off == 2, t2).when(off == 3, t3)
    return F.when(value > 0, value)


def price_to_forecast(df: DataFrame, cap: str, profit: Column, output: str, unit: float = 1e8) -> DataFrame:
    """Market value (in units) over a positive forecast profit."""
    return df.withColumn(output, F.when(profit > 0, F.col(cap) * unit / profit))


def change_of_log(df: DataFrame, source: str, output: str, periods: int = 60) -> DataFrame:
    w = Window.partitionBy("entity").orderBy("date")
    x = ln(F.col(source))
    return df.withColumn("_x", x).withColumn(output, F.col("_x") - F.lag("_x", periods).over(w)).drop("_x")


def duration_adjusted(df: DataFrame, value: str, years: str, output: str, periods: int = 60, min_samples: int = 30) -> DataFrame:
    """Residual of a ratio's change on that of the forecasts' duration, by date."""
    df = change_of_log(change_of_log(df, value, "_dv", periods), years, "_dd", periods)
    return cross_section_regress(df, "_dv", ["_dd"], output, min_samples=min_samples).drop("_dv", "_dd")


def duration(n1: Column, n2: Column, n3: Column) -> Column:
    return div(n1 + 2 * n2 + 3 * n3, n1 + n2 + n3)


def single_quarter(cumulative: DataFrame, value: str = "net_profit") -> DataFrame:
    """Quarter's own value from year-to-date values: less the highest of the year's earlier quarters."""
    w = Window.partitionBy("entity", F.substring("quarter", 1, 4)).orderBy("quarter").rowsBetween(Window.unboundedPreceding, -1)
    return cumulative.withColumn("single", F.col(value) - F.coalesce(F.max(value).over(w), F.lit(0.0)))


def surprise(actuals: DataFrame, forecasts: DataFrame, width: int = 90, least_leads: int = 3) -> DataFrame:
    """(actual - mean of the leads' last forecasts before it) / |mean|; forecasts of [T - width, T)."""
    day = actuals.select("entity", F.date_sub("info_date", 1).alias("date"), "info_date", "actual")
    seen = trailing(day, forecasts.select("entity", "date", "lead", "forecast"), width)
    last = seen.groupBy("entity", "info_date", "actual", "lead").agg(F.max_by("forecast", "event_date").alias("f"))
    g = last.groupBy("entity", "info_date", "actual").agg(F.count("f").alias("n"), F.avg("f").alias("f")).where(F.col("n") >= least_leads)
    return g.select("entity", "info_date", div(F.col("actual") - F.col("f"), F.abs("f")).alias("surprise"))


def co_momentum(df: DataFrame, sub_factor: str, output: str, ret: str = "ret", turnover: str = "amount", signal: str = "signal", window: int = 20, n_mom: int = 5, n_rev: int = 15) -> DataFrame:
    """Signal return on an entity's best days of the window, on its worst, or the difference; half-life weights.

    Days are ranked by return (ICM) or return times turnover; among equal days the later stands first at the
    top and the earlier at the bottom. Any gap in the window gives NULL.
    """
    w = Window.partitionBy("entity").orderBy("date")
    frame = w.rowsBetween(1 - window, 0)
    key = F.col(ret) if sub_factor == "ICM" else F.col(ret) * F.col(turnover)
    df = df.withColumn("_p", F.row_number().over(w)).withColumn("_k", key)
    day = F.struct(F.col("_k").alias("k"), F.col("_p").alias("p"), F.col(signal).alias("s"))
    ok = F.col("_k").isNotNull() & F.col(signal).isNotNull()
    days = F.sort_array(F.collect_list(F.when(ok, day)).over(frame))
    full = F.count(F.when(ok, F.lit(1))).over(frame) == window

    def weighed(part: Column, n: int) -> Column:
        weights = [2.0 ** (-i / (n - 1)) if n > 1 else 1.0 for i in range(n)]
        return F.aggregate(F.zip_with(part, F.array(*map(F.lit, weights)), lambda d, x: d["s"] * x), F.lit(0.0), lambda a, b: a + b)

    # Ascending by key and place: reversed for the top, as it is for the bottom.
    df = df.withColumn("_days", F.when(full, days))
    top = weighed(F.slice(F.reverse("_days"), 1, n_mom), n_mom)
    bottom = weighed(F.slice("_days", 1, n_rev), n_rev)
    made = {"ICM": top, "VICM": top, "VICR": bottom, "CMC": top - bottom}[sub_factor]
    return df.withColumn(output, F.when(F.col("_days").isNotNull(), made)).drop("_p", "_k", "_days")
