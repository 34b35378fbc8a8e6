"""Declarative specifications: a list of steps over named frames, checked first, then folded into one plan.

`validate` knows the columns of every frame after every step and refuses unknown actions, columns that
don't exist yet and columns that exist already. `run` never triggers an action.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import names_in
from ..operators import events, minute, steps
from ..sources import tables

KEYS = {"entity", "date"}


class SpecError(ValueError):
    pass


@dataclass
class Context:
    """tables: what can be fetched, by name; frames: what steps have made, `data` being the result's."""

    #: `minutes`, `factors` (entity, date, cum_factor), `calendar` (date) and `index_series` (by date) are used where given.
    tables: dict[str, DataFrame]
    universe: DataFrame | None = None
    start: str | None = None
    end: str | None = None
    #: what a specification calls the key columns, e.g. {"code": "entity"}
    aliases: dict[str, str] = field(default_factory=dict)
    frames: dict[str, DataFrame] = field(default_factory=dict)

    def between(self, df: DataFrame, start: str | None = None) -> DataFrame:
        """Rows of the asked dates and entities; one bound may be missing."""
        for bound, op in ((start or self.start, "__ge__"), (self.end, "__le__")):
            if bound:
                df = df.where(getattr(F.col("date"), op)(F.lit(bound).cast("date")))
        return df if self.universe is None else df.join(F.broadcast(self.universe.select("entity").distinct()), "entity", "left_semi")


Op = Callable[[Context, dict[str, Any]], None]
ACTIONS: dict[str, tuple[Op, Callable[[dict, dict[str, set[str]]], None]]] = {}


def register(name: str, check: Callable[[dict, dict[str, set[str]]], None]) -> Callable[[Op], Op]:
    def put(op: Op) -> Op:
        ACTIONS[name] = (op, check)
        return op

    return put


def target(step: dict) -> str:
    return step.get("output_dataframe", "data")


def sources(step: dict) -> list[str]:
    found: list[str] = []
    for k, v in step.items():
        if k.startswith(("source_column", "index_col")):
            found += [v] if isinstance(v, str) else list(v)
    return found


def as_list(x: str | list[str] | None) -> list[str]:
    return [] if x is None else [x] if isinstance(x, str) else list(x)


def renamed(x: Any, aliases: dict[str, str]) -> Any:
    """A specification with its own names of the key columns replaced."""
    if isinstance(x, dict):
        return {k: renamed(v, aliases) for k, v in x.items()}
    return [renamed(v, aliases) for v in x] if isinstance(x, list) else aliases.get(x, x) if isinstance(x, str) else x


def require(step: dict, *names: str) -> None:
    for n in names:
        if n not in step or step[n] in (None, [], ""):
            raise SpecError(f"{step.get('action')}: {n} is missing")


def check_step(*names: str, by_date: bool = False, makes: bool = False) -> Callable[[dict, dict[str, set[str]]], None]:
    def check(step: dict, known: dict[str, set[str]]) -> None:
        require(step, *names)
        if makes:
            known.setdefault(target(step), set(KEYS))
        if target(step) not in known:
            raise SpecError(f"{step['action']}: no frame {target(step)}")
        columns = known[target(step)]
        named = [*sources(step), *as_list(step.get("group_by")), *as_list(step.get("change_on")), *(names_in(step["condition"]) if "condition" in step else ())]
        # Index series may come by date from a table of their own.
        if missing := [c for c in named if c not in columns and not (by_date and c in as_list(step.get("index_col_seg1")) + as_list(step.get("index_col_seg2")))]:
            raise SpecError(f"{step['action']}: no columns {missing} yet")
        if out := step.get("output_column"):
            if out in columns:
                raise SpecError(f"{step['action']}: {out} is there already")
            columns.add(out)

    return check


def check_fetch(step: dict, known: dict[str, set[str]]) -> None:
    if step.get("api", DEFAULT_API) not in APIS:
        raise SpecError(f"fetch: no api {step['api']}")
    if step.get("api") == "custom":
        require(step, "command", "output_column")
        step = step | {"fields": [step["output_column"]]}
    require(step, "fields")
    if ("output_column" in step) == ("output_columns" in step):
        raise SpecError("fetch: either output_column or output_columns")
    if target(step) in known:
        raise SpecError(f"fetch: frame {target(step)} is there already")
    known[target(step)] = KEYS | set(output_names(step).values()) | set(step.get("keep", ()))


def check_merge(step: dict, known: dict[str, set[str]]) -> None:
    require(step, "target_dataframe", "source_dataframe", "on", "columns")
    a, b = step["target_dataframe"], step["source_dataframe"]
    if a not in known or b not in known:
        raise SpecError(f"merge: no frame {a if a not in known else b}")
    if missing := [c for c in step["on"] if c not in known[a] or c not in known[b]] + [c for c in step["columns"] if c not in known[b]]:
        raise SpecError(f"merge: no columns {missing}")
    if clash := set(step["columns"]) & known[a]:
        raise SpecError(f"merge: {sorted(clash)} are there already")
    known[a] |= set(step["columns"])


def check_minute(step: dict, known: dict[str, set[str]]) -> None:
    require(step, "cache_key", "features")
    if int(step.get("std_window", 1)) <= 0 or float(step.get("std_threshold", 1)) <= 0:
        raise SpecError(f"{step['action']}: std_window and std_threshold must be positive")
    if missing := minute.missing_features(step["action"], step["features"]):
        raise SpecError(f"{step['action']} has no features {missing}")
    columns = known.setdefault(target(step), set(KEYS))
    if clash := set(step["features"]) & columns:
        raise SpecError(f"{step['action']}: {sorted(clash)} are there already")
    columns |= set(step["features"])


def validate(spec: dict, aliases: dict[str, str] | None = None) -> dict:
    spec = renamed(spec, aliases or {})
    factor, todo = spec.get("factor") or {}, spec.get("calculation_steps") or []
    for n in ("name", "column"):
        if not factor.get(n):
            raise SpecError(f"factor.{n} is missing")
    if not todo:
        raise SpecError("calculation_steps is empty")
    known: dict[str, set[str]] = {}
    for step in todo:
        if step.get("action") not in ACTIONS:
            raise SpecError(f"no action {step.get('action')}")
        ACTIONS[step["action"]][1](step, known)
    if factor["column"] not in known.get("data", ()):
        raise SpecError(f"no column {factor['column']} in data")
    return spec


def output_names(step: dict) -> dict[str, str]:
    fields = [step["fields"]] if isinstance(step["fields"], str) else step["fields"]
    names = step.get("output_columns") or {fields[0]: step["output_column"]}
    if set(names) - set(fields):
        raise SpecError(f"fetch: {sorted(set(names) - set(fields))} aren't fetched")
    return names


def run(spec: dict, ctx: Context) -> DataFrame:
    """entity, date and the factor's column."""
    for step in (spec := validate(spec, ctx.aliases))["calculation_steps"]:
        ACTIONS[step["action"]][0](ctx, step)
    return ctx.frames["data"].select("entity", "date", spec["factor"]["column"])


def daily_fields(ctx: Context, step: dict) -> DataFrame:
    """A table's fields for the asked dates, or for one date."""
    df = ctx.tables[step.get("table", "daily")]
    return ctx.between(df) if "date" not in step else ctx.between(df.where(F.col("date") == F.lit(step["date"]).cast("date")))


def quarters(ctx: Context, step: dict) -> DataFrame:
    """Reports by quarter, as of their info date: of each quarter the last version, or all."""
    df = ctx.between(ctx.tables[step.get("table", "financials")])
    for bound, op in (("start_quarter", "__ge__"), ("end_quarter", "__le__")):
        if bound in step:
            df = df.where(getattr(F.col("quarter"), op)(step[bound]))
    return df if step.get("statements", "latest") == "all" else steps.keep_last(df, ["entity", "quarter"], ["info_date"])


def intervals(ctx: Context, step: dict) -> DataFrame:
    """A table of interval starts (entity, date, value) as the value of every day on which the entity has a row."""
    days = ctx.between(ctx.tables[step.get("table", "daily")].select("entity", "date").distinct())
    events = ctx.tables[step["command"]]
    return tables.intervals_to_daily(days, events.select("entity", "date", F.col("value").alias(step["output_column"])), step["output_column"])


DEFAULT_API = "get_pit_financials_ex"
APIS = {"get_factor": daily_fields, "get_pit_financials_ex": quarters, "custom": intervals}


@register("fetch", check_fetch)
def fetch(ctx: Context, step: dict) -> None:
    df = APIS[step.get("api", DEFAULT_API)](ctx, step)
    names = {step["output_column"]: step["output_column"]} if step.get("api") == "custom" else output_names(step)
    ctx.frames[target(step)] = df.select("entity", "date", *(F.col(a).alias(b) for a, b in names.items()), *step.get("keep", ()))


def simple(name: str, fn: Callable[..., DataFrame], needs: tuple[str, ...], rename: dict[str, str]) -> None:
    """A step whose parameters are those of fn, under other names."""

    @register(name, check_step(*needs))
    def op(ctx: Context, step: dict) -> None:
        args = {rename.get(k, k): v for k, v in step.items() if k not in ("action", "name", "output_dataframe")}
        ctx.frames[target(step)] = fn(ctx.frames[target(step)], **args)


OUT = {"output_column": "output", "source_column": "source"}
simple("compute", steps.compute, ("formula", "source_columns", "output_column"), {"output_column": "output"})
simple("filter", steps.filter_rows, ("condition",), {})
simple("transform", steps.transform, ("method", "source_column", "output_column"), OUT)
simple("rank", steps.rank_step, ("source_column", "output_column", "group_by"), OUT)
simple("rolling", steps.rolling_step, ("source_column", "output_column", "window"), OUT)
simple("row_aggregate", steps.row_aggregate, ("source_columns", "output_column", "agg"), OUT | {"source_columns": "sources"})
simple("row_polyfit", steps.row_polyfit, ("source_columns_y", "coefficient", "output_column"), OUT | {"source_columns_y": "sources"})
simple("row_correlate", steps.row_correlate, ("source_columns_a", "source_columns_b", "output_column"), OUT | {"source_columns_a": "a", "source_columns_b": "b"})
simple("cross_section_regress", steps.cross_section_regress, ("source_column_y", "source_columns_x", "output_column"), OUT | {"source_column_y": "y", "source_columns_x": "xs", "date_column": "date", "group_column": "group"})
@register("rolling_ts_regress", check_step("source_column_seg1", "source_column_seg2", "index_col_seg1", "index_col_seg2", "output_column", by_date=True))
def rolling_ts_regress(ctx: Context, step: dict) -> None:
    df = ctx.frames[target(step)]
    if by_date := [c for c in (step["index_col_seg1"], step["index_col_seg2"]) if c not in df.columns]:
        # One row a date.
        df = df.join(F.broadcast(ctx.tables["index_series"].select("date", *by_date)), "date", "left")
    args = {k: step[k] for k in ("window", "min_obs", "group_by") if k in step}
    ctx.frames[target(step)] = steps.rolling_ts_regress(df, step["source_column_seg1"], step["source_column_seg2"], step["index_col_seg1"], step["index_col_seg2"], step["output_column"], **args).drop(*by_date)


@register("merge", check_merge)
def merge(ctx: Context, step: dict) -> None:
    a, b = step["target_dataframe"], step["source_dataframe"]
    ctx.frames[a] = steps.merge(ctx.frames[a], ctx.frames[b], step["on"], step["columns"], step.get("how", "left"))


@register("load_panel", check_step("panel_config", "output_column"))
def load_panel(ctx: Context, step: dict) -> None:
    panel = ctx.tables[step["panel_config"]].select("entity", "date", F.col("value").alias(step["output_column"]))
    ctx.frames[target(step)] = steps.merge(ctx.frames[target(step)], panel, ["entity", "date"], [step["output_column"]])


@register("industry_co_momentum", check_step("sub_factor", "signal_source", "output_column", makes=True))
def industry_co_momentum(ctx: Context, step: dict) -> None:
    """On the frame there is, or on the table `returns` (entity, date, ret, amount and what the signal is keyed by)."""
    signal = ctx.tables[step["signal_source"]]
    df = ctx.frames[target(step)] if target(step) in ctx.frames else ctx.between(ctx.tables["returns"])
    df = df.join(signal, [c for c in signal.columns if c in df.columns], "left")
    args = {k: step[k] for k in ("window", "n_mom", "n_rev") if k in step}
    ctx.frames[target(step)] = events.co_momentum(df, step["sub_factor"], step["output_column"], **args)


def minute_window(ctx: Context, warm_up: int) -> DataFrame:
    """Minutes of the asked dates and entities, `warm_up` trading days before them included, prices adjusted."""
    df = ctx.tables["minutes"]
    df = ctx.between(df) if not ctx.start else ctx.between(df, "0001-01-01")
    if ctx.start:
        calendar = ctx.tables["calendar"] if "calendar" in ctx.tables else df.select("date").distinct()
        ahead = F.row_number().over(Window.orderBy(F.desc("date")))
        # One row a trading day before the start.
        first = calendar.where(F.col("date") < F.lit(ctx.start).cast("date")).withColumn("_k", ahead).where(F.col("_k") <= warm_up).select("date")
        after = calendar.where(F.col("date") >= F.lit(ctx.start).cast("date")).select("date")
        df = df.join(F.broadcast(first.unionByName(after).distinct()), "date", "left_semi")
    if "factors" in ctx.tables:
        df = tables.adjusted(df, ctx.tables["factors"], ["open", "high", "low", "close"], "volume")
        df = df.drop("cum_factor")
    return df


def minute_step(name: str) -> None:
    @register(name, check_minute)
    def op(ctx: Context, step: dict) -> None:
        args = {k: v for k, v in step.items() if k not in ("action", "name", "output_dataframe", "cache_key", "features")}
        made = minute.reduce_minutes(minute_window(ctx, minute.warm_up(name, args)), name, step["features"], **args)
        made = ctx.between(made)
        have = ctx.frames.get(target(step))
        ctx.frames[target(step)] = made if have is None else have.join(made, ["entity", "date"], "left")


for _name in minute.REDUCERS:
    minute_step(_name)
