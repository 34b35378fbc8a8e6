"""Fundamental factors as specifications. Fields ending in _q0, _q1, ... are a value now and so many quarters ago."""

from __future__ import annotations


def fetched(name: str, fields: list[str], *steps: dict, column: str | None = None) -> dict:
    return {"factor": {"name": name, "column": column or name}, "calculation_steps": [{"action": "fetch", "api": "get_factor", "fields": fields, "output_columns": {f: f for f in fields}}, *steps]}


def compute(output: str, formula: str, *columns: str) -> dict:
    return {"action": "compute", "formula": formula, "source_columns": list(columns), "output_column": output}


def growth(name: str, what: str, back: int, positive: bool) -> dict:
    """(now - then) / |then|; positive: rows with a positive base only."""
    if what == "profit":
        fields, made = [f"profit_q{k}" for k in (0, back)], []
        now, then = fields
    else:
        fields = [f"{f}_q{k}" for k in (0, back) for f in ("profit", "equity")]
        now, then = "return_q0", f"return_q{back}"
        made = [compute(f"return_q{k}", f"profit_q{k} / equity_q{k}", f"profit_q{k}", f"equity_q{k}") for k in (0, back)]
    keep = [{"action": "filter", "condition": f"{then} > 0"}] if positive else []
    return fetched(name, fields, *made, *keep, compute(name, f"({now} - {then}) / abs({then})", now, then))


def rank_among(name: str, values: list[str]) -> dict:
    """1 and one more for each of the others that the first exceeds."""
    first, *others = values
    return compute(name, f"({first} - {first}) + 1" + "".join(f" + ({first} > {x})" for x in others), *values)


def differences(n: int) -> list[dict]:
    return [compute(f"d{k}", f"profit_q{k} - profit_q{k + 1}", f"profit_q{k}", f"profit_q{k + 1}") for k in range(n)]


def recipes(delta: int = 60, samples: int = 30, group_samples: int = 15, median: tuple[int, int] = (252, 60), bins: int = 10, periods: tuple[int, int] = (8, 4)) -> dict[str, dict]:
    """All of them by name; the arguments' defaults are the factors' own."""
    profits = [f"profit_q{k}" for k in range(9)]
    out = {
        "pe_ttm_new": fetched("pe_ttm_new", ["pe"], column="pe"),
        "net_oper_cash_flow_ttm": fetched("net_oper_cash_flow_ttm", ["cash_flow_ttm"], column="cash_flow_ttm"),
        "pe_mrq": fetched("pe_mrq", ["cap", "profit_q0"], compute("pe_mrq", "cap / profit_q0", "cap", "profit_q0")),
        "roe_mrq_new": fetched("roe_mrq_new", ["profit_q0", "equity_q0"], compute("roe_mrq_new", "profit_q0 / equity_q0", "profit_q0", "equity_q0")),
        "pe_ttm_delta60": fetched("pe_ttm_delta60", ["pe"], {"action": "transform", "method": "diff", "source_column": "pe", "output_column": "pe_ttm_delta60", "periods": delta}),
        "np_rank": fetched("np_rank", profits[:8], rank_among("np_rank", profits[:8])),
        "np_delta_rank": fetched("np_delta_rank", profits, *differences(8), rank_among("np_delta_rank", [f"d{k}" for k in range(8)])),
        "npf_mrq_sue8": fetched(
            "npf_mrq_sue8", profits[:8], *differences(7),
            {"action": "row_aggregate", "source_columns": [f"d{k}" for k in range(7)], "agg": "mean", "output_column": "drift"},
            {"action": "row_aggregate", "source_columns": [f"d{k}" for k in range(7)], "agg": "std", "output_column": "spread"},
            compute("npf_mrq_sue8", "(profit_q0 - profit_q4 - drift) / spread", "profit_q0", "profit_q4", "drift", "spread"),
        ),
        "npf_mrq_accs8": fetched(
            "npf_mrq_accs8", profits[:8],
            {"action": "row_polyfit", "source_columns_y": profits[:8], "degree": 2, "coefficient": "a2", "output_column": "a2"},
            {"action": "row_correlate", "source_columns_a": profits[:4], "source_columns_b": profits[4:8], "output_column": "rho"},
            compute("npf_mrq_accs8", "a2 / (abs(rho) < 0.9)", "a2", "rho"),
        ),
        "reg_pe_hist": fetched(
            "reg_pe_hist", ["profit_q0", "profit_q4", "profit_ttm", "pe"],
            {"action": "filter", "condition": "(profit_q0 > 0) & (profit_q4 > 0) & (profit_ttm > 0) & (pe > 0)"},
            compute("log_growth", "log(profit_q0 / profit_q4)", "profit_q0", "profit_q4"), compute("log_ttm", "log(profit_ttm)", "profit_ttm"), compute("log_pe", "log(pe)", "pe"),
            *({"action": "transform", "method": "diff", "source_column": c, "output_column": f"delta_{c}", "periods": delta} for c in ("log_growth", "log_ttm", "log_pe")),
            {"action": "cross_section_regress", "source_column_y": "delta_log_growth", "source_columns_x": ["delta_log_ttm"], "output_column": "residual", "min_samples": samples},
            {"action": "cross_section_regress", "source_column_y": "delta_log_pe", "source_columns_x": ["residual"], "output_column": "reg_pe_hist", "min_samples": samples},
        ),
        "reg_pb_gshe": fetched(
            "reg_pb_gshe", ["pb", "profit_q0", "equity_q0", "cap"],
            compute("roe", "profit_q0 / equity_q0", "profit_q0", "equity_q0"), compute("ep", "profit_q0 / cap", "profit_q0", "cap"), compute("log_pb", "log(pb)", "pb"),
            {"action": "filter", "condition": "(pb > 0) & (roe > 0)"},
            {"action": "rolling", "source_column": "ep", "output_column": "ep_median", "window": median[0], "min_periods": median[1], "agg": "median"},
            *({"action": "transform", "method": "winsorize", "source_column": c, "output_column": f"{c}_w", "group_by": "date"} for c in ("ep_median", "roe", "log_pb")),
            {"action": "rank", "source_column": "ep_median_w", "output_column": "ep_group", "group_by": ["date"], "n_bins": bins},
            {"action": "cross_section_regress", "source_column_y": "log_pb_w", "source_columns_x": ["roe_w"], "output_column": "reg_pb_gshe", "group_column": "ep_group", "min_samples": group_samples},
        ),
        "roic_ttm_dev_std8": fetched(
            "roic_ttm_dev_std8", ["roic"],
            {"action": "rolling", "source_column": "roic", "output_column": "deviation", "window": periods[0], "min_periods": periods[1], "agg": "std", "change_on": "roic"},
            compute("roic_ttm_dev_std8", "1 / deviation", "deviation"),
        ),
    }
    for name, keys in (("roic_ttm_all_rnk8", ["date"]), ("roic_ttm_ind_rnk8", ["date", "industry"])):
        out[name] = fetched(
            name, ["roic", "industry"],
            {"action": "rank", "source_column": "roic", "output_column": "place", "group_by": keys, "ascending": False, "rank_method": "min"},
            {"action": "rolling", "source_column": "place", "output_column": name, "window": periods[0], "min_periods": periods[1], "agg": "min", "change_on": "roic"},
        )
    for short, what in (("npf", "profit"), ("roe", "return")):
        for base, positive in (("a", False), ("p", True)):
            for span, back in (("yoy", 4), ("qoq", 1)):
                out[f"{short}_{base}{span}_mrq"] = growth(f"{short}_{base}{span}_mrq", what, back, positive)
    return out
