"""Scalar building blocks: missing values, guarded arithmetic, and formulas as columns.

Missing is NULL only: sources turn NaN and infinities into NULL (`clean`), and every operation that
could make one of them (division, logarithm, root) is guarded, in ANSI mode too.
"""

from __future__ import annotations

import ast
import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    x = col(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def div(a: Column | str, b: Column | str) -> Column:
    d = col(b).cast("double")
    return F.when(d != 0, col(a).cast("double") / d)


def ln(c: Column | str) -> Column:
    return F.when(col(c) > 0, F.log(col(c).cast("double")))


def sqrt(c: Column | str) -> Column:
    return F.when(col(c) >= 0, F.sqrt(col(c).cast("double")))


def both(a: Column | str, b: Column | str, value: Column) -> Column:
    """value where both are present."""
    return F.when(col(a).isNotNull() & col(b).isNotNull(), value)


def greater(a: Column | str, b: Column | str) -> Column:
    """The larger one; NULL if either is missing."""
    return both(a, b, F.greatest(col(a), col(b)))


def less(a: Column | str, b: Column | str) -> Column:
    return both(a, b, F.least(col(a), col(b)))


FUNCTIONS = {"abs": F.abs, "log": ln, "exp": F.exp, "sqrt": sqrt, "sign": F.signum, "floor": F.floor, "ceil": F.ceil}
COMPARE = {ast.Gt: "__gt__", ast.GtE: "__ge__", ast.Lt: "__lt__", ast.LtE: "__le__", ast.Eq: "__eq__", ast.NotEq: "__ne__"}


class FormulaError(ValueError):
    pass


def parsed(formula: str) -> ast.Expression:
    """& and | bind as loosely as the words."""
    try:
        return ast.parse(formula.replace("&", " and ").replace("|", " or ").strip(), mode="eval")
    except SyntaxError as e:
        raise FormulaError(str(e)) from e


def names_in(formula: str) -> set[str]:
    tree = parsed(formula)
    called = {n.func for n in ast.walk(tree) if isinstance(n, ast.Call)}
    return {n.id for n in ast.walk(tree) if isinstance(n, ast.Name) and n not in called}


def compile_formula(formula: str, columns: list[str]) -> Column:
    """An infix formula over declared columns as a column; comparisons are 0 or 1 within arithmetic.

    A comparison with a missing value is false.
    """

    def number(c: Column, boolean: bool) -> Column:
        return c.cast("double") if boolean else c

    def walk(n: ast.expr) -> tuple[Column, bool]:
        match n:
            case ast.Constant(value=bool() | int() | float()):
                return F.lit(float(n.value)), False
            case ast.Name(id=name):
                if name not in columns:
                    raise FormulaError(f"{name} isn't among the formula's columns {sorted(columns)}")
                return F.col(f"`{name}`").cast("double"), False
            case ast.UnaryOp(op=ast.USub(), operand=x):
                return -number(*walk(x)), False
            case ast.UnaryOp(op=ast.UAdd(), operand=x):
                return walk(x)
            case ast.UnaryOp(op=ast.Invert() | ast.Not(), operand=x):
                c, boolean = walk(x)
                if not boolean:
                    raise FormulaError("~ needs a condition")
                return ~c, True
            case ast.BoolOp(op=op, values=values):
                sides = [walk(v) for v in values]
                if not all(boolean for _, boolean in sides):
                    raise FormulaError("and, or need conditions")
                return functools.reduce(operator.and_ if isinstance(op, ast.And) else operator.or_, [c for c, _ in sides]), True
            case ast.BinOp(left=a, right=b):
                (x, p), (y, q) = walk(a), walk(b)
                if p and q and isinstance(n.op, ast.Div):
                    # gate / gate masks: 1 where it holds, missing elsewhere
                    return F.when(y, x.cast("double")), False
                if q and isinstance(n.op, ast.Div):
                    return F.when(y, x), False
                x, y = number(x, p), number(y, q)
                ops = {ast.Add: lambda: x + y, ast.Sub: lambda: x - y, ast.Mult: lambda: x * y, ast.Div: lambda: div(x, y), ast.Pow: lambda: clean(F.pow(x, y))}
                if type(n.op) not in ops:
                    raise FormulaError(f"no operator {type(n.op).__name__}")
                return ops[type(n.op)](), False
            case ast.Compare(left=a, ops=ops, comparators=others) if all(type(op) in COMPARE for op in ops):
                sides = [number(*walk(x)) for x in (a, *others)]
                each = [F.coalesce(getattr(x, COMPARE[type(op)])(y), F.lit(False)) for x, op, y in zip(sides, ops, sides[1:], strict=False)]
                return functools.reduce(operator.and_, each), True
            case ast.Call(func=ast.Name(id=name), args=[x], keywords=[]) if name in FUNCTIONS:
                return FUNCTIONS[name](number(*walk(x))).cast("double"), False
            case ast.Call(func=ast.Name(id="clip"), args=[x, lo, hi], keywords=[]):
                c, low, high = (number(*walk(y)) for y in (x, lo, hi))
                return F.when(c.isNotNull(), F.least(F.greatest(c, low), high)), False
        raise FormulaError(f"not allowed in a formula: {ast.unparse(n)}")

    return walk(parsed(formula).body)[0]
