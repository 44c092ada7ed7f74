"""User predicates as text: comparisons, lists and boolean words become a Column."""

from __future__ import annotations

import ast
import io
import tokenize

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expressions import col

#: Comparisons with a missing value are false, but for "not equal", which is true.
_COMPARE = {
    ast.Eq: lambda a, b: a == b, ast.NotEq: lambda a, b: ~F.coalesce(a == b, F.lit(False)), ast.Lt: lambda a, b: a < b, ast.LtE: lambda a, b: a <= b, ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b,
}
_ARITHMETIC = {ast.Add: lambda a, b: a + b, ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b, ast.Div: lambda a, b: F.try_divide(a, b), ast.Mod: lambda a, b: a % b}


def _boolean_words(text: str) -> str:
    """``&`` and ``|`` become ``and`` and ``or``, which bind more loosely than comparisons."""
    words = {"&": "and", "|": "or"}
    of = lambda t: (tokenize.NAME, words[t.string]) if t.type == tokenize.OP and t.string in words else (t.type, t.string)
    tokens = [of(t) for t in tokenize.generate_tokens(io.StringIO(text).readline)]
    return tokenize.untokenize(tokens)


def compile_predicate(text: str, columns: list[str]) -> Column:
    """Column of a predicate such as ``age < 14 and group in ['a', 'b']``.

    ``&`` and ``|`` bind like ``and`` and ``or``; ``==`` and ``!=`` with a list mean ``in`` and ``not in``.  A comparison with a missing
    value is false, ``!=`` and ``not in`` are true.  Names in backticks may hold any characters.  An unknown column or any
    other syntax is a ValueError.
    """
    names: dict[str, str] = {}
    parts = text.split("`")
    if len(parts) % 2 == 0:
        raise ValueError(f"expression is invalid: {text!r}: a backtick is not closed")
    for i in range(1, len(parts), 2):
        names[f"_quoted_{i}"] = parts[i]
        parts[i] = f"_quoted_{i}"

    def value(node: ast.expr) -> Column:
        match node:
            case ast.Name(id=name):
                name = names.get(name, name)
                if name not in columns:
                    raise ValueError(f"expression is invalid: no column {name!r}")
                return col(name)
            case ast.Constant(value=x):
                return F.lit(x)
            case ast.UnaryOp(op=ast.USub(), operand=x):
                return -value(x)
            case ast.UnaryOp(op=ast.Not() | ast.Invert(), operand=x):
                return ~value(x)
            case ast.BinOp(left=a, op=op, right=b) if type(op) in _ARITHMETIC:
                return _ARITHMETIC[type(op)](value(a), value(b))
            case ast.BinOp(left=a, op=ast.BitAnd(), right=b):
                return value(a) & value(b)
            case ast.BinOp(left=a, op=ast.BitOr(), right=b):
                return value(a) | value(b)
            case ast.BoolOp(op=op, values=xs):
                out = value(xs[0])
                for x in xs[1:]:
                    out = out & value(x) if isinstance(op, ast.And) else out | value(x)
                return out
            case ast.Compare(left=a, ops=ops, comparators=bs):
                out, left = None, a
                for op, right in zip(ops, bs):
                    listed = isinstance(right, (ast.List, ast.Tuple))
                    if isinstance(op, (ast.In, ast.NotIn)) or listed and isinstance(op, (ast.Eq, ast.NotEq)):
                        if not listed:
                            raise ValueError("expression is invalid: 'in' needs a list")
                        one = F.coalesce(value(left).isin([ast.literal_eval(x) for x in right.elts]), F.lit(False))
                        one = ~one if isinstance(op, (ast.NotIn, ast.NotEq)) else one
                    elif type(op) in _COMPARE:
                        one = F.coalesce(_COMPARE[type(op)](value(left), value(right)), F.lit(False))
                    else:
                        raise ValueError("expression is invalid: unknown comparison")
                    out = one if out is None else out & one
                    left = right
                return out
        raise ValueError(f"expression is invalid: {ast.dump(node)}")

    try:
        tree = ast.parse(_boolean_words("".join(parts).strip()).strip(), mode="eval")
    except (SyntaxError, tokenize.TokenError) as e:
        raise ValueError(f"expression is invalid: {text!r}") from e
    return value(tree.body)


def filter_rows(df: DataFrame, text: str | None, check_empty: bool = True) -> DataFrame:
    """Rows that a predicate keeps; no predicate keeps all.  ValueError if it is invalid or keeps nothing."""
    if not text or not text.strip():
        return df
    out = df.where(compile_predicate(text, df.columns))
    if check_empty and out.isEmpty():
        raise ValueError(f"the expression excluded all rows: {text!r}")
    return out
