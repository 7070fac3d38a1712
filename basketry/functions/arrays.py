"""Scalar helpers on itemset arrays and the float arithmetic of the rules.

Itemsets are canonical ascending ``ARRAY<item>`` values. Spark orders
arrays element by element with the element type's order, so an
``ARRAY<INT>`` sorts numerically, which is the report order once the set
size is compared first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the reference output formats.
ITEM_SEPARATOR = ";"        # items inside a set in the itemset report
SET_SEPARATOR = "\t"        # between fields of every report line
RULE_ITEM_SEPARATOR = " "   # items inside a set in the rule report


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def items_text(items: Column | str, sep: str = ITEM_SEPARATOR) -> Column:
    """``[1, 5, 9]`` -> ``'1;5;9'``."""
    return F.array_join(_col(items).cast(T.ArrayType(T.StringType())), sep)


def parse_items(text: Column | str, sep: str = ITEM_SEPARATOR,
                item_type: T.DataType = T.IntegerType()) -> Column:
    """``'1;5;9'`` -> ``[1, 5, 9]``; an item that cannot be read raises."""
    return F.transform(F.split(_col(text), _regex_literal(sep), -1),
                       lambda x: cast_or_raise(x, item_type, "item"))


def cast_or_raise(text: Column, as_type: T.DataType, what: str) -> Column:
    """``text`` as another type; raises on what cannot be read, whatever the ANSI setting."""
    if isinstance(as_type, T.StringType):
        return text
    found = text.try_cast(as_type)
    bad = F.raise_error(F.concat(F.lit(f"malformed {what}: "), F.coalesce(text, F.lit("(none)"))))
    return F.when(found.isNull(), bad).otherwise(found)


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in sep)


def subset_by_mask(items: Column | str, mask: Column | str) -> Column:
    """Elements whose bit is set in ``mask`` (bit i selects element i)."""
    m = _col(mask)
    # F.shiftright only takes a literal bit count; the SQL function takes a column
    return F.filter(_col(items),
                    lambda _x, i: F.call_function("shiftright", m, i)
                    .bitwiseAND(F.lit(1)) == F.lit(1))


def float_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``float(a) / float(b)`` rounded to a 32-bit float.

    Spark widens float division to double; dividing the two float values
    in double and rounding once to float gives the correctly rounded float
    quotient (double has more than twice float's precision). Each operand
    must first be rounded to float: counts above 2^24 change. Catalyst
    treats long -> float -> double as a widening chain and folds it into
    long -> double, dropping that rounding, so the float value is pinned
    with a float-typed ``* 1.0f`` the optimizer keeps.
    """
    one = F.lit(1.0).cast(T.FloatType())
    a = _col(numerator).cast(T.FloatType()) * one
    b = _col(denominator).cast(T.FloatType()) * one
    return (a / b).cast(T.FloatType())


def float_at_least(value: Column | str, bound: float) -> Column:
    """``value >= float(bound)`` with both sides 32-bit floats."""
    return _col(value).cast(T.FloatType()) >= F.lit(float(bound)).cast(T.FloatType())


def support_threshold(n_transactions: int, min_support: float) -> int:
    """Minimum support count: the IEEE double product, truncated.

    ``100 * 0.29`` is ``28.999999999999996`` in double, so 28, not 29. A
    share above 1 is meaningful with bag counting, where supports count
    duplicates and may exceed the number of transactions.
    """
    if math.isnan(min_support) or min_support < 0.0:
        raise ValueError(f"min_support must be 0 or more, got {min_support!r}")
    return int(float(n_transactions) * float(min_support))
