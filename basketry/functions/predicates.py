"""Row predicates: strong values and category tokens.

All predicates are built-in Column expressions, so they stay inside
whole-stage codegen and, where the input allows, reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the reference jobs.
# Strong-value cutoff; job 1 keeps values above it, job 2 at or above it.
DEFAULT_CUTOFF = 1250000.0
# Job 1 category token: contains this substring (case-sensitive) ...
DEFAULT_CATEGORY_SUBSTRING = "cancer"
# ... or equals one of these names, ignoring case.
DEFAULT_CATEGORY_NAMES = ("leukemia", "lymphoma")
# Job 2 entity filter: at least one token equal (case-sensitive) to one of these.
DEFAULT_CATEGORY_LIST = ("breast-cancer", "prostate-cancer", "pancreatic-cancer",
                         "leukemia", "lymphoma")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strong(value: Column | str, cutoff: float = DEFAULT_CUTOFF,
           inclusive: bool = False) -> Column:
    """``value`` compared as a 32-bit float with ``cutoff`` (also a float).

    NaN is never strong: a float comparison with NaN is false, whereas Spark
    orders NaN above every number.
    """
    v = _col(value).cast(T.FloatType())
    t = F.lit(float(cutoff)).cast(T.FloatType())
    cmp = (v >= t) if inclusive else (v > t)
    return cmp & ~F.isnan(v)


def scan_bound(value: Column | str, cutoff: float, inclusive: bool) -> Column:
    """A plain double comparison implied by ``strong`` on a double column.

    ``cast(v as float) > t`` cannot be pushed into a Parquet scan; this
    slightly looser bound can (it shows up in ``PushedFilters``) and lets
    row groups be skipped. Rounding to float moves a value by at most a
    relative 2^-24, far inside the 1e-6 slack.
    """
    slack = abs(float(cutoff)) * 1e-6 + 1e-30
    return _col(value) >= F.lit(float(cutoff) - slack)


def strong_filter(df: DataFrame, value_col: str, cutoff: float = DEFAULT_CUTOFF,
                  inclusive: bool = False) -> DataFrame:
    """Keep rows whose ``value_col`` is strong; pushes a bound to the scan."""
    cond = strong(value_col, cutoff, inclusive)
    if isinstance(df.schema[value_col].dataType, T.DoubleType):
        cond = scan_bound(value_col, cutoff, inclusive) & cond
    return df.where(cond)


def category_token(token: Column | str,
                   substring: str = DEFAULT_CATEGORY_SUBSTRING,
                   names: Iterable[str] = DEFAULT_CATEGORY_NAMES) -> Column:
    """Job 1 token test: contains ``substring`` or equals a name ignoring case."""
    tok = _col(token)
    lowered = [F.lower(F.lit(n)) for n in names]
    test = tok.contains(substring)
    if lowered:
        test = test | F.lower(tok).isin(*lowered)
    return test


def has_any_token(tokens: Column | str,
                  names: Iterable[str] = DEFAULT_CATEGORY_LIST) -> Column:
    """Job 2 entity test: some token equals (case-sensitive) a listed name."""
    wanted = list(names)
    if not wanted:
        return F.lit(False)
    return F.coalesce(F.exists(_col(tokens), lambda t: t.isin(*wanted)), F.lit(False))
