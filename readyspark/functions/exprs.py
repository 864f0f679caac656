"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs Python at run time.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# a plain decimal or scientific number, optionally signed and padded
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

TWO_POW_32 = 4294967296.0


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# every character that Python's str.strip removes: ASCII white space and separators, next line,
# no-break space and the Unicode spaces (fixed values)
WHITESPACE = (" \t\n\r\f\x0b\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
              + "\u2028\u2029\u202f\u205f\u3000")


def strip(c) -> Column:
    """Remove leading and trailing whitespace of every kind (not only spaces).

    ``btrim`` with an explicit character set: a plain string scan, no regex,
    so it stays cheap inside generated code.
    """
    return F.btrim(col_of(c), F.lit(WHITESPACE))


def nan_to_null(c) -> Column:
    c = col_of(c)
    return F.when(~F.isnan(c), c)


def lenient_double(c, data_type: T.DataType | None = None) -> Column:
    """Numeric conversion where unreadable text becomes null, and so does NaN.

    Text is parsed only when it looks like a plain number, so engine-specific
    spellings (``'24d'``, ``'NaN'``) do not slip through.
    """
    c = col_of(c)
    if data_type is not None and isinstance(data_type, T.NumericType):
        return nan_to_null(c.cast("double"))
    text = c.cast("string")
    # the pattern admits no NaN/Infinity spelling, so no NaN check is needed here
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def safe_divide(a, b) -> Column:
    """Division that gives null for a zero or null divisor (ANSI-mode safe)."""
    return F.try_divide(col_of(a).cast("double"), col_of(b).cast("double"))


def coalesce_false(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def all_of(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def any_of(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def right_closed_bins(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin (edges[i], edges[i+1]] holding c; null outside all bins, and for NaN."""
    c = nan_to_null(c)
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) if hi == float("inf") else ((c > F.lit(lo)) & (c <= F.lit(hi)))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def lookup(c, mapping: Mapping, keep_unknown: bool = True) -> Column:
    """Map values through a literal dictionary; unknown values stay (or become null)."""
    c = col_of(c)
    items = []
    for k, v in mapping.items():
        items.extend([F.lit(k), F.lit(v)])
    if not items:
        return c if keep_unknown else F.lit(None)
    mapped = F.when(c.isNotNull(), F.try_element_at(F.create_map(*items), c))
    return F.coalesce(mapped, c) if keep_unknown else mapped


def pick(index, values: Sequence) -> Column:
    """``values[index]`` for a 0-based integer column; null for a null index.

    The explicit ``when`` matters: ``element_at`` over a literal array is typed
    non-nullable, so without it the optimizer would fold null checks on the
    result to false even where the index is null.
    """
    idx = (col_of(index) + 1).cast("int")
    return F.when(idx.isNotNull(), F.element_at(F.array(*[F.lit(v) for v in values]), idx))


def hash32(*parts) -> Column:
    """Unsigned 32-bit hash: the first 8 hex digits of md5('p1|p2|...') as bigint.

    Depends only on the row's own values, so it is the same on any number of
    partitions and on any engine that has md5 (DuckDB gives the same number).
    """
    text = F.concat_ws("|", *[F.lit(str(p)) if isinstance(p, (int, float)) else col_of(p).cast("string")
                              for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def keyed_uniform(key, column_name: str, seed: int) -> Column:
    """Uniform [0, 1) number derived from (key, column name, seed)."""
    return hash32(key, F.lit(column_name), F.lit(str(seed))) / F.lit(TWO_POW_32)


def is_nullish(c, data_type: T.DataType) -> Column:
    """Null, or NaN for floating types (the way pandas sees missing values)."""
    c = col_of(c)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def r6(c) -> Column:
    """Round a double to 6 places; results are compared at this precision."""
    return F.round(col_of(c).cast("double"), 6)
