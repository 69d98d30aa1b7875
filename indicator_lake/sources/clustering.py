"""Orders of rows in files that let a scan skip by several columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Ranks of a column: 2 ** RANK_BITS ranges of about equal numbers of rows.
RANK_BITS = 6
_TEXT_BYTES = 7  # as many as a signed 64-bit number holds without its sign


def ordinal(df: DataFrame, name: str) -> Column:
    """A number that orders as the column does; texts go by their first seven bytes, which is a whole code."""
    value, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        head = F.substring(F.encode(value, "UTF-8"), 1, _TEXT_BYTES)
        return F.conv(F.rpad(F.hex(head), 2 * _TEXT_BYTES, "0"), 16, 10).cast("bigint").cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    raise ValueError(f"{name}: no order of {kind.simpleString()} is known here")


def _rank(value: Column, bounds: Column) -> Column:
    """How many of the bounds are not above the value."""
    return F.size(F.filter(bounds, lambda bound: bound <= value)).cast("bigint")


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> Column:
    """The bits of the columns' ranks in turn: rows that are near in every column get near numbers.

    Ranks follow quantiles of the data, found by one pass over ``df`` that returns 2 ** bits - 1 numbers a column.
    A NULL has the lowest rank.
    """
    if not 1 <= len(columns) * bits <= 62:
        raise ValueError("the ranks of all columns must fit 62 bits")
    shares = [i / 2**bits for i in range(1, 2**bits)]
    cuts = df.agg(*[F.percentile_approx(ordinal(df, c), shares, 10_000).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    parts = []
    for j, name in enumerate(columns):
        bounds = F.array(*[F.lit(float(c)) for c in sorted(set(cuts[j] or ()))]).cast("array<double>")
        rank = _rank(ordinal(df, name), bounds)
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("bigint"))
            parts.append(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - j))
    return reduce(lambda x, y: x.bitwiseOR(y), parts)
