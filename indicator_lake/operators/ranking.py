"""Dense ranks that do not gather a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

BANDS = 64


def _join_same(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal values, NULL with NULL, keeping the names of the left side."""
    right = right.withColumnsRenamed({n: f"_{n}_" for n in names})
    return left.join(right, [left[n].eqNullSafe(right[f"_{n}_"]) for n in names], how).drop(*[f"_{n}_" for n in names])


def _banded(values: DataFrame, group: Sequence[str], value: str, bands: int) -> DataFrame:
    """Number each value's band within its group; the bands hold about equally many values.

    The cuts are approximate quantiles of the group's distinct rows: one short array per group.
    """
    shares = [k / bands for k in range(1, bands + 1)]
    cuts = values.groupBy(*group).agg(F.percentile_approx(value, shares, 1000).alias("_cuts"))
    cut = _join_same(values, cuts, group)
    return cut.withColumn("_band", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts")


def _above(sizes: DataFrame, keys: Sequence[str], size: str) -> Column:
    """Values in the higher bands; one row per band meets in this window."""
    window = W.partitionBy(*keys).orderBy(F.col("_band").desc()).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(size).over(window), F.lit(0))


def two_level_dense_rank(
    df: DataFrame,
    value: str,
    group: Sequence[str],
    inner: Sequence[str],
    group_rank: str,
    inner_rank: str,
    bands: int = BANDS,
) -> DataFrame:
    """DENSE_RANK of ``value`` (descending) within ``group`` and within ``group + inner``.

    DENSE_RANK depends only on the distinct values, so rows are reduced to these before anything
    else and a value that many rows share weighs as one. A group's values are cut into bands;
    one shuffle by (group, band) serves the ranks inside the band of both levels, to which the
    numbers of values in higher bands are added. The result is exact for any cuts. ``value``
    must not be NULL.
    """
    keys = [*inner, *group, value]
    values = _banded(df.select(*keys).distinct(), group, value, bands)
    best = F.col(value).desc()
    ranked = values.withColumns(
        {
            group_rank: F.dense_rank().over(W.partitionBy(*group, "_band").orderBy(best)),
            inner_rank: F.dense_rank().over(W.partitionBy(*group, "_band", *inner).orderBy(best)),
        }
    )
    sizes = ranked.groupBy(*group, "_band", *inner).agg(F.max(group_rank).alias("_outer"), F.max(inner_rank).alias("_inner"))
    nested = sizes.withColumn("_inner_above", _above(sizes, [*group, *inner], "_inner")).drop("_outer", "_inner")
    whole = sizes.groupBy(*group, "_band").agg(F.max("_outer").alias("_outer"))
    # a band's largest rank may belong to any inner group, so the whole group's sizes are their maxima
    whole = whole.withColumn("_outer_above", _above(whole, group, "_outer")).drop("_outer")
    added = _join_same(nested, whole, [*group, "_band"])
    ranked = _join_same(ranked, added, [*group, "_band", *inner])
    ranks = ranked.select(
        *keys,
        (F.col(group_rank) + F.col("_outer_above")).cast("bigint").alias(group_rank),
        (F.col(inner_rank) + F.col("_inner_above")).cast("bigint").alias(inner_rank),
    )
    return _join_same(df, ranks, keys)
