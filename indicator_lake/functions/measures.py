"""Indicator measures: gap, target status, ratios and weighted shares."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Status names, source names and the near-target tolerance in points.
NO_COMPARISON = "SEM_COMPARACAO"
TARGET_MET = "META_ATINGIDA"
NEAR_TARGET = "PROXIMO_DA_META"
BELOW_TARGET = "ABAIXO_DA_META"
BATCH_SOURCE = "BATCH_BASE_DOS_DADOS"
STREAM_SOURCE = "STREAMING_PUBSUB"
NEAR_TOLERANCE = 5.0
# Tokens that count a student as present.
PRESENT_TOKENS = ("presente", "1", "sim", "s", "true")


def gap(rate: Column, target: Column) -> Column:
    """Percentage points above (+) or below (-) the target; NULL when either is NULL."""
    return rate - target


def target_status_unguarded(rate: Column, target: Column, tolerance: float = NEAR_TOLERANCE) -> Column:
    """Status where a missing rate or target counts as below target."""
    return (
        F.when(rate >= target, F.lit(TARGET_MET))
        .when(rate >= target - F.lit(tolerance), F.lit(NEAR_TARGET))
        .otherwise(F.lit(BELOW_TARGET))
    )


def target_status(rate: Column, target: Column, tolerance: float = NEAR_TOLERANCE) -> Column:
    """Status where a missing rate or target gives no comparison."""
    return F.when(rate.isNull() | target.isNull(), F.lit(NO_COMPARISON)).otherwise(
        target_status_unguarded(rate, target, tolerance)
    )


def source_priority(source: Column) -> Column:
    """Streamed rows come before all others."""
    return F.when(source == STREAM_SOURCE, 1).otherwise(2)


def target_distance(target_year: Column, result_year: Column) -> Column:
    """Years between target and result; 0 without a target."""
    return F.abs(F.coalesce(target_year, result_year) - result_year)


def safe_percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; NULL when ``whole`` is zero."""
    return F.try_divide(part, whole) * 100


def weighted_share(flag: Column, weight: Column) -> Column:
    """Weighted percentage of TRUE among known flags; a missing weight counts as 1."""
    known_weight = F.coalesce(weight, F.lit(1.0))
    hit = F.sum(F.when(flag, known_weight).otherwise(0.0))
    base = F.sum(F.when(flag.isNotNull(), known_weight).otherwise(0.0))
    return hit / F.nullif(base, F.lit(0.0)) * 100


def arg_max(value: Column, order: Column) -> Column:
    """The value with the greatest ``order``, also when every ``order`` is NULL."""
    return F.max_by(value, F.struct(F.coalesce(order, F.lit(float("-inf"))), value))
