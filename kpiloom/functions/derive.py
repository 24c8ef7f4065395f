"""Row-wise derived measures (column arithmetic only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def share_of_sum(part: Column | str, parts: list[Column | str]) -> Column:
    """part / sum(parts) * 100 when the sum is positive; null otherwise.
    Null parts make the sum null (a missing count gives no share)."""
    total = sum_strict(parts)
    return F.when(total > 0, F.try_divide(_c(part), total) * 100)


def sum_strict(parts: list[Column | str]) -> Column:
    """Plain horizontal sum: null if any part is null."""
    out = _c(parts[0])
    for p in parts[1:]:
        out = out + _c(p)
    return out


def count_from_rate(rate: Column | str, total: Column | str) -> Column:
    """round(rate / 100 * total) with round-half-even."""
    return F.bround(_c(rate) / 100 * _c(total), 0)


def rate_or_count(value: Column | str, total: Column | str) -> tuple[Column, Column]:
    """(rate, count): a value <= 100 is a rate; above 100 with a positive total it
    becomes round(value / total * 100, 1); otherwise it stays a count."""
    v, t = _c(value), _c(total)
    rate = (F.when(v <= 100, v)
             .when((v > 100) & (t > 0), F.bround(F.try_divide(v, t) * 100, 1)))
    count = F.when((v > 100) & ~F.coalesce(t > 0, F.lit(False)), v)
    return rate, count


def sum_null_as_zero(parts: list[Column | str]) -> Column:
    """Horizontal sum treating nulls as 0 (so all-null parts give 0)."""
    out = F.coalesce(_c(parts[0]), F.lit(0.0))
    for p in parts[1:]:
        out = out + F.coalesce(_c(p), F.lit(0.0))
    return out


def sum_positive_or_null(parts: list[Column | str]) -> Column:
    """Sum of the positive parts; null when none is positive."""
    some, total = F.lit(False), F.lit(0.0)
    for p in parts:
        v = _c(p).cast("double")
        positive = F.coalesce(v > 0, F.lit(False))
        some, total = some | positive, total + F.when(positive, v).otherwise(F.lit(0.0))
    return F.when(some, total)


def first_nonzero_total(primary: Column | str, fallback: Column | str) -> Column:
    """``primary`` unless it is null or 0, then ``fallback``; kept only when > 0."""
    t = F.coalesce(F.nullif(_c(primary), F.lit(0)), _c(fallback))
    return F.when(t > 0, t)


def policy_compliance(answers: list[Column | str]) -> Column:
    """Percent of YES (trimmed, upper-cased) among non-null answers, 1 decimal;
    null when nothing was answered."""
    arr = F.array(*[F.upper(F.trim(_c(a))) for a in answers])
    answered = F.size(F.filter(arr, lambda x: x.isNotNull()))
    yes = F.size(F.filter(arr, lambda x: x == "YES"))
    return F.when(answered > 0, F.bround(F.try_divide(yes, answered) * 100, 1))


# Means rounded to one decimal are computed exactly: the summands are scaled to
# integer micro-units, summed as decimals (no float summation-order drift) and
# divided with integer half-even rounding.
MICRO = 1_000_000
