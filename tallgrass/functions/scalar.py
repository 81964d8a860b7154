"""Scalar expressions: histories, calendars, present values, scores and packing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def monthly_equivalent(value: Column, gap_days: Column) -> Column:
    """Monthly amount of a payment that comes every gap_days days; without a gap the payment itself."""
    factor = F.when(gap_days.between(28, 32), 1.0).when(gap_days.between(13, 15), 2.17).when(gap_days.between(6, 8), 4.33).when(gap_days > 0, 30 / gap_days).otherwise(1.0)
    return value * factor


def history(digits: Column) -> Column:
    """Newest-first delinquency buckets of a digit string whose rightmost character is newest; other characters are 0."""
    return F.transform(F.reverse(F.split(digits, "")), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))


def history_features(buckets: Column) -> dict[str, Column]:
    """Worst bucket, current streak, worsening steps, cures and age of the worst bucket."""
    n = F.size(buckets)
    steps = F.zip_with(F.slice(buckets, 1, n - 1), F.slice(buckets, 2, n - 1), lambda new, old: new - old)
    good = F.array_position(F.transform(buckets, lambda b: (b == 0).cast("int")), 1)
    return {
        "worst": F.array_max(buckets),
        "streak": F.when(good == 0, n).otherwise(good - 1).cast("long"),
        "worsening": F.size(F.filter(steps, lambda d: d > 0)).cast("long"),
        "improving": F.size(F.filter(steps, lambda d: d < 0)).cast("long"),
        "months_since_worst": (F.array_position(buckets, F.array_max(buckets)) - 1).cast("long"),
    }


def fatigue(attempts: list[tuple[Column, float]], days: Column, half_life: float = 14.0) -> Column:
    """Weighted attempts, halved every half_life days, at most 1."""
    return F.least(F.lit(1.0), sum((a * w for a, w in attempts), F.lit(0.0)) * F.pow(F.lit(0.5), days / half_life))


def logit(p: Column, edge: float = 1e-6) -> Column:
    c = F.greatest(F.lit(edge), F.least(F.lit(1 - edge), p))
    return F.log(c / (1 - c))


def inverse_logit(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def keyword(text: Column, words: list[str]) -> Column:
    """Whether any of the words occurs, in either case."""
    return F.lower(text).rlike("|".join(words))


def reason_codes(contributions: dict[str, Column], k: int = 3) -> Column:
    """Names of the k contributions largest in size, largest first."""
    ranked = F.array_sort(F.array(*[F.struct((-F.abs(c)).alias("s"), F.lit(n).alias("n")) for n, c in contributions.items()]))
    return F.transform(F.slice(ranked, 1, k), lambda x: x["n"])


def bucket_100(key: Column, seed: str) -> Column:
    """md5 of seed and key, as a whole, modulo 100."""
    digest = F.md5(F.concat(F.lit(seed), key.cast("string")))
    half = lambda a: F.conv(F.substring(digest, a, 16), 16, 10).cast("decimal(20,0)") % 100
    return ((half(1) * 16 + half(17)) % 100).cast("int")
