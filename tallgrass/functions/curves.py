"""Curves held as arrays: interpolation, monotone fits, survival-weighted values, padding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Curve = dict[int, float]


def points(curve: Curve) -> Column:
    """A curve's checkpoints as data, in order, from (0, 0) on."""
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in sorted(({0: 0.0} | curve).items())])


def interpolated(curve: Column, x: Column) -> Column:
    """The piecewise-linear curve at x; behind its last point it stays level."""
    at = F.size(F.filter(curve, lambda p: p["x"] <= x))
    low, high = F.element_at(curve, F.greatest(at, F.lit(1))), F.element_at(curve, F.least(at + 1, F.size(curve)))
    slope = (high["y"] - low["y"]) / F.nullif(high["x"] - low["x"], F.lit(0.0))
    return low["y"] + F.coalesce(slope * (x - low["x"]), F.lit(0.0))


def survival_factor(redefault: Column, tenor: Column, annual: float) -> Column:
    """What an instalment of 1 a month over tenor months is worth: discounted, and paid as long as there's no new default."""
    monthly = (1 + annual) ** (1 / 12)
    step = lambda total, t: total + F.greatest(F.lit(0.0), 1 - interpolated(redefault, t.cast("double"))) * F.pow(F.lit(monthly), -t)
    return F.aggregate(F.sequence(F.lit(1), tenor.cast("int")), F.lit(0.0), step)


def instalment(principal: Column, annual_rate: Column, tenor: Column) -> Column:
    """Level payment a month; without interest the principal in equal parts."""
    rate = annual_rate / 12
    return F.when(rate > 0, principal * rate / (1 - F.pow(1 + rate, -tenor))).otherwise(principal / tenor)


def isotonic(values: Column, weights: Column) -> Column:
    """The non-decreasing array nearest to values in weighted squares, by pooling adjacent violators.

    A stack of blocks (sum, weight, size) is folded over the points; a new block swallows blocks before it whose mean isn't
    lower."""
    block = "struct<s:double,w:double,n:int>"

    def push(stack: Column, point: Column) -> Column:
        start = F.struct(F.struct((point["v"] * point["w"]).alias("s"), point["w"].alias("w"), F.lit(1).alias("n")).alias("top"), F.array().cast(f"array<{block}>").alias("rest"))

        def meet(acc: Column, below: Column) -> Column:
            top = acc["top"]
            pools = (F.size(acc["rest"]) == 0) & (below["s"] * top["w"] >= top["s"] * below["w"])
            pooled = F.struct((top["s"] + below["s"]).alias("s"), (top["w"] + below["w"]).alias("w"), (top["n"] + below["n"]).alias("n"))
            return F.struct(F.when(pools, pooled).otherwise(top).alias("top"), F.when(pools, acc["rest"]).otherwise(F.array_prepend(acc["rest"], below)).alias("rest"))

        met = F.aggregate(F.reverse(stack), start, meet)
        return F.array_append(met["rest"], met["top"])

    blocks = F.aggregate(F.zip_with(values, weights, lambda v, w: F.struct(v.cast("double").alias("v"), w.cast("double").alias("w"))), F.array().cast(f"array<{block}>"), push)
    return F.flatten(F.transform(blocks, lambda b: F.array_repeat(b["s"] / b["w"], b["n"])))


def padded(values: Column, length: int, fill: Column, before: bool = True) -> Column:
    """An array of exactly length elements: the last ones of values, filled up in front (or behind)."""
    kept = F.slice(values, F.greatest(F.lit(1), F.size(values) - length + 1), F.lit(length))
    filling = F.array_repeat(fill, F.greatest(F.lit(0), length - F.size(values)))
    return F.concat(filling, kept) if before else F.concat(kept, filling)
