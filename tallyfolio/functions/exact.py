"""Sums of doubles that are the same, bit by bit, however the rows are spread and in whatever order they come.

A double is split into integer limbs of 30 bits at fixed powers of two. Limbs are summed as integers, which is exact and
associative, so partial sums may merge in any way; only the total is turned into a double again. Values may have
bits from 2**-90 to 2**89; one outside is an error, as is a sum of more than 2**33 full limbs. NaN and infinities give
what an ordinary sum gives. NULL counts as absent, and a group of NULLs has a NULL sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMB = 30
PLACES = (60, 30, 0, -30, -60, -90)


def _limbs(value: Column) -> list[Column]:
    """Integers whose sum over ``PLACES`` of limb * 2**place is the value, each with its sign."""
    size, sign, limbs = F.abs(value), F.signum(value), []
    for place in PLACES:
        limb = F.floor(size / F.lit(2.0**place))
        size = size - limb.cast("double") * F.lit(2.0**place)
        limbs.append(limb * sign.cast("long"))
    return [*limbs, size]


def exact_sums(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The keys and, under the columns' names, their exact sums."""
    split, sums, totals = {}, [], []
    for c in columns:
        value = F.col(c).cast("double")
        plain = F.abs(value) < F.lit(2.0**90)  # neither NaN nor infinite nor too large
        split[f"__{c}"] = F.when(plain, value)
        split[f"__{c}_odd"] = F.when(F.isnan(value) | (F.abs(value) == float("inf")), value)
        split[f"__{c}_far"] = ~plain & ~F.isnan(value) & (F.abs(value) != float("inf"))
    parts = df.select(*keys, *[v.alias(k) for k, v in split.items()])
    for c in columns:
        limbs = _limbs(F.col(f"__{c}"))
        wrong = F.raise_error(F.concat(F.lit(f"{c} has bits out of range: "), F.col(f"__{c}").cast("string"))).cast("long")
        for i, limb in enumerate(limbs[:-1]):
            # the lowest limb vouches for the whole value
            exact = F.when(limbs[-1] != 0, wrong).otherwise(limb) if i == len(PLACES) - 1 else limb
            sums.append(F.sum(exact).alias(f"__{c}_{i}"))
        far = F.when(F.col(f"__{c}_far"), F.raise_error(F.lit(f"{c} has a value of 2**90 or more")).cast("double"))
        sums += [F.sum(F.coalesce(far, F.col(f"__{c}_odd"))).alias(f"__{c}_odd")]
        limbs = [F.col(f"__{c}_{i}") for i in range(len(PLACES))]
        finite = F.when(_carried(limbs)[0] < 0, -_joined([-x for x in limbs])).otherwise(_joined(limbs))
        total = F.when(F.col(f"__{c}_odd").isNotNull(), F.col(f"__{c}_odd")).otherwise(finite)
        totals.append(total.alias(c))
    return parts.groupBy(*keys).agg(*sums).select(*keys, *totals)


def _carried(limbs: list[Column]) -> list[Column]:
    """The same number with all limbs but the first from 0 to 2**30 - 1."""
    out, carry = [], F.lit(0).cast("long")
    for limb in reversed(limbs[1:]):
        limb = limb + carry
        carry = F.shiftright(limb, LIMB)
        out.append(limb.bitwiseAND((1 << LIMB) - 1))
    return [limbs[0] + carry, *reversed(out)]


def _joined(limbs: list[Column]) -> Column:
    """The double of a number that is not negative: carried limbs, smallest first."""
    total = F.lit(0.0)
    for limb, place in zip(reversed(_carried(limbs)), reversed(PLACES), strict=True):
        total = total + limb.cast("double") * F.lit(2.0**place)
    return total
