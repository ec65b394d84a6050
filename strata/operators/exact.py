"""Sums and means of doubles that do not depend on the order of addition.

Every double is cut into limbs of 24 bits at fixed places, which are integers. Tasks add up limbs of one place,
which is exact in any order; a key's sums are then put together, with carries, and rounded once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import let

# Bits of a limb, and limbs that hold any double from its highest place on. Sums of limbs fit a long for 2**38 rows.
BITS = 24
LIMBS = 4
# Doubles below this are scaled up by whole limbs first, so that all steps stay among the normal ones.
TINY = 2.0**-900
LIFT = 7

_SUMS = [f"_limb{k}" for k in range(LIMBS)]


def _limbs() -> list[Column]:
    """``place`` and limbs of ``_x``, which is the sum of ``_limbk * 2**(BITS * (place - k))``, with the steps there.

    The logarithm may miss the place by one at its edges, for which there is room in the limbs. Every step is a
    column that the next one names, so that it is compiled and worked out once.
    """
    x, lifted = F.col("_x"), F.col("_lifted")
    small = F.abs(x) < TINY
    logarithm = F.log2(F.when(lifted > 0, lifted).otherwise(1.0))
    steps = [
        F.abs(F.when(small, x * 2.0 ** (BITS * LIFT)).otherwise(x)).alias("_lifted"),
        F.floor(logarithm / BITS).cast("int").alias("_at"),
        (lifted / F.pow(F.lit(2.0), F.col("_at") * BITS)).alias("_rest0"),
    ]
    for k, name in enumerate(_SUMS):
        rest = F.col(f"_rest{k}")
        steps.append(F.floor(rest).alias(f"_whole{k}"))
        steps.append(((rest - F.col(f"_whole{k}")) * 2.0**BITS).alias(f"_rest{k + 1}"))
        steps.append(F.when(x < 0, -F.col(f"_whole{k}")).otherwise(F.col(f"_whole{k}")).alias(name))
    steps.append(F.when(x.isNotNull(), F.col("_at") - F.when(small, LIFT).otherwise(0)).alias("place"))
    return steps


@lru_cache(maxsize=4)
def _built(context: int) -> tuple[list[Column], Column]:
    """The steps and the total as columns, which take longer to put together than to run over few keys."""
    return _limbs(), _total(F.col("_parts"))


def _total(parts: Column) -> Column:
    """The sum of ``(place, limbs)`` parts as the nearest double."""

    def of(bounds: Column) -> Column:
        places = F.sequence(bounds["least"] - (LIMBS - 1), bounds["most"])

        def at(place: Column) -> Column:
            """All limbs of one place."""

            def added(total: Column, part: Column) -> Column:
                step = part["place"] - place
                limb = F.lit(0).cast("bigint")
                for k, name in enumerate(_SUMS):
                    limb = F.when(step == k, part[name]).otherwise(limb)
                return total + limb

            return F.aggregate(parts, F.lit(0).cast("bigint"), added)

        def carried(limbs: Column) -> Column:
            """Limbs from the highest place on, all but the first between 0 and ``2**BITS``."""

            def step(state: Column, limb: Column) -> Column:
                value = state["carry"] + limb
                return F.struct(
                    F.shiftright(value, BITS).alias("carry"),
                    F.concat(F.array(value.bitwiseAND(F.lit((1 << BITS) - 1))), state["limbs"]).alias("limbs"),
                )

            start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("limbs"))
            return F.aggregate(limbs, start, step, lambda state: F.concat(F.array(state["carry"]), state["limbs"]))

        def nearest(limbs: Column) -> Column:
            def either(up: Column) -> Column:
                down = carried(F.transform(limbs, lambda limb: -limb))
                size = _nearest(F.when(up[0] < 0, down).otherwise(up), bounds["most"])
                return F.when(up[0] < 0, -size).otherwise(size)

            return let(carried(limbs), either)

        return let(F.transform(places, at), nearest)

    bounds = F.struct(
        F.array_min(F.transform(parts, lambda p: p["place"])).alias("least"),
        F.array_max(F.transform(parts, lambda p: p["place"])).alias("most"),
    )
    return let(bounds, of)


def _nearest(limbs: Column, most: Column) -> Column:
    """The nearest double to limbs of which the first is at place ``most + 1`` and none is negative.

    Four limbs from the first that is not 0 on have over 54 bits; of the others it only matters whether they are 0.
    """

    def of(x: Column) -> Column:
        def limb(k: int) -> Column:
            return F.coalesce(F.get(x["limbs"], x["first"] + k), F.lit(0)).cast("decimal(38,0)")

        power = F.lit(1 << BITS).cast("decimal(9,0)")
        mantissa = limb(0).cast("decimal(14,0)")
        for k in range(1, LIMBS):
            mantissa = (mantissa * power).cast("decimal(36,0)") + limb(k).cast("decimal(9,0)")
            mantissa = mantissa.cast("decimal(36,0)")
        rest = F.exists(F.slice(x["limbs"], x["first"] + 1 + LIMBS, F.greatest(F.size(x["limbs"]), F.lit(1))), lambda v: v != 0)
        whole = (mantissa * F.lit(2).cast("decimal(1,0)") + F.when(rest, 1).otherwise(0).cast("decimal(1,0)")).cast("double")
        exponent = (most + 1 - x["first"] - (LIMBS - 1)) * BITS - 1
        half = F.floor(exponent / 2).cast("int")
        return whole * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)

    first = F.array_position(F.transform(limbs, lambda v: v != 0), True).cast("int") - 1
    found = F.struct(limbs.alias("limbs"), first.alias("first"))
    return let(found, lambda x: F.when(x["first"] < 0, F.lit(0.0)).otherwise(of(x)))


def exact_sums(df: DataFrame, keys: Sequence[str | Column], value: str) -> DataFrame:
    """The keys with ``_sum``, the nearest double to the sum of their values, and ``_n``, how many there are.

    NULLs are left out; where none is left the sum is NULL. NaN and infinities add up as they do elsewhere.
    Tasks reduce their rows by key and place of the highest limb, of which the values of a key have few.
    """
    x = F.col(value).cast("double")
    finite = F.abs(x) < math.inf
    named = [F.col(key) if isinstance(key, str) else key for key in keys]
    rows = df.select(*named, F.when(finite, x).alias("_x"), F.when(~finite, x).alias("_other"))
    names = rows.columns[: len(named)]
    quoted = [F.col(f"`{name}`") for name in names]
    steps, total = _built(id(SparkContext._active_spark_context))
    sums = rows.select("*", *steps).groupBy(*quoted, "place").agg(
        *[F.sum(name).alias(name) for name in _SUMS],
        F.count("place").alias("_n"),
        F.sum("_other").alias("_other"),
        F.count("_other").alias("_others"),
    )
    part = F.when(F.col("place").isNotNull(), F.struct("place", *_SUMS))
    parts = sums.groupBy(*quoted).agg(
        F.collect_list(part).alias("_parts"),
        F.sum(F.col("_n") + F.col("_others")).alias("_n"),
        F.sum("_other").alias("_other"),
    )
    total = F.when(F.size("_parts") > 0, total)
    return parts.select(*quoted, F.coalesce("_other", total).alias("_sum"), "_n")


def exact_mean(df: DataFrame, keys: Sequence[str | Column], value: str, alias: str | None = None) -> DataFrame:
    """Mean per key from exact sums: the same bits however the rows are dealt. NULL keys are a key of their own."""
    sums = exact_sums(df, keys, value)
    mean = F.col("_sum") / F.nullif(F.col("_n"), F.lit(0))
    return sums.select(*[F.col(f"`{c}`") for c in sums.columns if c not in ("_sum", "_n")], mean.alias(alias or value))
