"""Helpers that keep a hot key from landing in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.scratch import write_table

SLICE = "_slice"


def range_slices(df: DataFrame, key: list[str], order: list[str], name: str = "range-slices") -> DataFrame:
    """`df` written down in the order of (key, order), with the number of the slice each row lies in.

    A group of any size, that of the NULL key included, spreads over as many slices as its share of the rows is worth.
    Slice numbers are written, since a recomputed range partitioning may cut elsewhere.
    """
    return write_table(df.repartitionByRange(*key, *order).withColumn(SLICE, F.spark_partition_id()), name)


def _same(left: DataFrame, right: DataFrame, key: list[str]) -> Column:
    same = F.lit(True)
    for name in key:
        same = same & left[name].eqNullSafe(right[f"_{name}"])
    return same


def running(
    slices: DataFrame,
    key: list[str],
    order: list[str],
    sums: dict[str, Column] | None = None,
    xors: dict[str, Column] | None = None,
    maxima: dict[str, Column] | None = None,
) -> DataFrame:
    """`slices` (of `range_slices`) with totals over each row's `key` group, from its first row by `order` (a total order) to the row itself.

    Every slice is totalled on its own; a group that goes on from earlier slices
    adds what it had there. Those additions are one row per slice border at most,
    which is why they may be broadcast.
    """
    folds = {n: (F.sum, c) for n, c in (sums or {}).items()} | {n: (F.bit_xor, c) for n, c in (xors or {}).items()}
    folds |= {n: (F.max, c) for n, c in (maxima or {}).items()}
    valued = slices.withColumns({n: c for n, (_, c) in folds.items()})
    names = [f"_{name}" for name in key]
    # only a slice's greatest key can go on in the next one
    last = valued.groupBy(SLICE).agg(F.max(F.struct(*[F.col(k).alias(n) for k, n in zip(key, names, strict=True)])).alias("last"))
    last = last.select("last.*").distinct()
    parts = valued.join(F.broadcast(last), _same(valued, last, key), "left_semi").groupBy(*key, SLICE).agg(*[fold(n).alias(n) for n, (fold, _) in folds.items()])
    earlier = Window.partitionBy(*key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        *[F.col(k).alias(n) for k, n in zip(key, names, strict=True)],
        F.col(SLICE).alias(f"_{SLICE}"),
        *[fold(n).over(earlier).alias(f"_before_{n}") for n, (fold, _) in folds.items()],
    ).filter(" OR ".join(f"`_before_{n}` IS NOT NULL" for n in folds))
    so_far = Window.partitionBy(*key, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = valued.withColumns({n: fold(n).over(so_far) for n, (fold, _) in folds.items()})
    joined = within.join(F.broadcast(before), _same(within, before, [*key, SLICE]), "left")

    def total(name: str, fold) -> Column:
        if fold is F.max:
            return F.greatest(F.col(name), F.col(f"_before_{name}"))
        start = F.coalesce(F.col(f"_before_{name}"), F.lit(0))
        return F.col(name) + start if fold is F.sum else F.col(name).bitwiseXOR(start)

    return joined.withColumns({n: total(n, fold) for n, (fold, _) in folds.items()}).select(*within.columns)


def number_within(slices: DataFrame, key: list[str], order: list[str], out: str) -> DataFrame:
    """The 1-based place of each row of `slices` in its `key` group by `order`."""
    return running(slices, key, order, sums={out: F.lit(1)}).withColumn(out, F.col(out).cast("int")).drop(SLICE)


def spread(column_values: list[Column], writers: int) -> Column:
    """A repeatable salt in 0..writers-1 from the given columns."""
    return F.pmod(F.xxhash64(*column_values), F.lit(writers))
