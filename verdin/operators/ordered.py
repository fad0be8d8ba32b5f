"""Running totals, row numbers, exact quantiles and thresholds over a total order.

Spark evaluates a window without partition keys in a single task, and a window
over a hot key in one task per key. The functions here first range-partition the
rows by (keys, order), number and sum inside each range, and add the totals of
the ranges before. Only one or two rows per range ever meet in one task, so
neither a global order nor a group with a third of all rows becomes a bottleneck.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdin.session import pinned, shuffle_width

_RANGE = "_range"
_GROUP = "_group"


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, Column],
    within: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """``df`` plus one inclusive running sum per entry of ``totals``.

    ``order`` should be a total order inside each ``within`` group; rows that
    compare equal keep an arbitrary order among themselves.
    """
    ranges = ranges or shuffle_width(df.sparkSession)
    keys = [F.col(name) for name in within]
    staged = df.withColumns({f"_add_{name}": value for name, value in totals.items()})
    staged = staged.repartitionByRange(ranges, *keys, *order)
    # partition numbers are read twice below, so they are written down first
    staged = pinned(staged.withColumn(_RANGE, F.spark_partition_id()))

    inside = Window.partitionBy(_RANGE, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = staged.withColumns({name: F.sum(f"_add_{name}").over(inside) for name in totals})

    carried = _carried(staged, list(totals), within)
    on = F.col(f"s.{_RANGE}") == F.col(f"c.{_RANGE}")
    if within:
        summed = summed.withColumn(_GROUP, F.struct(*keys))
        on = on & F.col(f"s.{_GROUP}").eqNullSafe(F.col(f"c.{_GROUP}"))
    # at most two rows per range, whatever the table size
    joined = summed.alias("s").join(F.broadcast(carried).alias("c"), on, "left")
    kept = [F.col(f"s.{name}").alias(name) for name in df.columns]
    values = [(F.col(f"s.{name}") + F.coalesce(F.col(f"c._before_{name}"), F.lit(0))).alias(name) for name in totals]
    return joined.select(*kept, *values)


def _carried(staged: DataFrame, totals: list[str], within: Sequence[str]) -> DataFrame:
    """Per range (and group touching its edge): what the ranges before it add up to."""
    sums = [F.sum(f"_add_{name}").alias(f"_sum_{name}") for name in totals]
    if not within:
        per_range = staged.groupBy(_RANGE).agg(*sums)
        before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
        group = []
    else:
        keyed = staged.withColumn(_GROUP, F.struct(*within))
        edges = keyed.groupBy(_RANGE).agg(F.min(_GROUP).alias("_low"), F.max(_GROUP).alias("_high"))
        # a group that spans ranges is the last of one range and the first of the next
        at_edge = keyed.join(F.broadcast(edges), _RANGE).where(
            F.col(_GROUP).eqNullSafe(F.col("_low")) | F.col(_GROUP).eqNullSafe(F.col("_high"))
        )
        per_range = at_edge.groupBy(_RANGE, _GROUP).agg(*sums)
        before = Window.partitionBy(_GROUP).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
        group = [F.col(_GROUP)]
    return per_range.select(
        _RANGE, *group, *[F.sum(f"_sum_{name}").over(before).alias(f"_before_{name}") for name in totals]
    )


def row_number(
    df: DataFrame, order: Sequence[Column], name: str = "row_number", within: Sequence[str] = ()
) -> DataFrame:
    """1-based position of each row in the order, globally or inside each group."""
    return running_totals(df, order, {name: F.lit(1).cast("bigint")}, within)


def quantiles(
    df: DataFrame, column: str, wanted: Mapping[str, float], within: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    Equal values are counted before anything is ordered. Nulls are ignored; a
    group with only nulls gets no row.
    """
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(*within, F.col(column).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    # sampled, shuffled and summed below: computed once
    return quantiles_of_counts(pinned(counted), "_value", "_copies", wanted, within)


def quantiles_of_counts(
    counted: DataFrame, value: str, copies: str, wanted: Mapping[str, float], within: Sequence[str] = ()
) -> DataFrame:
    """``quantiles`` of values that are already counted: one row per group and value, its number in ``copies``."""
    counted = counted.where(F.col(value).isNotNull()).select(*within, F.col(value).alias("_value"), F.col(copies).alias("_copies"))
    run = running_totals(counted, [F.col("_value")], {"_upto": F.col("_copies")}, within)
    sizes = counted.groupBy(*within).agg(F.sum("_copies").alias("_size"))
    if within:
        named = sizes.select(*[F.col(k).alias(f"_k_{k}") for k in within], "_size")
        match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in within]
        run = run.join(named, match, "inner")
    else:
        run = run.withColumn("_size", F.lit(sizes.first()["_size"]))

    def at(position: Column) -> Column:
        held = (position >= F.col("_upto") - F.col("_copies")) & (position < F.col("_upto"))
        return F.max(F.when(held, F.col("_value")))

    picks, outputs = [], []
    for name, share in wanted.items():
        spot = (F.col("_size") - 1) * F.lit(float(share))
        picks += [
            at(F.floor(spot)).alias(f"_low_{name}"),
            at(F.ceil(spot)).alias(f"_high_{name}"),
            F.max(spot - F.floor(spot)).alias(f"_rest_{name}"),
        ]
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        outputs.append((low + (high - low) * F.col(f"_rest_{name}")).alias(name))
    return run.groupBy(*within).agg(*picks).select(*within, *outputs)


def quantile_edges(df: DataFrame, column: str, bins: int) -> list[float]:
    """Distinct edges of ``bins`` equal-count bins, in ascending order."""
    wanted = {f"q{i}": i / bins for i in range(bins + 1)}
    found = quantiles(df, column, wanted).first()
    return sorted({found[name] for name in wanted} - {None}) if found else []


def bin_by_edges(value: Column, edges: Sequence[float]) -> Column:
    """0-based bin of ``value``: bins are (low, high], the first one closed on both sides."""
    if len(edges) < 2:
        return F.when(value.isNotNull(), F.lit(0))
    passed = sum((F.when(value > F.lit(edge), 1).otherwise(0) for edge in edges[1:-1]), F.lit(0))
    inside = (value >= F.lit(edges[0])) & (value <= F.lit(edges[-1]))
    return F.when(inside, passed)


def nth_largest(df: DataFrame, column: str, n: int) -> float | None:
    """The ``n``-th largest value; the smallest one when ``n`` is not inside 1..rows-1."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_copies"))
    run = running_totals(counted, [F.col(column).desc()], {"_upto": F.col("_copies")})
    found = run.agg(
        F.max(F.when(F.col("_upto") >= n, F.col(column))).alias("hit"),
        F.min(column).alias("low"),
        F.sum("_copies").alias("size"),
    ).first()
    if found["size"] is None:
        return None
    return found["low"] if n <= 0 or n >= found["size"] else found["hit"]
