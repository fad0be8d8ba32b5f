"""Isotonic calibration: adjacent violators pooled range by range, neighbouring ranges merged until none violates.

Equal scores are summed first. Each range of scores is pooled in a task of its own; pooling inside a
stretch never has to be undone. Only the outermost pools of each range are compared across
ranges, and only ranges that violate the order at their border are put together and pooled
again, so ranges that are in order already stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdin.functions.numbers import clip
from verdin.session import pinned, shuffle_width

SCHEMA = "part int, low double, high double, total double, weight double"
#: Pools that a table may have to be sent to all tasks: 24 MB.
MOST_POOLS = 1_000_000


def pool(rows: np.ndarray) -> np.ndarray:
    """Pools of rows (low, high, total, weight) in order of their scores: means never fall from one pool to the next."""
    held = np.empty_like(rows)
    size = 0
    for row in rows:
        held[size] = row
        size += 1
        # means compared by cross products
        while size > 1 and held[size - 2, 2] * held[size - 1, 3] >= held[size - 1, 2] * held[size - 2, 3]:
            held[size - 2, 1] = held[size - 1, 1]
            held[size - 2, 2:] += held[size - 1, 2:]
            size -= 1
    return held[:size]


def _pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pools of each part; rows come sorted by part and score. A batch is pooled onto what its part had before."""
    part, held = None, np.empty((0, 4))

    def shown() -> pa.RecordBatch:
        columns = [pa.array(np.full(len(held), part), pa.int32()), *[pa.array(np.ascontiguousarray(held[:, k])) for k in range(4)]]
        return pa.RecordBatch.from_arrays(columns, names=[one.split()[0] for one in SCHEMA.split(", ")])

    for batch in batches:
        parts = batch.column(0).to_numpy()
        rows = np.column_stack([batch.column(k).to_numpy() for k in range(1, 5)]) if batch.num_rows else np.empty((0, 4))
        cuts = np.flatnonzero(parts[1:] != parts[:-1]) + 1
        for own, some in zip(np.split(parts, cuts), np.split(rows, cuts), strict=True):
            if not len(own):
                continue
            if part is not None and own[0] != part:
                yield shown()
                held = np.empty((0, 4))
            part, held = int(own[0]), pool(np.concatenate([held, some]))
    if part is not None:
        yield shown()


def isotonic_pools(scored: DataFrame, label: str, p: str = "p", weight: str | None = None, ranges: int | None = None) -> DataFrame:
    """The fitted steps: ``low`` and ``high`` score, ``mean`` label and ``weight`` of each pool; null scores or labels are left out."""
    each = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = scored.where(F.col(p).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(p).cast("double").alias("low"))
    summed = rows.agg(F.sum(F.col(label).cast("double") * each).alias("total"), F.sum(each).alias("weight")).where("weight > 0")
    dealt = summed.repartitionByRange(ranges or shuffle_width(scored.sparkSession), "low")
    dealt = dealt.select(F.spark_partition_id().alias("part"), "low", F.col("low").alias("high"), "total", "weight")
    pools = pinned(dealt.sortWithinPartitions("part", "low").mapInArrow(_pooled, SCHEMA))
    while True:
        ends = F.struct("total", "weight")
        edges = pools.groupBy("part").agg(F.min_by(ends, "low").alias("first"), F.max_by(ends, "low").alias("last")).orderBy("part").collect()
        merged, number = {}, 0  # one row per range
        for before, edge in zip([None, *edges], edges, strict=False):
            if before is not None and before.last.total * edge.first.weight < edge.first.total * before.last.weight:
                number += 1
            merged[edge.part] = number
        if number + 1 >= len(edges):
            break
        names = scored.sparkSession.createDataFrame(list(merged.items()), "part int, into int")
        pools = pools.join(F.broadcast(names), "part").select(F.col("into").alias("part"), "low", "high", "total", "weight")
        pools = pinned(pools.repartition("part").sortWithinPartitions("part", "low").mapInArrow(_pooled, SCHEMA))
    return pools.select("low", "high", (F.col("total") / F.col("weight")).alias("mean"), "weight")


def apply_isotonic(pools: DataFrame, scored: DataFrame, p: str = "p", name: str = "p_calibrated") -> DataFrame:
    """Values inside [0, 1]: the pool's mean, between two pools by the line between them, beyond the ends the outermost mean.

    The pools are sent to all tasks and therefore counted first; no pools give null.
    """
    if pools.count() > MOST_POOLS:
        raise ValueError(f"more than {MOST_POOLS} pools: round the scores before fitting")
    table = np.array([(r.low, r.high, r.mean) for r in pools.orderBy("low").collect()]).reshape(-1, 3)
    held = scored.sparkSession.sparkContext.broadcast((table[:, :2].ravel(), np.repeat(table[:, 2], 2)))

    @F.arrow_udf("double")
    def stepped(scores: pa.Array) -> pa.Array:
        x, y = held.value
        values = scores.to_numpy(zero_copy_only=False).astype(float)
        known = np.isfinite(values) & bool(len(x))
        out = np.interp(values[known], x, y) if known.any() else np.empty(0)
        found = np.zeros(len(values))
        found[known] = out
        return pa.array(found, mask=~known)

    return scored.withColumn(name, clip(stepped(F.col(p).cast("double")), 0.0, 1.0))
