"""Mixing of sources to target weights with an exact fit of the remaining budget.

A source that is to give more than it holds is taken whole as often as that
goes. The rest is a subset-sum problem over document sizes: documents are
counted by exact size, an even share of every size is taken, and bounded
knapsack dynamic programming over the remaining counts fills what is left.
Which documents of a size are taken is a seeded choice.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdin.llm.frames import free_names, pinned, word_count

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = 7
BINS = 4096


def fill(lengths: list[int], counts: list[int], budget: int) -> dict[int, int]:
    """How many documents of each length to take so that the sum comes as near to ``budget`` as it can from below.

    ``lengths`` are distinct and positive, ``counts`` how many there are. The
    same share of each length is taken first. Larger lengths then bring the
    remainder down to a few of the longest documents, and a bounded knapsack
    over bit sets settles it. Deterministic.
    """
    total = sum(size * count for size, count in zip(lengths, counts, strict=True))
    if budget <= 0 or not total:
        return {}
    if budget >= total:
        return dict(zip(lengths, counts, strict=True))
    taken = {size: count * budget // total for size, count in zip(lengths, counts, strict=True)}
    left = {size: count - taken[size] for size, count in zip(lengths, counts, strict=True)}
    rest = budget - sum(size * count for size, count in taken.items())
    order = sorted(lengths, reverse=True)
    floor = 4 * order[0]
    while rest > floor:  # one of each length at a time keeps the shares even
        before = rest
        for size in order:
            if left[size] and rest - size > floor // 2:
                taken[size] += 1
                left[size] -= 1
                rest -= size
        if rest == before:
            break
    # parts of 1, 2, 4, ... copies reach every number of copies up to the count
    parts, mask = [], (1 << rest + 1) - 1
    reach, steps = 1, []
    for size in order:
        many, copies = min(left[size], rest // size), 1
        while many and not reach >> rest & 1:
            use = min(copies, many)
            steps.append(reach)
            parts.append((size, use))
            reach |= reach << size * use & mask
            many -= use
            copies *= 2
    at = reach.bit_length() - 1
    for (size, use), before in zip(reversed(parts), reversed(steps), strict=True):
        if not before >> at & 1:
            at -= size * use
            taken[size] += use
    return {size: count for size, count in taken.items() if count}


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST_COPIES, share: float = 1.0) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from ``source`` and ``size``, one row per source.

    Sources in code point order, null last, take the weights in turn. They share
    ``share`` of all sizes; what a source's ceiling (``most`` times its size)
    keeps it from taking is shared by weight among the others. With ``level``
    the common size per weight, a target is the smaller of ceiling and weight
    times level: sources reach their ceilings in the order of ceiling per weight.
    """
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    table = table.withColumn("weight", F.get(turn, ((F.row_number().over(named) - 1) % len(weights)).cast("int")))
    table = table.withColumn("ceiling", most * F.col("source_size").cast("double"))
    table = table.withColumn("ratio", F.col("ceiling") / F.col("weight"))
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    table = table.withColumns(
        {
            "goal": F.sum("source_size").over(everything) * share,
            "capped": F.coalesce(F.sum("ceiling").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
            "open": F.sum("weight").over(upto.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    level = (F.col("goal") - F.col("capped")) / F.col("open")
    first = F.min(F.when(level <= F.col("ratio"), F.struct("ratio", level.alias("level")))).over(everything)
    target = F.least(F.col("ceiling"), F.col("weight") * first["level"])
    return table.select("source", "source_size", F.coalesce(target, F.col("ceiling")).alias("target"))


def _takes(group: pd.DataFrame) -> pd.DataFrame:
    rest = int(group["rest"].iloc[0])
    sizes = [int(v) for v in group["size"]]
    found = fill(sizes, [int(v) for v in group["n"]], rest)
    return pd.DataFrame({"source": group["source"], "size": group["size"], "take": [found.get(size, 0) for size in sizes]})


def mixed(
    docs: DataFrame,
    size: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_COPIES,
    share: float = 1.0,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    Size is the number of words unless given; null texts have none. Documents
    of size zero are taken as often as their source is taken whole. Rows with the
    same ``doc_id`` and ``source`` are one unit: they are sized together and
    taken together, each with its own words. Null ids form one unit per source,
    null sources one source. The result depends on ids and seed only, so reruns agree. No
    unit exceeds ``most`` copies.
    """
    size = word_count(F.col("text")) if size is None else size
    sized = pinned(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size.cast("long").alias("size")))
    goals = targets(sized, weights, most, share)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goals = goals.withColumn("base", F.least(whole, F.lit(most).cast("long")))
    rest = F.round(F.col("target") - F.col("base") * F.col("source_size")).cast("long")
    goals = pinned(goals.withColumn("rest", F.when(F.col("base") >= most, 0).otherwise(rest)))
    units = sized.groupBy("doc_id", "source").agg(F.sum("size").alias("unit"))
    units = units.withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "source"))
    units = units.withColumn("bin", F.pmod("order", F.lit(BINS)).cast("int"))
    bins = pinned(units.where("unit > 0").groupBy("source", "unit", "bin").agg(F.count("*").alias("n")))
    histogram = bins.groupBy("source", F.col("unit").alias("size")).agg(F.sum("n").alias("n"))
    same = F.expr("g.source <=> h.source")
    fitted = (
        histogram.alias("h")
        .join(F.broadcast(goals.alias("g")) if goals.count() <= 10_000 else goals.alias("g"), same)
        .select("h.source", "size", "n", "rest")
        .groupBy("source")
        .applyInPandas(_takes, "source string, size long, take long")
    )
    # documents of a size in seeded order: whole bins first, then a part of one bin
    below = Window.partitionBy("source", "unit").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    quota = (
        bins.withColumn("below", F.coalesce(F.sum("n").over(below), F.lit(0)))
        .alias("b")
        .join(fitted.alias("f"), F.expr("b.source <=> f.source and b.unit = f.size"))
        .select("b.source", "b.unit", "b.bin", F.greatest(F.col("take") - F.col("below"), F.lit(0)).alias("quota"))
    )
    place = F.row_number().over(Window.partitionBy("source", "unit", "bin").orderBy("order", "doc_id"))
    chosen = (
        units.withColumn("place", place)
        .alias("u")
        .join(quota.alias("q"), F.expr("u.source <=> q.source and u.unit = q.unit and u.bin = q.bin"))
        .select("u.doc_id", "u.source", F.expr("cast(place <= quota as long)").alias("extra"))
        .where("extra = 1")
    )
    return (
        sized.alias("d")
        .join(chosen.alias("c"), F.expr("d.doc_id <=> c.doc_id and d.source <=> c.source"), "left")
        .select("d.*", F.coalesce("extra", F.lit(0)).alias("extra"))
        .alias("d")
        .join(goals.alias("g"), F.expr("d.source <=> g.source"))
        .select("doc_id", "d.source", "size", "source_size", "target", (F.col("base") + F.col("extra")).alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: left out, once, or repeated; all columns stay."""
    doc_id, source, copies, copy = free_names(docs, "_doc_id", "_source", "_copies", "_copy")
    chosen = mixed(docs, **settings).where("copies > 0").groupBy("doc_id", "source").agg(F.max("copies").alias(copies))
    chosen = chosen.select(F.col("doc_id").alias(doc_id), F.col("source").alias(source), copies)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc_id)) & F.col("source").cast("string").eqNullSafe(F.col(source))
    rows = docs.join(chosen, same).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    return rows.select(*[F.col(f"`{name}`") for name in docs.columns])
