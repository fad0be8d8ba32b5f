"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdin.session import pinned


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Node and smallest reachable node for every node with a link: ``node``, ``root`` (long).

    Links may repeat and point either way; rows with a null end and links of a
    node with itself are ignored. Each round is written to the shared folder;
    only two numbers per round reach the driver. The number of rounds grows
    with the logarithm of the longest path. No links give no rows.
    """
    edges = (
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .where(f"`{left}` is not null and `{right}` is not null and u <> v")
        .distinct()
    )
    edges = pinned(edges)
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where("v > u")
            .join(lowest, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        edges = pinned(
            small.select("u", F.col("m").alias("v"))
            .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct()
        )
        after = _state(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
