"""Connected components of a graph held as a table of edges (alternating stars).

Each round runs a large-star and a small-star step (Kiveris et al., "Connected Components
in MapReduce and Beyond", 2014): neighbours are re-linked to the smallest node seen, until
every component is a star around its smallest node. Both steps are a grouped minimum
(combined map-side) and a join on the node, so a hub is never gathered in one task: the
join's skewed partitions are split. The edge table is written to the shared folder
after every round, and its row count and hash, which tell when it no longer changes, are taken while it is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from medallion.llm.common import cut


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edge table, and its number of rows with the sum of their hashes."""
    seen = Observation()
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    e = cut(edges.observe(seen, F.count(F.lit(1)).alias("n"), total.alias("h")), "edges")
    return e, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns src, dst of one orderable type);
    root is the smallest node of the component. Self-loops and NULL ends are ignored."""
    e, before = _written(edges.filter(F.col("src") != F.col("dst"))
                         .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    if before[0]:
        for _ in range(max_rounds):
            both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = (both.join(low, "u").filter(F.col("v") > F.col("u"))
                     .select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .filter(F.col("u") != F.col("v")).distinct())
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            small = (large.join(low, "u")
                     .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                             F.col("m").alias("v")).filter(F.col("u") != F.col("v")).distinct())
            e, now = _written(small)
            if now == before:
                break
            before = now
        else:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
