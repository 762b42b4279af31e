"""Unions, replication and partitioning."""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_by_name(a: DataFrame, b: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Bag union matching columns by name (U1); types are widened."""
    return a.unionByName(b, allowMissingColumns=allow_missing)


def union_all_by_name(frames: Iterable[DataFrame | None]) -> DataFrame | None:
    """Fold of many sources, skipping absent ones (U2). ``None`` when all are absent.

    Catalyst flattens the nested unions into one ``Union`` node.
    """
    present = [f for f in frames if f is not None]
    return functools.reduce(DataFrame.unionByName, present) if present else None


def union_positional(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union by column position (U3); names come from the first input."""
    return a.union(b)


def replicate(df: DataFrame, n: int) -> DataFrame:
    """Each row ``n`` times (U4), as a generator in the same stage.

    A loop of ``n - 1`` unions grows the plan linearly and scans the input
    ``n`` times; here the input is read once and no join or shuffle is added.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    return (df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
            .drop("_copy"))


def repartition_to(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """Round-robin (or hash, when ``cols`` are given) into ``n`` partitions."""
    return df.repartition(n, *cols) if cols else df.repartition(n)


def partition_count(df: DataFrame) -> int:
    """Partition count that the physical plan declares (U6); runs no job.

    Only where the plan leaves it open (a file scan, say) the planned input
    splits are counted; under adaptive execution that runs the plan's shuffles.
    """
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    return plan.outputPartitioning().numPartitions() or df.rdd.getNumPartitions()


def partition_sizes(df: DataFrame, *aggs: Column) -> DataFrame:
    """Rows per non-empty partition (and further aggregates), computed on the executors."""
    return (df.groupBy(F.spark_partition_id().alias("partition"))
            .agg(F.count(F.lit(1)).alias("rows"), *aggs))
