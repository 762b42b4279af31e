"""Counts reported beside a run (A1, A2).

``observe`` collects aggregate metrics while the plan's own action runs, so a
count printed next to a write costs no second scan of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach named aggregate ``metrics``; read them after the next action."""
    obs = Observation(name)
    exprs = [m.alias(k) for k, m in metrics.items()] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *exprs), obs


def count_rows(df: DataFrame) -> int:
    """Row count (A1): one job; partial counts are summed on the driver."""
    return df.count()
