"""Delimited files with bad rows kept apart (S1, S2): one odd file or line costs itself only.

The lines are read as text, so every file splits. One aggregate over them (per file and block: the number of lines and the
first one, combined map-side) tells each file's header and, as running sums over blocks, where each block's lines begin. Then
each line is parsed by itself:

* a file whose header differs from the expected columns is left out whole, as one quarantined row with its header;
* a line with more or fewer fields (an unclosed quote swallows some) is quarantined with its file, line number and text;
* everything else is returned as an all-string table, like :func:`medallion.sources.readers.read_delimited`.

A quoted field cannot hold a line break here (the line-wise reader would see two lines). Blank lines are left out, as Spark's
CSV reader does. Line numbers count from 1, the header's.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.sources.readers import PROVENANCE_COL

QUARANTINE = ("source_file", "line", "reason", "text")
_BAD = "__corrupt"


@dataclass
class Checked:
    """``good``: the columns (and ``source_file``); ``bad``: source_file, line, reason, text."""

    good: DataFrame
    bad: DataFrame


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """value, file, block and a number that ascends by one from line to line of a block."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.regexp_replace("value", "\r$", "").alias("value"), F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")))


def read_checked(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str = ";") -> Checked:
    """Files under ``path`` (globs allowed) with exactly ``columns``, in that order."""
    lines = _lines(spark, path)
    blocks = (lines.groupBy("file", "block")
              .agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"),
                   F.min(F.when(F.col("block") == 0, F.struct("at", "value"))).alias("head")))
    # a row per block of 100 MB or so; files are numbered apart
    begin = (F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0)))
    header = F.first("head.value", ignorenulls=True).over(Window.partitionBy("file"))
    bare = F.regexp_replace(header, "^\ufeff", "")
    split = F.transform(F.split(bare, F.lit(_quoted(sep))), lambda c: F.regexp_replace(F.trim(c), '^"|"$', ""))
    blocks = blocks.select("file", "block", "first", begin.alias("begin"), header.alias("header"),
                           (split == F.array(*[F.lit(c) for c in columns])).alias("fits"))
    parsed = F.from_csv("value", _ddl(columns), {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    known = blocks.withColumnsRenamed({"file": "b_file", "block": "b_block"})
    rows = (lines.join(known, (F.col("file") == F.col("b_file")) & (F.col("block") == F.col("b_block")))
            .withColumn("line", F.col("begin") + F.col("at") - F.col("first") + 1))
    data = (rows.filter(F.col("fits") & (F.col("line") > 1) & (F.trim("value") != ""))
            .withColumn("row", parsed))
    good = data.filter(F.col(f"row.{_BAD}").isNull()).select(*[F.col("row")[c].alias(c) for c in columns],
                                                             F.col("file").alias(PROVENANCE_COL))
    broken = data.filter(F.col(f"row.{_BAD}").isNotNull()).select(
        F.col("file").alias("source_file"), "line", F.lit("fields").alias("reason"), F.col("value").alias("text"))
    strange = (blocks.filter(~F.col("fits") & (F.col("block") == 0))
               .select(F.col("file").alias("source_file"), F.lit(1).cast("long").alias("line"), F.lit("header").alias("reason"),
                       F.col("header").alias("text")))
    return Checked(good, broken.unionByName(strange))


def _quoted(sep: str) -> str:
    return "\\Q" + sep + "\\E"


def _ddl(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` string" for c in (*columns, _BAD))
