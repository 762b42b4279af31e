"""Corpus pipeline: five stages from raw documents to a training mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and is the
next stage's input. All stages but the last return the columns of ``documents``.
Rows are dropped or texts shortened by each stage's own decisions:

1. quality rules: documents that fail the base rules or lie outside their group's cutoff go;
2. line dedup: lines shared by ten documents or more go (``n_chars`` follows the text);
3. n-gram Jaccard join: of each component the document with the smallest id stays, as one row;
   documents without words stay;
4. benchmark decontamination: documents that hold a benchmark item go;
5. mixing: the training order, one row per copy, by position.

Defined cases: NULL and empty texts fail the base quality rules; repeated rows are judged alike, and of rows equal in id and
text one stays after stage 3, the least by its other columns; NULL ids, languages and sources are
values of their own; ties and very long texts are stated by each operator; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import cut, read
from medallion.llm.decontaminate import tile_matches
from medallion.llm.jaccard import representatives
from medallion.llm.line_dedup import line_dedup
from medallion.llm.mixing import training_order
from medallion.llm.quality import quality_rules


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = docs.columns
    return quality_rules(docs).filter("kept").select(*names)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = docs.columns
    out = line_dedup(docs)
    changed = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*names)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return representatives(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = tile_matches(docs, read(spark, sf_dir, "benchmark"))
    return found.filter(F.size("matches") == 0).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return training_order(docs)


STAGES = [("quality_rules", quality_stage), ("line_dedup", line_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("mixing", mixing_stage)]

ORACLE_SQL = None  # robust covariances and string tiling are not SQL; tests/llm/test_pipeline.py computes run() in plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
