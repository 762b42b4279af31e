"""Word count (A3) over any text column, whole texts.

Tokens are runs of characters between the default delimiters of Java's
``StringTokenizer`` (blank, tab, newline, carriage return, form feed), which
is what the classic MapReduce word-count example splits on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the tokenizer's delimiter class.
TOKEN_DELIMITERS = r"[ \t\n\r\f]+"


def tokens(df: DataFrame, text_col: str = "value") -> DataFrame:
    """One row per token, in column ``word``."""
    return (df.select(F.explode(F.split(F.col(text_col), TOKEN_DELIMITERS)).alias("word"))
            .filter(F.col("word") != ""))


def word_count(df: DataFrame, text_col: str = "value") -> DataFrame:
    """``(word, count)`` for every distinct token.

    The explode and the partial count run in one code-generated stage, so
    each task ships one row per distinct word it saw; a very frequent word
    costs one row per task in the shuffle, not one per occurrence.
    """
    return tokens(df, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
