"""Row filters (F1-F4), all built-in predicates so they push down to the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def place_predicate(dept_col: str = "Code departement", postcode_col: str = "Code postal",
                    code: str = "75") -> Column:
    """Department equals ``code`` OR postcode starts with it (F1).

    Three-valued logic is kept: a NULL department with a matching postcode
    passes (``NULL OR true`` is true); NULL on both sides drops the row.
    """
    return (F.col(dept_col) == F.lit(code)) | F.col(postcode_col).startswith(code)


def place_filter(df: DataFrame, code: str = "75", dept_col: str = "Code departement",
                 postcode_col: str = "Code postal") -> DataFrame:
    return df.filter(place_predicate(dept_col, postcode_col, code))


def year_between(date_col: str | Column, first: int, last: int) -> Column:
    """Inclusive year range (F2); a NULL date fails it."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.year(d).between(F.lit(first), F.lit(last))


def incomplete(cols: Sequence[str]) -> Column:
    """Any of ``cols`` is NULL (F3, first branch)."""
    pred = F.col(cols[0]).isNull()
    for c in cols[1:]:
        pred = pred | F.col(c).isNull()
    return pred


def complete(cols: Sequence[str]) -> Column:
    """All of ``cols`` are present (F3, second branch; F4).

    Unlike ``dropna``, a NaN value counts as present.
    """
    pred = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        pred = pred & F.col(c).isNotNull()
    return pred


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows where every column in ``cols`` is non-NULL."""
    return df.filter(complete(list(cols)))
