"""Column-name operators (P2-P5, P8, P10): metadata work done in one projection."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import DataType

from medallion.functions.columns import null_of

# The two character classes replaced by "_" when names are
# cleaned. Transaction tables keep "-", every other source maps it to "_".
NAME_CHARS_KEEP_HYPHEN = r"[ ,;{}()\n\t=]"
NAME_CHARS_STRICT = r"[ ,;{}()\n\t=-]"


_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def quoted_name(name: str) -> str:
    """``db.table`` (or one part) for SQL text; only plain identifiers are accepted."""
    parts = name.split(".")
    if not all(_IDENT.match(p) for p in parts):
        raise ValueError(f"not a plain identifier: {name!r}")
    return ".".join(parts)


def sql_text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class NameCollision(ValueError):
    """Two input columns clean to the same output name."""


def clean_name(name: str, keep_hyphen: bool = False) -> str:
    return re.sub(NAME_CHARS_KEEP_HYPHEN if keep_hyphen else NAME_CHARS_STRICT, "_", name)


def cleaned_names(columns: Sequence[str], keep_hyphen: bool = False) -> list[str]:
    """Cleaned names, refusing any pair that would end up with one name."""
    out = [clean_name(c, keep_hyphen) for c in columns]
    seen: dict[str, str] = {}
    for src, dst in zip(columns, out):
        key = dst.lower()  # Spark resolves names case-insensitively by default
        if key in seen and seen[key] != src:
            raise NameCollision(f"columns {seen[key]!r} and {src!r} both clean to {dst!r}")
        seen[key] = src
    return out


def clean_column_names(df: DataFrame, keep_hyphen: bool = False) -> DataFrame:
    """Rename every column in a single projection (``toDF``), idempotent."""
    return df.toDF(*cleaned_names(df.columns, keep_hyphen))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename many columns at once."""
    return df.withColumnsRenamed(dict(mapping))


def add_if_missing(df: DataFrame, defaults: Mapping[str, DataType | str]) -> DataFrame:
    """Add each missing column as a typed NULL; each column is tested on its own."""
    have = {c.lower() for c in df.columns}
    missing = {c: null_of(t) for c, t in defaults.items() if c.lower() not in have}
    return df.withColumns(missing) if missing else df


def find_column(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """First candidate present, compared case-insensitively, in priority order (P10).

    Returns the column's actual name.
    """
    lower = {c.lower(): c for c in reversed(df.columns)}
    for cand in candidates:
        if cand.lower() in lower:
            return lower[cand.lower()]
    return None
