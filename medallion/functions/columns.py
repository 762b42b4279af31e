"""Column expressions (X1-X14, P6, P7) that stay inside whole-stage codegen.

Spark 4 runs with ANSI mode on: a plain ``cast`` of bad text, ``to_date`` of a
bad date and ``split(..)[i]`` past the end raise instead of giving NULL. The
helpers below use the ``try_`` forms so that bad values become NULL, which is
what the pipelines rely on.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: str | Column) -> Column:
    """Text to double; NULL on bad text (X9). Leading/trailing blanks are accepted."""
    return _c(c).try_cast("double")


def decimal_comma_to_double(c: str | Column, decimal_sep: str | None = ",") -> Column:
    """Text with a decimal comma to double.

    ``decimal_sep=None`` keeps the plain cast, where ``"1234,5"`` becomes NULL.
    """
    col = _c(c)
    if decimal_sep:
        col = F.replace(col.cast("string"), F.lit(decimal_sep), F.lit("."))
    return to_double(col)


def parse_date(c: str | Column, fmt: str = "dd/MM/yyyy") -> Column:
    """Text to date; NULL for impossible dates such as ``31/13/2022``."""
    return F.try_to_date(_c(c).cast("string"), fmt)


def split_get(c: str | Column, sep: str, i: int) -> Column:
    """``split(c, sep)[i]`` that is NULL past the end of the array.

    ``sep`` is a literal separator, not a pattern.
    """
    return F.get(F.split(_c(c), literal_pattern(sep)), F.lit(i))


def literal_pattern(sep: str) -> str:
    """Java regex matching ``sep`` literally."""
    if re.fullmatch(r"[\w ,;:]+", sep):
        return sep
    return "\\Q" + sep + "\\E"


def element(c: str | Column, i: int) -> Column:
    """Array element that is NULL past the end."""
    return F.get(_c(c), F.lit(i))


def null_of(t: DataType | str = DoubleType()) -> Column:
    """Typed NULL column."""
    return F.lit(None).cast(t)


def address_key(c: str | Column, min_length: int = 5) -> Column:
    """Normalised lookup key for an address.

    Trim, collapse runs of white space to one blank and upper-case. Addresses
    shorter than ``min_length`` after trimming give NULL, so they never match.
    """
    norm = F.upper(F.regexp_replace(F.trim(_c(c)), r"\s+", " "))
    return F.when(F.length(norm) >= F.lit(min_length), norm)


def full_address(parts: list[str | Column], suffix: str | None = "PARIS",
                 min_body_length: int | None = None) -> Column:
    """Blank-joined address that skips NULL parts (X1), with a fixed suffix.

    ``min_body_length`` applies the "too short" guard to the address before the
    suffix is added; by default the suffix makes the guard unreachable, as in
    the original pipeline.
    """
    body = F.concat_ws(" ", *[_c(p) for p in parts])
    out = F.concat_ws(" ", body, F.lit(suffix)) if suffix else body
    if min_body_length is not None:
        out = F.when(F.length(F.trim(body)) >= F.lit(min_body_length), out)
    return out


def strict_concat(*parts: str | Column) -> Column:
    """Concatenation that is NULL when any part is NULL."""
    return F.concat(*[_c(p) for p in parts])
