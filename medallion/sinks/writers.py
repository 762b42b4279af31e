"""Sinks (K1-K5).

``write_parquet`` replaces a table only once the new one is written whole (:mod:`medallion.sinks.replace`);
it refuses to overwrite a folder that the same plan reads, since that plan could not be run again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medallion import fs
from medallion.sinks.replace import replace, settle


class UnsafeOverwrite(ValueError):
    pass


def _related(a: str, b: str) -> bool:
    a, b = a.rstrip("/") + "/", b.rstrip("/") + "/"
    return a.startswith(b) or b.startswith(a)


def _plain(uri: str) -> str:
    """``file:///x`` and ``file:/x`` alike, percent escapes resolved."""
    return re.sub(r"^file:/+", "/", unquote(uri))


def check_overwrite(df: DataFrame, target: str, sources: Sequence[str] = ()) -> None:
    """Raise when ``target`` is, contains or lies inside a source of ``df``.

    ``sources`` are the roots the caller read from. The plan's own files (a
    reference table joined in, say) are always compared as well: by name,
    without a file system call per file.
    """
    spark = df.sparkSession
    tgt = fs.qualify(spark, target)
    roots = []
    for s in sources:
        # a glob is compared through the paths it matches (metadata only)
        roots += fs.glob(spark, s) if any(ch in s for ch in "*?[") else [fs.qualify(spark, s)]
    inside = _plain(tgt).rstrip("/") + "/"
    for f in df.inputFiles():
        if _plain(f).startswith(inside) or _plain(f) == inside[:-1]:
            raise UnsafeOverwrite(f"{target} is read by the plan it would overwrite ({f})")
    for r in roots:
        if _related(tgt, r):
            raise UnsafeOverwrite(f"{target} is read by the plan it would overwrite ({r})")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  sources: Sequence[str] = (), partition_by: Sequence[str] = (),
                  files: int | None = None) -> None:
    """Parquet sink (K1). ``files`` repartitions first to bound the file count.

    ``overwrite`` leaves the old table in place until the new one is complete."""
    spark = df.sparkSession
    if mode == "overwrite":
        check_overwrite(df, path, sources)
    if files:
        df = df.repartition(files)

    def write(folder: str, mode: str = "errorifexists") -> None:
        w = df.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(folder)

    if mode == "overwrite":
        replace(spark, path, write)
    else:
        settle(spark, path)
        write(path, mode)


def _escaped(name: str) -> Column:
    c = F.col(f"`{name}`").cast("string")
    for plain, code in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return F.coalesce(c, F.lit("\\N"))


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Text folder sink (K2): one string column, one line per row.

    Several columns are joined by tabs; there NULL is written as ``\\N`` and
    backslash, tab and line breaks are escaped, so columns never shift."""
    if len(df.columns) != 1:
        df = df.select(F.concat_ws("\t", *[_escaped(c) for c in df.columns]).alias("value"))
    df.write.mode(mode).text(path)


def show_text(df: DataFrame, n: int = 20, truncate: bool | int = True) -> str:
    """What ``df.show(n)`` prints (K3, L2), returned as a string."""
    trunc = 20 if truncate is True else int(truncate)
    return df._jdf.showString(n, trunc, False)


def schema_json(df: DataFrame) -> str:
    """Schema as JSON (K5); :func:`schema_from_json` reverses it."""
    return df.schema.json()


def schema_from_json(text: str) -> StructType:
    return StructType.fromJson(json.loads(text))


def schema_tree(df: DataFrame) -> str:
    """What ``printSchema()`` prints (K5)."""
    return df._jdf.schema().treeString()


def run_noop(df: DataFrame) -> None:
    """Run the whole plan without keeping the output (timing sink)."""
    df.write.format("noop").mode("overwrite").save()
