"""Line dedup (operator 8): drop lines that many documents share.

Every text is split at line feeds; each line's key (stripped, A-Z lower-cased) is hashed to
128 bits and exploded; documents per key are counted with map-side combine; the positions of
lines whose key reached the threshold are joined back to their documents, where the other
lines are put together by position. Only hashes and positions are exploded; each
text moves once, in the last join, and that join is spread by document and text.

Defined cases: a NULL text counts as one empty line and stays NULL; an empty text is one
empty line; empty keys (shorter than ``min_key_len``) are never dropped; every input row is a
document of its own, so equal rows count separately and get the same result; NULL ids are
allowed; extra columns pass through, an input column named like a result column
(``n_lines``, ``n_dropped``) is replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import cut, lean, session, text_key

_LINE_SCHEMA = "id long, tk long, pos int, first boolean, k1 long, k2 long"
_ARROW = pa.schema([("id", pa.int64()), ("tk", pa.int64()), ("pos", pa.int32()), ("first", pa.bool_()),
                    ("k1", pa.int64()), ("k2", pa.int64())])


def _line_rows(min_key_len: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_intdigest
        half, low = 1 << 63, (1 << 64) - 1
        for batch in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            for ident, tk, text in zip(batch.column("id").to_pylist(), batch.column("tk").to_pylist(),
                                       batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                seen = set()
                for pos, line in enumerate((text or b"").split(b"\n")):
                    key = line.strip().lower()  # bytes: ASCII white space and A-Z only
                    if len(key) < min_key_len or min_key_len > 1 and len(key.decode()) < min_key_len or not key:
                        continue
                    d = digest(key)
                    cols[0].append(ident)
                    cols[1].append(tk)
                    cols[2].append(pos)
                    cols[3].append(d not in seen)
                    cols[4].append((d >> 64) - half)
                    cols[5].append((d & low) - half)
                    seen.add(d)
                if len(cols[0]) >= 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)
                    cols = ([], [], [], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)
    return run


def line_dedup(docs: DataFrame, min_docs: int = 10, min_key_len: int = 1,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the kept lines as text, plus ``n_lines`` (before) and ``n_dropped``."""
    session(docs)
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("tk"),
                      F.col(text_col).alias("text"))
    lines = cut(src.mapInArrow(lean(_line_rows(min_key_len)), _LINE_SCHEMA), "lines")
    hot = (lines.filter("first").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"))
           .filter(F.col("n") >= min_docs).select("k1", "k2"))
    hot = cut(hot, "hot-lines")  # as a table, the join below can split a line that a third of all documents hold
    drops = (lines.join(hot, ["k1", "k2"]).groupBy(F.col("id").alias("__ld_id"), F.col("tk").alias("__ld_tk"))
             .agg(F.collect_set("pos").alias("__ld_drop")))
    text, drop = F.col(text_col), F.col("__ld_drop")
    parts = F.split(text, "\n", -1)
    joined = docs.join(drops, docs[id_col].cast("long").eqNullSafe(F.col("__ld_id"))
                       & (text_key(text_col) == F.col("__ld_tk")), "left")
    kept = F.when(drop.isNull(), text).otherwise(
        F.array_join(F.filter(parts, lambda _, i: ~F.array_contains(drop, i)), "\n"))
    new = {"n_lines": F.when(text.isNull(), F.lit(1)).otherwise(F.size(parts)).cast("long"),
           "n_dropped": F.coalesce(F.size(drop), F.lit(0)).cast("long"), text_col: kept}
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(*(new[c].alias(c) if c == text_col else docs[c] for c in names),
                         new["n_lines"].alias("n_lines"), new["n_dropped"].alias("n_dropped"))
