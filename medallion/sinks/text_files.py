"""One text file per value, as large as it may be, of which no task writes more than a part.

A text source takes a file's lines from one task, so a value with half of the rows would have half of
the table in a task. Here the lines are written in parts by ranges of the order, and the parts are put at the
end of their files in rounds: in each round a task copies what is next of one file.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion import fs
from medallion.session import scratch, ship_package

PART_BYTES = 32 << 20  # text of a part, about
ROUND_BYTES = 128 << 20  # of a file that a task copies, but for the end of its last part
PIECE_BYTES = 8 << 20


def _append(parts: str, target: str):
    """Puts parts at the end of their files. A task that is run again goes on where the file ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from medallion.streaming.landing import store_of

        (read, source), (write, folder) = store_of(parts), store_of(target)
        for b in batches:
            for name, part, start, length in zip(*(b.column(c).to_pylist() for c in ("name", "part", "start", "length"))):
                info = write.get_file_info(f"{folder}/{name}")
                have = info.size if info.is_file else 0
                if have < start:
                    raise OSError(f"{target}/{name} has {have} bytes; {part} starts at {start}")
                if have < start + length:
                    with (read.open_input_file(f"{source}/{part}") as f,
                          (write.open_append_stream if have else write.open_output_stream)(f"{folder}/{name}") as out):
                        f.seek(have - start)
                        while piece := f.read(PIECE_BYTES):
                            out.write(piece)
                yield pa.RecordBatch.from_pydict({"name": [name]})
    return run


def write_text_files(df: DataFrame, by: str, order: Sequence[str], text: str, path: str,
                     part_bytes: int = PART_BYTES, round_bytes: int = ROUND_BYTES) -> None:
    """``<path>/<value>.txt`` for each value of ``by``: its rows' ``text`` in order, a line each.

    ``path`` must be new, and of a file system that Arrow knows and can append to (local, HDFS)."""
    spark = df.sparkSession
    ship_package(spark)
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if fs.exists(spark, path):
        raise FileExistsError(path)
    fs.mkdirs(spark, path)
    size = df.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 1)).first()[0]
    if not size:
        return
    root = scratch(spark, "text-parts")
    (df.select(by, *order, text).repartitionByRange(max(wide, -(-size // part_bytes)), by, *order).sortWithinPartitions(by, *order)
     .select(by, text).write.partitionBy(by).text(f"{root}/parts"))
    start = F.sum("length").over(Window.partitionBy("name").orderBy("n", "part")) - F.col("length")  # a row per part
    (spark.read.format("binaryFile").load(f"{root}/parts").select("path", "length")
     .withColumn("part", F.regexp_extract("path", r"([^/]+/[^/]+)$", 1))
     .withColumn("n", F.regexp_extract("part", r"/part-(\d+)", 1).cast("long"))
     .withColumn("name", F.concat(F.regexp_extract("part", r"^[^=]+=([^/]*)/", 1), F.lit(".txt")))
     .withColumn("start", start).withColumn("round", F.floor(F.col("start") / F.lit(round_bytes)))
     .select("name", "part", "start", "length", "round").write.parquet(f"{root}/plan"))
    plan = spark.read.parquet(f"{root}/plan")
    for turn in plan.groupBy("round").agg(F.count_distinct("name").alias("files")).orderBy("round").collect():  # a row per round
        (plan.filter(F.col("round") == turn["round"]).repartitionByRange(min(wide, turn["files"]), "name")
         .sortWithinPartitions("name", "start").mapInArrow(_append(f"{root}/parts", path), "name string")
         .write.format("noop").mode("overwrite").save())
    fs.delete(spark, f"{root}/parts")
