"""Point tables laid out for a map (Q6): neighbours in one file, bounding boxes that open few files.

Points are ordered by a Z-curve over latitude and longitude (16 bits each, interleaved in the JVM), range-partitioned by it
and written one file per range, so a crowded place gets more files, not larger ones. A small table beside the data
(``_bounds``, hidden from plain readers) holds each file's box. :func:`read_box` opens the files whose boxes meet the asked one; the
box is pushed down into those as well. The table stays plain Parquet.

Rows without both coordinates, or with NaN, come last on the curve and lie in no box.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.sinks.replace import replace, settle

_BITS = 16
_LOW = {8: 0x00FF00FF, 4: 0x0F0F0F0F, 2: 0x33333333, 1: 0x55555555}  # every bit moved apart by one, in four steps


def _spread(c: Column) -> Column:
    for step, mask in _LOW.items():
        c = (c.bitwiseOR(F.shiftleft(c, step))).bitwiseAND(F.lit(mask).cast("long"))
    return c


def z_order(lat: Column, lon: Column) -> Column:
    """Place on the curve, 0 to 2^32 - 1; NULL where a coordinate is missing or not a number."""
    def cell(c: Column, low: float, width: float) -> Column:
        scaled = F.floor((F.nanvl(c, F.lit(None).cast("double")) - low) / width * (1 << _BITS))
        return F.least(F.greatest(scaled, F.lit(0)), F.lit((1 << _BITS) - 1)).cast("long")

    ok = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    z = _spread(cell(lat, -90.0, 180.0)).bitwiseOR(F.shiftleft(_spread(cell(lon, -180.0, 360.0)), 1))
    return F.when(ok, z)


def write_map(df: DataFrame, path: str, files: int, lat_col: str = "latitude", lon_col: str = "longitude") -> None:
    """Replaces the table at ``path`` by ``df`` in about ``files`` files along the curve."""
    spark = df.sparkSession
    z = F.coalesce(z_order(F.col(lat_col), F.col(lon_col)), F.lit(1 << 33).cast("long"))
    # the tail of the key spreads points of one cell over files
    key, tail = z.alias("__z"), F.xxhash64(*df.columns).alias("__t")
    rows = df.select("*", key, tail).repartitionByRange(files, "__z", "__t").sortWithinPartitions("__z", "__t").drop("__z", "__t")

    def write(folder: str) -> None:
        rows.write.parquet(folder)
        box = [f(c).alias(n) for f, c, n in ((F.min, lat_col, "south"), (F.max, lat_col, "north"), (F.min, lon_col, "west"),
                                             (F.max, lon_col, "east"))]
        name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
        (spark.read.parquet(folder).select(name.alias("file"), lat_col, lon_col)
         .filter(~F.isnan(lat_col) & ~F.isnan(lon_col)).groupBy("file").agg(*box).coalesce(1).write.parquet(f"{folder}/_bounds"))

    replace(spark, path, write)


def box_files(spark: SparkSession, path: str, south: float, west: float, north: float, east: float) -> list[str]:
    """The files that may hold points of the box."""
    settle(spark, path)
    meet = ((F.col("north") >= south) & (F.col("south") <= north) & (F.col("east") >= west) & (F.col("west") <= east))
    bounds = spark.read.schema("file string, south double, north double, west double, east double").parquet(f"{path.rstrip('/')}/_bounds")
    return [f"{path.rstrip('/')}/{r.file}" for r in bounds.filter(meet).orderBy("file").collect()]  # a row per file


def read_box(spark: SparkSession, path: str, south: float, west: float, north: float, east: float,
             lat_col: str = "latitude", lon_col: str = "longitude") -> DataFrame:
    """The points with south <= latitude <= north and west <= longitude <= east, from the files that may hold some."""
    names = box_files(spark, path, south, west, north, east)
    schema = spark.read.parquet(path).schema
    df = spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)
    return df.filter(F.col(lat_col).between(south, north) & F.col(lon_col).between(west, east))


