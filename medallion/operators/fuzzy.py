"""Approximate address lookup: the gazetteer entry nearest to a misspelt address (J1 with J2's choice).

The original's service answered free text with its best candidate. Here an address that the gazetteer lacks takes
the entry within ``max_edits`` edits (insert, delete, replace a character): the fewest edits, then J2's order (score, latitude,
longitude), then the entry's name.

The candidates come from a join, not from comparing all pairs:

* Strings are cut into q-grams (padded at both ends). k edits destroy at most k*q of them, so two strings within k
  edits share a gram among the k*q + 1 rarest of either side, rarity being counted over both tables.
  These *prefixes* are joined; common grams ("RUE", "PARIS") stay out of them by their frequency.
* The join key holds the gazetteer entry's length as well (a probe asks for its own length +- k), and the
  grams' positions may differ by k at most.
* Strings of at most k*q distinct grams (very short or repetitive) may share none with each other; they
  also meet under a marker of their own, so no pair is lost.
* What meets is verified by the edit distance itself.

Only distinct addresses are joined. A gram is in a prefix although frequent only where a string has no rarer
ones; the join is an inner sort-merge join of two stored tables, whose hot keys AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions.columns import address_key
from medallion.operators.geo import KEY
from medallion.session import scratch
from medallion.sinks.writers import write_parquet

_HEAD, _TAIL = "\u0001", "\u0002"  # padding; control characters don't occur in addresses
_SHORT = "\u0003"  # the marker of strings with few grams


def _grams(keys: DataFrame, q: int) -> DataFrame:
    """(key, gram, lo, hi): each distinct gram with its first and last position."""
    padded = F.concat(F.lit(_HEAD * (q - 1)), F.col(KEY), F.lit(_TAIL * (q - 1)))
    each = F.transform(F.sequence(F.lit(1), F.char_length(KEY) + (q - 1)),
                       lambda i: F.struct(F.substring(F.col("__p"), i, F.lit(q)).alias("gram"), i.alias("at")))
    return (keys.select(KEY, padded.alias("__p")).select(KEY, F.explode(each).alias("g"))
            .groupBy(KEY, F.col("g.gram").alias("gram")).agg(F.min("g.at").alias("lo"), F.max("g.at").alias("hi")))


def _prefixes(grams: DataFrame, counts: DataFrame, most: int) -> DataFrame:
    """The ``most`` + 1 rarest grams of each key, exploded; keys of no more than ``most`` get the marker too."""
    rare = (grams.join(counts, "gram").groupBy(KEY)
            .agg(F.array_sort(F.collect_list(F.struct("n", "gram", "lo", "hi"))).alias("all")))  # a string's grams
    marker = F.array(F.struct(F.lit(0).cast("long").alias("n"), F.lit(_SHORT).alias("gram"),
                              F.lit(0).alias("lo"), F.lit(0).alias("hi")))
    taken = F.slice("all", 1, most + 1)
    return (rare.select(KEY, F.explode(F.when(F.size("all") <= most, F.concat(taken, marker)).otherwise(taken)).alias("p"))
            .select(KEY, "p.gram", "p.lo", "p.hi"))


def nearest(keys: DataFrame, best: DataFrame, max_edits: int = 2, q: int = 3) -> DataFrame:
    """For each distinct ``address_key`` of ``keys`` the nearest entry of ``best`` within ``max_edits``:
    address_key, matched_key, edits, latitude, longitude, score. Keys without one are left out.

    ``best`` has one row per address (``geo.best_candidates``). NULL keys match nothing."""
    left = keys.select(KEY).filter(F.col(KEY).isNotNull()).distinct()
    right = best.select(KEY).filter(F.col(KEY).isNotNull())
    a, b = _grams(left, q), _grams(right, q)
    counts = a.select("gram").unionAll(b.select("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    most = max_edits * q
    probe = (_prefixes(a, counts, most)
             .withColumn("length", F.explode(F.sequence(F.char_length(KEY) - max_edits, F.char_length(KEY) + max_edits))))
    index = _prefixes(b, counts, most).select(
        F.col(KEY).alias("matched_key"), "gram", F.col("lo").alias("lo2"), F.col("hi").alias("hi2"),
        F.char_length(KEY).alias("length"))
    stored = scratch(keys.sparkSession, "fuzzy-index")
    write_parquet(index, stored)
    asked = scratch(keys.sparkSession, "fuzzy-probe")
    write_parquet(probe, asked)
    spark = keys.sparkSession
    near = (spark.read.parquet(asked).join(spark.read.parquet(stored), ["gram", "length"])
            .filter((F.col("lo") - F.col("hi2") <= max_edits) & (F.col("lo2") - F.col("hi") <= max_edits))
            .select(KEY, "matched_key").distinct()
            .withColumn("edits", F.levenshtein(KEY, "matched_key", max_edits)).filter(F.col("edits") >= 0))
    found = near.join(best.select(F.col(KEY).alias("matched_key"), "latitude", "longitude", "score"), "matched_key")
    order = F.struct("edits", F.col("score").isNull().alias("no_score"), (-F.col("score")).alias("neg"), "latitude", "longitude",
                     "matched_key", "score")
    return (found.groupBy(KEY).agg(F.min(order).alias("m"))
            .select(KEY, "m.matched_key", "m.edits", "m.latitude", "m.longitude", "m.score"))


def widened(df: DataFrame, best: DataFrame, address: str | Column, max_edits: int = 2, q: int = 3,
            lat_col: str = "latitude", lon_col: str = "longitude") -> DataFrame:
    """``best`` with a row for each address of ``df`` that needs a coordinate, isn't in it and is near an entry: a
    reference table for ``geo.fill_coordinates``, stored in the shared workspace. ``edits`` is 0 for exact rows."""
    addr = F.col(address) if isinstance(address, str) else address
    need = F.col(lat_col).isNull() | F.col(lon_col).isNull()
    asked = df.filter(need).select(address_key(addr).alias(KEY)).filter(F.col(KEY).isNotNull()).distinct()
    more = nearest(asked.join(best.select(KEY), KEY, "left_anti"), best, max_edits, q)
    exact = best.select(KEY, F.col(KEY).alias("matched_key"), F.lit(0).alias("edits"), "latitude", "longitude", "score")
    path = scratch(df.sparkSession, "widened-gazetteer")
    write_parquet(exact.unionByName(more), path)
    return df.sparkSession.read.parquet(path)
