"""Mixing sources to target weights (operator 2): a time-varying curriculum.

1. Sizes are words per document; totals per source come from one aggregate.
2. Targets: the mix has ``share`` times all words, split by source weight; a source stops at
   ``max_epochs`` times its size and the excess is shared again by weight. The fixed
   point is found directly: with sources ordered by cap / weight, one level L gives every
   target as min(cap, L * weight).
3. Each source's documents are ordered by a hash of the id. The running number of words
   is a two-level prefix sum (totals per hash bucket, then within the bucket), so no task holds
   a whole source.
4. A source's weight over training time t in [0, 1] is linear, from ``start`` to ``end``.
   Its integral is the cumulative demand D(t); a document whose words begin at c of the
   source's target is placed at the t with D(t) = c / target.
5. Copies are range-sorted by that position.

The last epoch of a source ends inside a document where the target does; that document gives
only its first words to it. Reruns agree: every order ends in the id, the size and the text hash.

Defined cases: a NULL or word-free text has size 0 and takes nothing; a NULL source is a source
of its own, last in order; documents with a NULL id are ordered by a hash of their text; equal rows are documents of their own;
a source without words has target 0; an empty table gives an empty plan; extra columns are ignored
by :func:`mix_plan` and kept by :func:`training_order` (``epoch``, ``position`` and ``words_taken`` replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import WORD, cut, session, text_key

# Weight at the start and at the end of training, by rank of the source's weight.
DEFAULT_SCHEDULE = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (index + 1).cast("int"))


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """(source, rank, weight, source_size, target): one row per source. The two running sums
    over sources run in one task; they hold a row per source, not per document."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = (per.withColumn("rank", (F.row_number().over(order) - 1) % len(weights))
           .withColumn("weight", _pick(weights, F.col("rank")))
           .withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size")))
    w = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    per = (per.withColumn("ratio", F.col("cap") / F.col("weight"))
           .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(every))
           .withColumn("capped", F.sum("cap").over(w) - F.col("cap"))
           .withColumn("rest", F.sum("weight").over(every) - F.sum("weight").over(w) + F.col("weight"))
           .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("rest"))
           .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source", "level")))
                       .over(every)["level"]))
    return per.select("source", "rank", "weight", "source_size",
                      F.when(F.col("level").isNull(), F.col("cap"))
                      .otherwise(F.least("cap", F.col("level") * F.col("weight"))).alias("target"))


def _invert(u: Column, a: Column, b: Column) -> Column:
    """t with (integral of the weight a + (b - a) t from 0 to t) = u * (its integral over [0, 1])."""
    d = b - a
    return F.when(d == 0, u).otherwise((-a + F.sqrt(a * a + d * (a + b) * u)) / F.when(d == 0, 1.0).otherwise(d))


def mix_plan(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, max_epochs: float = 2.0,
             schedule=DEFAULT_SCHEDULE, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, text_key, source, size, source_size, target, taken, and
    ``copies``, an array of (epoch, position, words)."""
    session(docs)
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    # documents without an id are spread by their text
    order = F.md5(F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("\u0000"), text_key(text_col).cast("string"))))
    sizes = cut(docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("text_key"),
                            F.col(source_col).alias("source"), size.alias("size"), order.alias("ord")), "sizes")
    targets = cut(source_targets(sizes, weights, share, max_epochs), "targets")
    sizes = sizes.withColumn("bucket", F.substring("ord", 1, 3))
    before = Window.partitionBy("source").orderBy("bucket")
    buckets = (sizes.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
               .withColumn("base", F.sum("n").over(before) - F.col("n"))
               .join(targets.withColumnRenamed("source", "t_source"), F.col("source").eqNullSafe(F.col("t_source")))
               .select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), "base", "rank",
                       "source_size", "target"))
    inside = Window.partitionBy("source", "bucket").orderBy("ord", "doc_id", "size", "text_key")
    rows = (sizes.withColumn("run", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
            .join(buckets, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket"))))
    begin = F.col("base") + F.col("run")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor(F.col("target") - full * F.col("source_size"))
    rows = rows.withColumns({"begin": begin, "full": full.cast("int")}).withColumn("rest", rest.cast("long"))
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("begin"))).cast("long")
    starts, ends = [s for s, _ in schedule], [e for _, e in schedule]
    a, b = _pick(starts, F.col("rank") % len(starts)), _pick(ends, F.col("rank") % len(ends))

    def copy(e: Column) -> Column:
        u = F.least(F.lit(1.0), (e * F.col("source_size") + F.col("begin")) / F.col("target"))
        return F.struct(e.alias("epoch"), F.when(F.col("target") > 0, _invert(u, a, b)).otherwise(0.0).alias("position"),
                        F.when(e < F.col("full"), F.col("size")).otherwise(last).alias("words"))

    copies = F.filter(F.transform(F.sequence(F.lit(0), F.col("full")), copy), lambda c: c["words"] > 0)
    return rows.select("doc_id", "text_key", "source", "size", "source_size", "target",
                       (F.col("full") * F.col("size") + last).alias("taken"), copies.alias("copies"))


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   **options) -> DataFrame:
    """The mix itself: the documents' columns plus ``epoch``, ``position`` and ``words_taken``, one row
    per copy, range-sorted by position.

    A row is named by id, text hash and source. Rows equal in all three have plans of their own: they are numbered on both sides
    (among the documents by their other columns), so each row takes one plan and the sources' words are the plan's."""
    plan = mix_plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    key = ["__mx_id", "__mx_tk", "__mx_src"]
    plan = plan.select(F.col("doc_id").alias(key[0]), F.col("text_key").alias(key[1]), F.col("source").alias(key[2]),
                       F.col("copies").alias("__mx_c"))
    plan = cut(plan.withColumn("__mx_n", F.row_number().over(Window.partitionBy(*key).orderBy("__mx_c"))), "order-plan")
    names = [c for c in docs.columns if c not in ("epoch", "position", "words_taken")]
    own = docs.select(*names)

    def same(rows: DataFrame) -> Column:
        return (rows[id_col].eqNullSafe(F.col(key[0])) & (text_key(text_col) == F.col(key[1]))
                & rows[source_col].eqNullSafe(F.col(key[2])))

    # what has a second plan: nothing, where the ids are ids
    again = cut(plan.filter("__mx_n = 2").select(*key), "order-equal")
    if again.isEmpty():
        rows = own.join(plan, same(own))
    else:
        twice = own.join(again, same(own), "left_semi")
        once = own.join(again, same(own), "left_anti")
        by = Window.partitionBy(id_col, text_key(text_col), source_col).orderBy(*[c for c in names if c != text_col])
        twice = twice.withColumn("__mx_k", F.row_number().over(by))
        rows = once.join(plan, same(once)).select(*(once[c] for c in names), "__mx_c").unionByName(
            twice.join(plan, same(twice) & (F.col("__mx_k") == F.col("__mx_n"))).select(*(twice[c] for c in names), "__mx_c"))
    out = (rows.select(*names, F.explode("__mx_c").alias("__mx_c"))
           .select(*names, F.col("__mx_c.epoch").alias("epoch"), F.col("__mx_c.position").alias("position"),
                   F.col("__mx_c.words").alias("words_taken")))
    return out.repartitionByRange("position", id_col, "epoch").sortWithinPartitions("position", id_col, "epoch")
