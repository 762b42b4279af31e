"""Scale behaviour on small data: hot keys, shuffled joins, layout."""

import contextlib

from pyspark.sql import functions as F

from medallion.operators import geo
from medallion.operators.text import word_count


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def skewed_transactions(spark, n=30000):
    # a third of the rows share one address; half of all rows already have coordinates;
    # every row is its own record (a document id), as transactions are
    return spark.range(n).select(
        F.col("id").cast("string").alias("doc"),
        F.when(F.col("id") % 3 == 0, F.lit("1 RUE HOT 75001 PARIS"))
         .otherwise(F.concat(F.col("id") % 997, F.lit(" RUE COLD 75001 PARIS"))).alias("addr"),
        F.when(F.col("id") % 2 == 0, F.lit(48.0)).alias("latitude"),
        F.when(F.col("id") % 2 == 0, F.lit(2.0)).alias("longitude"))


def test_shuffled_fill_splits_hot_key_and_spreads_complete_rows(spark, tmp_ws):
    df = skewed_transactions(spark)
    gaz = spark.range(997).select(F.concat(F.col("id"), F.lit(" RUE COLD 75001 PARIS")).alias("address"),
                                  F.lit(49.0).alias("latitude"), F.lit(3.0).alias("longitude"),
                                  F.lit(1.0).alias("score"))
    gaz = gaz.unionByName(spark.createDataFrame([("1 RUE HOT 75001 PARIS", 47.0, 1.0, 1.0)],
                                                "address string, latitude double, longitude double, score double"))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
                        "spark.sql.adaptive.coalescePartitions.enabled": "false",
                        "spark.sql.shuffle.partitions": "16"}):
        best = geo.prepare_best_candidates(gaz, f"{tmp_ws}/best")
        out = geo.fill_coordinates(df, best, "addr")
        rows = out.groupBy("latitude").count().collect()
        out.collect()
        final = out._jdf.queryExecution().executedPlan().toString()
    counts = {r.latitude: r["count"] for r in rows}
    assert sum(counts.values()) == 30000
    assert counts[48.0] == 15000                    # existing coordinates kept
    assert counts[47.0] == 5000                     # hot address (odd ids with id % 3 == 0)
    assert "SortMergeJoin" in final
    assert "skew=true" in final or "isSkewJoin=true" in final


def test_hot_word_is_combined_before_the_shuffle(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit("the hot the"))
                                   .otherwise(F.concat(F.lit("w"), F.col("id").cast("string"))).alias("value"))
    wc = word_count(df)
    assert {r.word: r["count"] for r in wc.filter("word = 'the'").collect()} == {"the": 2 * 6667}
    txt = wc._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in txt


def test_silver_partitioned_by_year_prunes(spark, sf, tmp_ws):
    from medallion.plans import acceptance as A
    from medallion.plans.refine import run_refine_transactions
    from medallion.sources import fixtures as fx
    glob = f"{fx.transactions(spark, sf)}/{fx.TRANSACTION_GLOB}"
    rep = run_refine_transactions(spark, glob, A.best_gazetteer(spark, sf), f"{tmp_ws}/s",
                                  years=A.YEARS, partition_by_year=True)
    silver = spark.read.parquet(f"{tmp_ws}/s")
    assert silver.count() == rep.rows
    one = silver.filter("annee = 1997")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(annee" in plan
    assert one.count() > 0


def test_explicit_salting_matches_and_spreads_the_hot_key(spark):
    df = skewed_transactions(spark)
    gaz = spark.range(997).select(F.concat(F.col("id"), F.lit(" RUE COLD 75001 PARIS")).alias("address"),
                                  F.lit(49.0).alias("latitude"), F.lit(3.0).alias("longitude"),
                                  F.lit(1.0).alias("score"))
    gaz = gaz.unionByName(spark.createDataFrame([("1 RUE HOT 75001 PARIS", 47.0, 1.0, 1.0)],
                                                "address string, latitude double, longitude double, score double"))
    best = geo.best_candidates(gaz)
    hot = geo.hot_keys(df, "addr", min_rows=1000)
    assert [r.address_key for r in hot.collect()] == ["1 RUE HOT 75001 PARIS"]
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}):
        plain = geo.fill_coordinates(df, best, "addr")
        salted = geo.fill_coordinates(df, best, "addr", hot=hot, salt_buckets=8)
        assert salted.exceptAll(plain).count() == 0 and salted.count() == plain.count() == 30000
        # the hot key's rows now land in 8 different reducers
        per_task = (salted.filter("latitude = 47.0")
                    .groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert len(per_task) >= 4


def test_refine_from_table_splits_complete_rows_when_reference_is_large(spark, sf, tmp_ws):
    from medallion.operators import geo as G
    from medallion.plans import acceptance as A
    from medallion.plans.refine import run_refine_transactions
    best = A.best_gazetteer(spark, sf)
    assert G.broadcastable(best)
    table = A.transactions_raw(spark, sf)
    table.write.parquet(f"{tmp_ws}/bronze")
    bronze = spark.read.parquet(f"{tmp_ws}/bronze")
    small = run_refine_transactions(spark, bronze, best, f"{tmp_ws}/a", years=A.YEARS)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert not G.broadcastable(best)
        large = run_refine_transactions(spark, bronze, best, f"{tmp_ws}/b", years=A.YEARS)
    assert (small.rows, small.missing_coordinates, small.unresolved) == \
           (large.rows, large.missing_coordinates, large.unresolved)
    a, b = spark.read.parquet(f"{tmp_ws}/a"), spark.read.parquet(f"{tmp_ws}/b")
    assert a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count()


def test_salting_every_key_is_exact(spark):
    df = skewed_transactions(spark, n=3000)
    gaz = spark.range(997).select(F.concat(F.col("id"), F.lit(" RUE COLD 75001 PARIS")).alias("address"),
                                  F.lit(49.0).alias("latitude"), F.lit(3.0).alias("longitude"),
                                  F.lit(1.0).alias("score"))
    best = geo.best_candidates(gaz)
    hot = geo.hot_keys(df, "addr", min_rows=1)            # hundreds of keys
    plain = geo.fill_coordinates(df, best, "addr")
    salted = geo.fill_coordinates(df, best, "addr", hot=hot, salt_buckets=4, join_hint="merge")
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_rows_without_an_address_spread_or_bypass_the_shuffled_join(spark):
    no = F.lit(None)
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 > 0, F.concat(F.col("id"), F.lit(" RUE COLD 75001 PARIS"))).alias("addr"),
        no.cast("double").alias("latitude"), no.cast("double").alias("longitude"))
    best = geo.best_candidates(spark.range(997).select(
        F.concat(F.col("id"), F.lit(" RUE COLD 75001 PARIS")).alias("address"), F.lit(49.0).alias("latitude"),
        F.lit(3.0).alias("longitude"), F.lit(1.0).alias("score")))
    with conf(spark, **{"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}):
        spread = geo.fill_coordinates(df, best, "addr", salt_by=["id"], join_hint="merge")
        split = geo.fill_coordinates(df, best, "addr", split_complete=True, join_hint="merge")
        assert "SortMergeJoin" in spread._jdf.queryExecution().executedPlan().toString()
        # the coordinates are counted so that the optimiser keeps the join
        per_task = (spread.filter("addr IS NULL").groupBy(F.spark_partition_id().alias("p"))
                    .agg(F.count(F.lit(1)).alias("n"), F.count("latitude").alias("lat")).collect())
        assert len(per_task) >= 8 and max(r["n"] for r in per_task) < 250
        assert spread.count() == 3000 and spread.exceptAll(split).count() == 0 and split.exceptAll(spread).count() == 0


def test_broadcast_limit_parsing_and_check(spark, tmp_ws):
    from medallion.operators.geo import _to_bytes
    assert _to_bytes("10485760b") == 10 << 20 and _to_bytes("64m") == 64 << 20
    assert _to_bytes("1g") == 1 << 30 and _to_bytes("-1") == -1 and _to_bytes("2048") == 2048
    spark.range(1000).write.parquet(f"{tmp_ws}/t")
    t = spark.read.parquet(f"{tmp_ws}/t")
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "1b"}):
        assert not geo.broadcastable(t)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "10m"}):
        assert geo.broadcastable(t)
