from pyspark.sql import functions as F

from citeloom.operators.lookup import MAX_HOT_KEYS, hot_bound, hot_keys, lookup, prune


def _facts(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(
        F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id"))
    )
    return spark.range(30_000).select("id", key.alias("key"))


def _table(spark):
    some = spark.range(0, 30_000, 2).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(1).alias("x"))
    return some.unionAll(spark.sql("SELECT 'hot' AS key, 2 AS x"))


def test_hot_keys_are_counted(spark):
    hot = hot_keys(_facts(spark), "key", rows_per_task=1_000)
    assert [k for k, _ in hot] == ["hot"] and hot[0][1] >= 10
    assert hot == [("hot", 10)]
    assert hot_keys(_facts(spark), "key", total=30_000, rows_per_task=30_000) == []


def test_every_hot_key_is_spread_however_many(spark):
    facts = spark.range(60_000).select("id", F.concat(F.lit("k"), F.col("id") % 1_500).alias("key"))
    hot = hot_keys(facts, "key", rows_per_task=10)
    assert sorted(hot) == sorted((f"k{i}", 4) for i in range(1_500))
    table = spark.range(1_500).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("x"))
    joined = lookup(facts, table, "key", hot=hot)
    assert joined.where("concat('k', x) = key").count() == 60_000


def test_so_many_keys_that_the_bound_rises():
    assert hot_bound(5 * MAX_HOT_KEYS, 3) == 5 and hot_bound(5 * MAX_HOT_KEYS, 30) == 30


def test_spread_lookup_gives_the_plain_join(spark):
    facts, table = _facts(spark), _table(spark)
    want = sorted(map(tuple, facts.join(table, "key", "left").select("id", "key", "x").collect()))
    for hot in ([], [("hot", 16)]):
        for how in ("left", "inner"):
            got = lookup(facts, table, "key", how=how, hot=hot).select("id", "key", "x")
            rows = sorted(map(tuple, got.collect()))
            assert rows == (want if how == "left" else [r for r in want if r[2] is not None])


def test_no_task_gets_a_hot_or_null_key_whole(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup(_facts(spark), _table(spark), "key", hot=[("hot", 64)])
        counts = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(counts) == 30_000 and max(counts) < 11_000


def test_prune_keeps_wanted_rows_or_leaves_large_tables_alone(spark):
    table = _table(spark)
    keys = spark.createDataFrame([("hot",), (None,), ("hot",)], "key string")
    assert [tuple(r) for r in prune(table, keys, "key", 3).collect()] == [("hot", 2)]
    assert prune(table, keys, "key", 10**9) is table


def test_hot_keys_count_single_keys_only_where_a_group_is_large(spark, monkeypatch):
    from citeloom.operators import lookup as module

    want = hot_keys(_facts(spark), "key", rows_per_task=1_000)
    # So few groups that cold keys share one with the hot key.
    monkeypatch.setattr(module, "_MOST_KEY_GROUPS", 2)
    assert hot_keys(_facts(spark), "key", rows_per_task=1_000) == want == [("hot", 10)]
    spread = spark.range(30_000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    assert hot_keys(spread, "key", rows_per_task=1_000) == []
