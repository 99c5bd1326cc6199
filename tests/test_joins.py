"""The skew-safe joins give the same rows on every path."""

import pytest
from pyspark.sql import functions as F

from tallyboard.functions import joins


@pytest.fixture
def skewed(spark):
    """A third of all rows share one key and another share of them has none."""
    return spark.range(0, 3000, 1, 6).select(
        "id",
        F.when(F.col("id") < 1000, "hot").when(F.col("id") < 1300, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 400).cast("string"))).alias("k"),
    )


def test_fits(spark):
    assert joins.fits(spark.range(5), 5)
    assert not joins.fits(spark.range(6), 5)
    assert joins.fits(spark.range(0), 0)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_lookup_join_is_the_same_beyond_the_bound(skewed, spark, rows, how):
    lookup = spark.sql("SELECT * FROM VALUES ('hot', 1), ('k7', 2), ('k7', 3), (NULL, 4) AS t(code, v)")
    small = joins.lookup_join(skewed, lookup, {"k": "code"}, how)
    large = joins.lookup_join(skewed, lookup, {"k": "code"}, how, rows=0)
    assert small.columns == large.columns
    assert "code" not in small.columns
    assert rows(small) == rows(large)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_spread_left_join_does_not_pile_up_rows_that_cannot_match(skewed, spark):
    other = spark.sql("SELECT * FROM VALUES ('k7', 2) AS t(k, v)")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = joins.spread_left_join(skewed, other, ["k"], idle=F.col("k") == "hot")
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 3000
        assert max(sizes) < 600
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_code_that_most_rows_share_is_dealt_over_tasks(skewed, spark, rows):
    """Known to the list or not, and several rows of the list for it."""
    other = spark.sql("SELECT * FROM VALUES ('k7', 2), ('k7', 3) AS t(k, v)")
    plain = joins.spread_left_join(skewed, other, ["k"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = joins.spread_left_join(skewed, other, ["k"], copies=joins.COPIES)
        sizes = [r[1] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert rows(dealt) == rows(plain)
        assert max(sizes) < 900
        known = joins.spread_left_join(skewed, spark.sql("SELECT 'hot' AS k, 1 AS v"), ["k"], copies=joins.COPIES)
        assert known.filter("v = 1").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_large_lookup_is_split_at_its_hot_key(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        df = spark.range(0, 60_000, 1, 8).select("id", key.alias("k"))
        lookup = spark.range(60_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("code"), F.col("id").alias("v"))
        lookup = lookup.union(spark.sql("SELECT 'hot', -1L"))
        joined = joins.lookup_join(df, lookup, {"k": "code"}, rows=0)
        values = joined.collect()
        assert len(values) == 60_000
        assert all(r.v == (-1 if r.k == "hot" else r.id) for r in values)
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("limits", [{}, {"rows": 0}, {"rows": 0, "hot_rows": 100}, {"rows": 0, "hot_rows": 1}])
def test_attach_group_stats_agrees_on_every_path(skewed, rows, limits):
    stats = {"top": F.max("id"), "n": F.count(F.lit(1))}
    got = rows(joins.attach_group_stats(skewed, ["k"], stats, F.col("n") > 3, **limits), "id", "k", "top", "n")
    local = {}
    for i, k in rows(skewed, "id", "k"):
        local.setdefault(k, []).append(i)
    expected = [
        (i, k, max(local[k]), len(local[k])) if k is not None and len(local[k]) > 3 else (i, k, None, None)
        for i, k in rows(skewed, "id", "k")
    ]
    assert sorted(got) == sorted(expected, key=lambda r: r[0])


def test_product_is_whole_on_both_paths(spark, rows):
    left = spark.range(7).withColumnRenamed("id", "a")
    right = spark.range(5).select(F.col("id").alias("b"), F.nullif(F.col("id"), F.lit(2).cast("bigint")).alias("c"))
    expected = sorted((a, b) for a in range(7) for b in range(5))
    assert sorted(rows(joins.product(left, right), "a", "b")) == expected
    assert sorted(rows(joins.product(left, right, rows=0), "a", "b")) == expected
    assert joins.product(left, right.limit(0)).count() == 0
