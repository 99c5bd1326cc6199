"""Sizes that are seen while writing."""

import time

from pyspark.sql import functions as F

from tallyboard.functions.joins import fits
from tallyboard.sources.session import bounded, last_read, release, rows_at_most, settle


def jobs(spark, run):
    """How many jobs a call starts."""
    group = f"count-{id(run)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rows_come_with_the_write(spark):
    for n in (0, 1, 1000):
        assert rows_at_most(settle(spark.range(n))) == n
    assert rows_at_most(settle(spark.range(50).filter("id < 0"))) == 0
    assert rows_at_most(settle(spark.range(50).limit(0))) == 0
    assert rows_at_most(settle(spark.createDataFrame([], "a int").join(spark.range(3), F.lit(True)))) == 0
    assert rows_at_most(settle(spark.range(60).repartition(7).groupBy(F.col("id") % 4).count())) == 4
    assert rows_at_most(spark.range(5)) is None


def test_fits_asks_nothing_of_a_settled_frame(spark):
    small = settle(spark.range(100))
    assert jobs(spark, lambda: fits(small, 100)) == 0 and fits(small, 100)
    assert not fits(small, 99)
    assert jobs(spark, lambda: fits(spark.range(200).filter("id % 2 = 0"), 100)) > 0


def test_bounds_pass_on(spark):
    a, b = settle(spark.range(3)), settle(spark.range(4))
    both = bounded(a.union(b), a, b)
    assert rows_at_most(both) == 7 and jobs(spark, lambda: fits(both, 7)) == 0
    # a bound is no count: a smaller frame still fits
    assert fits(bounded(a.filter("id = 0"), a), 1)
    assert rows_at_most(bounded(spark.range(2), a, spark.range(1))) is None


def test_release(spark):
    kept, gone = settle(spark.range(5)), settle(spark.range(6))
    release(gone)
    assert kept.count() == 5
    path = spark._jvm.org.apache.hadoop.fs.Path(gone._settled_at)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_settling_leaves_no_shuffle_files(spark):
    """The setting is as before afterwards, and a frame can be settled twice."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert sorted(map(tuple, settle(counted).collect())) == sorted(map(tuple, settle(counted).collect())) == sorted(map(tuple, counted.collect()))
    assert spark.conf.get(name, None) == before


def test_a_last_read_leaves_no_shuffle_files(spark):
    """Also of a frame that was made before; it can be computed again."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return files.getAllFiles().mkString(" ").count("shuffle_")

    counted = spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count()
    before = shuffled()
    assert sorted(r["count"] for r in last_read(counted).to_pylist()) == [142] * 1 + [143] * 6
    late = time.monotonic() + 10  # executors delete them on their own time
    while shuffled() > before and time.monotonic() < late:
        time.sleep(0.1)
    assert shuffled() <= before
    assert counted.count() == 7
