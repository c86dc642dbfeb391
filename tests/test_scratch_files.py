"""Tables in the shared folder: the shuffle files of their write go with it, and they can be removed."""

import os
from threading import Event

from pyspark.sql import functions as F

from vatlens.plans import iterate


def _shuffles(spark):
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def test_tables_remove_the_shuffles_of_their_write(spark):
    spark.sparkContext._jvm.java.lang.System.gc()
    df, before = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), spark.conf.get(iterate.CLEANUP, None)
    held = _shuffles(spark)
    table = iterate.kept(df)
    assert _shuffles(spark) <= held and table.count() == 7
    assert spark.conf.get(iterate.CLEANUP, None) == before
    iterate.release(table)
    assert not os.path.exists(table._vatlens_table[1].removeprefix("file:"))


def test_threads_that_hold_the_setting_put_it_back_together(spark):
    before, began, go = spark.conf.get(iterate.CLEANUP, None), Event(), Event()

    def long():
        with iterate.shuffles_removed(spark):
            began.set()
            assert go.wait(60)
            return spark.conf.get(iterate.CLEANUP)

    def short():
        assert began.wait(60)
        with iterate.shuffles_removed(spark):
            pass
        kept = spark.conf.get(iterate.CLEANUP)        # the other thread still holds it
        go.set()
        return kept
    assert iterate.together(long, short) == ["true", "true"]
    assert spark.conf.get(iterate.CLEANUP, None) == before
