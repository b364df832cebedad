from pyspark.sql import functions as F

from stormglass.llm.scratch import CLEANUP


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_shuffle_files_go_when_a_table_is_staged(spark, scratch):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    rows = spark.range(0, 10_000, 1, 8).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("n"))
    left = scratch.stage(rows.join(rows.withColumnRenamed("n", "m"), "k"), "a")
    assert shuffle_files(spark) <= before
    assert left.agg(F.sum("n"), F.count("*")).first() == (10_000, 1000)
    assert scratch.stage(rows, "b").count() == 1000
    assert spark.conf.get(CLEANUP, None) == setting
