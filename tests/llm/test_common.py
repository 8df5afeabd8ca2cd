from tomeworks.llm import common


def test_a_staged_copy_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: str(disk.getAllFiles().mkString("\n")).count(".data")
    before, setting = files(), spark.conf.get(common._CLEANUP)
    kept = common.stage(spark.range(1000).repartition(4, "id").groupBy("id").count(), "tidy")
    assert files() <= before
    assert spark.conf.get(common._CLEANUP) == setting
    assert kept.count() == 1000
