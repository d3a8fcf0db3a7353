"""Shared folder and session settings."""

import time

from layerwell.session import release, scratch_path, settings_for, shared_dir


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_shuffle_partitions_follow_the_data():
    assert settings_for(10, 16)["spark.sql.shuffle.partitions"] == "16"
    assert settings_for(10 * 1024**4, 4000)["spark.sql.shuffle.partitions"] == "81920"


def test_release_drops_the_shuffle_files_of_finished_jobs(spark):
    """they stayed until the driver's heap was full, beside all that later steps wrote."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}

    before = shuffled()
    spark.range(100_000).repartition(7).write.format("noop").mode("overwrite").save()
    left = shuffled() - before
    assert left
    until = time.time() + 30
    while left & shuffled() and time.time() < until:
        release(spark)
        time.sleep(1)
    assert not left & shuffled()
