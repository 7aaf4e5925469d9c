from urbanlens.session import checkpoint_dir, scale_conf, scratch_path


def test_checkpoint_folder_comes_from_the_session(spark):
    # The fixture names spark.checkpoint.dir; it is used, not replaced.
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert checkpoint_dir(spark).startswith(("file:" + named, named))
    assert checkpoint_dir(spark) == checkpoint_dir(spark)


def test_scratch_folders_are_new_every_time(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(checkpoint_dir(spark))


def test_scale_conf_sizes_partitions_from_input():
    small = scale_conf(10 * 1024**3)
    big = scale_conf(100 * 1024**4)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert big["spark.sql.shuffle.partitions"] == "100000"
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)
