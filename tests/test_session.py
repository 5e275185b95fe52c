from meterlark.session import fresh_path, materialize, scratch


def exists(spark, path):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_folders_of_a_block_go_with_it(spark):
    outside = fresh_path(spark, "outside")
    spark.range(3).write.parquet(outside)
    with scratch(spark) as made:
        assert materialize(spark.range(5), "inside").count() == 5
        with scratch(spark) as inner:
            materialize(spark.range(2), "inner")
        assert not exists(spark, inner[0] if inner else "/nowhere")
        assert len(made) == 1 and exists(spark, made[0])
    assert not exists(spark, made[0]) and exists(spark, outside)
