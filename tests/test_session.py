from lakemart.session import MAX_TASKS, MB, sized_for, sizes_for

PARTITIONS = "spark.sql.shuffle.partitions"
TB = MB * MB


def test_sizes_grow_with_the_input_up_to_a_limit():
    assert sizes_for(0)[PARTITIONS] == 1
    assert sizes_for(TB)[PARTITIONS] == 8192
    assert sizes_for(100 * TB)[PARTITIONS] == MAX_TASKS
    assert sizes_for(100 * TB)["spark.sql.files.maxPartitionBytes"] == 1024 * MB
    assert sizes_for(TB)["spark.sql.files.maxPartitionBytes"] == 128 * MB


def test_sized_for_is_undone(spark):
    before = spark.conf.get(PARTITIONS)
    with sized_for(spark, TB):
        assert spark.conf.get(PARTITIONS) == "8192"
    assert spark.conf.get(PARTITIONS) == before
    with sized_for(spark, MB):
        assert spark.conf.get(PARTITIONS) == before
