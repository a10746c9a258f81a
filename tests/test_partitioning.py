from ratelens.operators.partitioning import spread


def test_spread_only_when_too_few_partitions(spark):
    small = spark.range(100).coalesce(1)
    spread_small = spread(small, ["id"], min_partitions=4)
    assert spread_small.rdd.getNumPartitions() == 4
    assert sorted(r.id for r in spread_small.collect()) == list(range(100))
    wide = spark.range(100).repartition(8)
    assert spread(wide, ["id"], min_partitions=4) is wide
