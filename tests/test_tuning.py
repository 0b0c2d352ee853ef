from tessera.plans.tuning import scale_conf


def test_scale_conf_sizes_partitions_from_input():
    small = scale_conf(1 << 30)
    assert small["spark.sql.shuffle.partitions"] == "200"
    big = scale_conf(100 * (1 << 40))  # 100 TiB
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (128 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
