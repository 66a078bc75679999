from stridelake.session import REQUIRED_CONF, checkpoint_root, cluster_conf


def test_cluster_conf_scales_with_cores():
    small, big = cluster_conf(8), cluster_conf(8000)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert big["spark.sql.shuffle.partitions"] == "24000"
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "128MB"


def test_checkpoint_root_reads_the_session(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert spark.conf.get("spark.sql.session.timeZone") == REQUIRED_CONF["spark.sql.session.timeZone"]
