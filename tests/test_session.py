"""Session helpers: the cluster's checkpoint folder wins; partition sizing math."""

from tramline.session import checkpoint_dir, ensure_checkpoint_dir, recommended_conf


def test_checkpoint_dir_comes_from_the_session(spark):
    d = checkpoint_dir(spark)
    assert d  # set once by the test session (a local folder only because it was unset)
    assert ensure_checkpoint_dir(spark, fallback="/nonexistent/should-not-be-used") == d


def test_recommended_conf_scales_with_input():
    tb = 2 ** 40
    big = recommended_conf(100 * tb, total_cores=8000)
    # blocks are map tasks times partitions: partitions stop at 20,000 and scans split coarser
    assert int(big["spark.sql.shuffle.partitions"]) == 20_000
    assert big["spark.sql.files.maxPartitionBytes"] == str(2 ** 30)
    middle = recommended_conf(tb, total_cores=800)
    assert int(middle["spark.sql.shuffle.partitions"]) == tb // (256 * 2 ** 20)
    small = recommended_conf(10 * 2 ** 20, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16  # never below 2 per core
    assert big["spark.sql.autoBroadcastJoinThreshold"] == str(64 * 2 ** 20)
