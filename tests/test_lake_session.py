"""Settings of the registered queries' sessions."""

from strataloom.plans.workload import Lake
from strataloom.session import own_session
from tests.compare import SF_DIR

ROWS_COUNTED = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def test_stream_queries_do_not_count_their_state(spark):
    """A count looks each key of the state up once more."""
    before = spark.conf.get(ROWS_COUNTED, None)
    lake = Lake(own_session(spark), SF_DIR)
    assert lake.spark.conf.get(ROWS_COUNTED) == "false" and spark.conf.get(ROWS_COUNTED, None) == before
