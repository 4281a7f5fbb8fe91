"""Settings that follow the input, and the shared folder."""

from types import SimpleNamespace

import pytest

from strataloom import session
from tests.compare import SF_DIR

SPLIT = "spark.sql.files.maxPartitionBytes"
PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture
def restored(spark):
    yield spark
    spark.conf.unset(SPLIT)
    spark.conf.unset(PARTITIONS)


def test_small_input_changes_nothing(restored):
    before = restored.conf.get(SPLIT)
    session.size_for(restored.read.parquet(f"{SF_DIR}/orders.parquet"))
    assert restored.conf.get(SPLIT) == before and restored.conf.get(PARTITIONS, None) is None


@pytest.mark.parametrize("tb,split_mb,partitions", [(1, 128, 2048), (100, 524, 204_800), (1000, 1024, 2_048_000)])
def test_settings_grow_with_the_input(restored, monkeypatch, tb, split_mb, partitions):
    df = restored.read.parquet(f"{SF_DIR}/orders.parquet")
    monkeypatch.setattr(session, "listed_bytes", lambda _: tb * 1024**4)
    session.size_for(df)
    value = restored.conf.get(SPLIT)
    assert int(value.rstrip("b")) // 1024**2 == split_mb
    assert int(restored.conf.get(PARTITIONS)) == partitions
    monkeypatch.undo()
    session.size_for(df)
    assert restored.conf.get(SPLIT) == value, "a small table does not lower the settings"


def test_fine_shuffles_take_less_of_the_input(restored, monkeypatch):
    """What a task holds of six gigabytes is no more than of one."""
    joined = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    own = session.own_session(restored)
    df = own.read.parquet(f"{SF_DIR}/orders.parquet")
    for gb in (1, 6):
        monkeypatch.setattr(session, "listed_bytes", lambda _: gb * 1024**3)
        session.size_for(df, fine=True)
        assert int(own.conf.get(PARTITIONS)) == gb * 256
    assert int(own.conf.get(joined).rstrip("b")) == 16 * 1024**2
    monkeypatch.setattr(session, "listed_bytes", lambda _: 100 * 1024**4)
    session.size_for(df, fine=True)
    assert int(own.conf.get(PARTITIONS)) == 204_800
    assert restored.conf.get(PARTITIONS, None) is None


def test_registered_queries_shuffle_finely(spark):
    from strataloom.plans.workload import Lake

    lake = Lake(session.own_session(spark), SF_DIR)
    assert lake.orders.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(session.JOINED_BYTES)


def test_a_session_of_its_own_leaves_the_others_settings(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        own = session.own_session(spark)
        assert own.conf.get("spark.sql.shuffle.partitions") == "9"
        own.conf.set(PARTITIONS, "77")
        assert spark.conf.get(PARTITIONS, None) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_size_as_listed(spark):
    import os

    path = f"{SF_DIR}/orders.parquet"
    df = spark.read.parquet(path)
    assert session.listed_bytes(df) == os.path.getsize(path)
    assert session.listed_bytes(df.join(df.select("o_orderkey"), "o_orderkey")) <= os.path.getsize(path)


def test_scratch_can_be_cleared(spark):
    other = session.own_session(spark)
    path = session.scratch_path(other, "gone")
    other.range(3).write.parquet(path)
    assert session.delete(other, path) and not session.delete(other, path)


def test_scratch_is_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(root)


def test_a_local_application_without_a_folder_gets_one():
    class Unset:
        def get(self, name, default=None):
            return "local[2]" if name == "spark.master" else default

    class Application:
        conf = Unset()
        sparkContext = type("Context", (), {"applicationId": "local-unset"})

    a, b = session.scratch_path(Application(), "x"), session.scratch_path(Application(), "x")
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]


def test_no_machine_local_scratch_on_a_cluster():
    conf = {"spark.master": "yarn"}
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(fake, "x")
