import pytest

from flowmart import workspace
from tests.conftest import rows


class _Session:
    """Stands for a session with some settings."""

    def __init__(self, master, **settings):
        values = {"spark.master": master, **{name.replace("_", "."): value for name, value in settings.items()}}
        self.conf = type("Conf", (), {"get": lambda _, name, default=None: values.get(name, default)})()
        self.sparkContext = type("Context", (), {"getCheckpointDir": lambda _: None, "applicationId": "app"})()


def test_the_named_folder_is_used():
    assert workspace.working_root(_Session("yarn", spark_checkpoint_dir="hdfs://x/shared/")) == "hdfs://x/shared"


def test_a_folder_is_made_up_for_a_local_master_only():
    local = _Session("local[4]")
    assert workspace.working_root(local) == workspace.working_root(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.working_root(_Session("spark://host:7077"))


def test_written_frames_come_back_unchanged(spark):
    frame = spark.sql("SELECT id, CAST(NULL AS string) name, timestamp_ntz'2024-01-01 00:00:00' t FROM range(3)")
    again = workspace.written(frame, "test")
    assert again.dtypes == frame.dtypes and rows(again) == rows(frame)
    assert workspace.new_folder(spark, "a") != workspace.new_folder(spark, "a")
