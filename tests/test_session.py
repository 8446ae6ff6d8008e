import os
from types import SimpleNamespace

import pytest

from ebbwatch.session import remove_scratch, scratch_dir, scratch_path, write_table


def _session(setting, master, checkpoint=None):
    folders = [checkpoint]
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: folders[-1], setCheckpointDir=folders.append
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting or default), sparkContext=context)


def test_setting_of_the_cluster_is_used():
    assert scratch_dir(_session("hdfs://shared/tmp/", "yarn")) == "hdfs://shared/tmp"
    assert scratch_dir(_session(None, "yarn", "hdfs://other")) == "hdfs://other"


def test_cluster_without_setting_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(_session(None, "yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(_session(None, "local-cluster[2,1,1024]"))


def test_local_session_gets_a_folder_of_its_own():
    assert scratch_dir(_session(None, "local[2]")).startswith("/tmp/ebbwatch-")


def test_written_table_keeps_rows_and_schema(spark):
    frame = spark.range(100).selectExpr("id", "cast(id as string) as text", "id / 3 as third")
    table = write_table(frame, "numbers")
    assert table.dtypes == frame.dtypes
    assert table.exceptAll(frame).isEmpty() and table.count() == 100
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_goes_on_request(spark):
    write_table(spark.range(3), "gone")
    folder = f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}".removeprefix("file:")
    assert os.path.isdir(folder)
    remove_scratch(spark)
    assert not os.path.exists(folder)
