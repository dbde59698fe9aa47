from types import SimpleNamespace

import pytest

from outlay.sources import scratch
from outlay.sources.scratch import new_table_path, shared_dir


def test_the_configured_folder_is_used(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == folder
    assert new_table_path(spark, "t").startswith(f"{folder}/t-")
    assert new_table_path(spark, "t") != new_table_path(spark, "t")
    assert folder in spark.sparkContext.getCheckpointDir()


def session(master, folder=None):
    state = SimpleNamespace(folder=None)
    sc = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state.folder,
        setCheckpointDir=lambda path: setattr(state, "folder", path),
    )
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda _, default: folder))


def test_a_local_session_without_setting_gets_its_own_folder_once():
    local = session("local[2]")
    assert shared_dir(local) == shared_dir(local)


def test_a_cluster_without_setting_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))
    assert shared_dir(session("yarn", "hdfs:///scratch")) == "hdfs:///scratch"


def test_a_scope_removes_its_own_tables_only(spark):
    def there(df):
        try:
            return df.count() >= 0
        except Exception:
            return False

    outer = scratch.staged(spark.range(3).toDF("x"), "outer")
    with scratch.scope(spark):
        inner = scratch.staged(spark.range(3).toDF("x"), "inner")
        with scratch.scope(spark):
            innermost = scratch.staged(spark.range(3).toDF("x"), "innermost")
            assert there(innermost)
        assert there(inner) and not there(innermost)
    assert there(outer) and not there(inner)
