"""The shared folder comes from the session."""

import pytest

from tierline import workspace


class Session:
    """Just the configuration of a session."""

    def __init__(self, **values):
        self.values = {k.replace("__", "."): v for k, v in values.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


def test_configured_folder_is_used():
    session = Session(spark__checkpoint__dir="hdfs:///shared/", spark__master="yarn")
    assert workspace.shared_dir(session) == "hdfs:///shared"
    assert workspace.new_dir(session, "x") != workspace.new_dir(session, "x")


def test_a_cluster_without_one_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_dir(Session(spark__master="spark://host:7077"))


def test_a_local_session_gets_one():
    session = Session(spark__master="local[4]")
    folder = workspace.shared_dir(session)
    assert workspace.shared_dir(session) == folder


def test_paths(spark, tmp_path):
    assert workspace.path_exists(spark, str(tmp_path))
    assert not workspace.path_exists(spark, str(tmp_path / "no"))


def test_checkpoint_cuts_the_lineage(spark):
    df = workspace.checkpointed(spark.range(5).selectExpr("id * 2 AS id"))
    assert sorted(r.id for r in df.collect()) == [0, 2, 4, 6, 8]
    assert "Range" not in df._jdf.queryExecution().executedPlan().toString()
