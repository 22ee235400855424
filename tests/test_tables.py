"""Where working tables go."""

from types import SimpleNamespace

import pytest

from riskflow.sources.tables import shared_root


def session(master, configured=None, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: configured),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: folder),
    )


def test_the_setting_comes_first():
    assert shared_root(session("spark://host:7077", "s3a://shared/work/", "hdfs://other")) == "s3a://shared/work"


def test_then_the_folder_of_the_context():
    assert shared_root(session("yarn", None, "hdfs://other/work/")) == "hdfs://other/work"


def test_only_a_local_master_gets_a_temporary_folder():
    assert shared_root(session("local[4]")) == shared_root(session("local"))
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        shared_root(session("local-cluster[3,2,1024]"))
