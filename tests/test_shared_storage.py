from types import SimpleNamespace

import pytest

from sigloom.shared_storage import shared_folder


def session(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master, applicationId="app-test"),
    )


def test_the_named_folder_is_used():
    assert shared_folder(session("spark://host", "hdfs://nn/shared/")) == "hdfs://nn/shared"


def test_only_local_sessions_get_a_temporary_folder():
    assert shared_folder(session("local[2]")) == shared_folder(session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host"))
