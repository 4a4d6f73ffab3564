from __future__ import annotations

import pytest

from listenlytics.files import literal, plain_path
from listenlytics.session import new_work_folder, shared_folder


class Stub:
    def __init__(self, master, folder=None):
        self.settings = {"spark.checkpoint.dir": folder} if folder else {}
        self.conf = self
        self.sparkContext = self
        self.master = master

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_the_named_folder_is_used(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(Stub("yarn", "hdfs://x/shared/")) == "hdfs://x/shared"
    assert new_work_folder(Stub("yarn", "/x"), "a") != new_work_folder(Stub("yarn", "/x"), "a")


def test_only_a_local_session_may_use_this_machine():
    local = Stub("local[2]")
    folder = shared_folder(local)
    assert local.get("spark.checkpoint.dir") == folder == shared_folder(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Stub("yarn"))


def test_paths():
    assert plain_path("file:/a/b/") == plain_path("file:///a/b") == "/a/b"
    assert plain_path("s3a://bucket/a") == "/bucket/a"
    assert literal("/a/[x]*.csv") == "/a/\\[x\\]\\*.csv"
