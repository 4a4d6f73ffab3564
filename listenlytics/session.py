"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "listenlytics", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` overrides any of them.

    On a cluster leave ``master`` unset and let spark-submit choose it. Shuffle
    partitions are left to the submit settings there; AQE merges the small ones
    and splits the skewed ones.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            settings["spark.driver.host"] = "127.0.0.1"
            settings["spark.driver.bindAddress"] = "127.0.0.1"
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in spark.checkpoint.dir.

    Only a local session may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="listenlytics-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def new_work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path for tables written between two steps."""
    return f"{shared_folder(spark)}/listenlytics/{label}-{uuid.uuid4().hex}"
