"""Session defaults and the shared folder for data a job has to write down."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name="pulse", master=None, **conf):
    """A session with the settings the jobs are written for.

    No expression in this package depends on the session time zone; UTC is set so
    that timestamps print the way the feed states them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark, purpose):
    """A fresh path below the folder that ``spark.checkpoint.dir`` names.

    Every executor must see the folder, so on a cluster it has to be configured. A
    local session without the setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="pulse-")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")
