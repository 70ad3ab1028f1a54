"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def spark_session(app: str = "rangeload", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is tuned for.

    ``conf`` overrides any of them; dots in names are written as ``__``.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.streaming.metricsEnabled": "true",
    }
    settings.update({name.replace("__", "."): str(value) for name, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str = "run") -> str:
    """A fresh folder that every executor can reach.

    It lies under the ``spark.checkpoint.dir`` of the session. Only a local
    master, where driver and executors share one disk, may fall back to a
    temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/rangeload-{purpose}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix=f"rangeload-{purpose}-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
