"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# What the operators rely on. Everything else is left to the cluster.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SESSION_DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, for staged tables.

    The cluster names it in ``spark.checkpoint.dir``, or a job has set it with
    ``setCheckpointDir``. Only a local session may fall back to a temporary
    folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="martwright-"))
    return context.getCheckpointDir().rstrip("/")
