"""A Spark session with what the operators rely on."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def session(name: str = "tallyloom", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """UTC, ANSI arithmetic, adaptive plans with skew splitting. Shuffle partitions, memory and the shared folder (spark.checkpoint.dir) are the cluster's to set."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    own = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in (own | (conf or {})).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir. A session of one machine (local) may use a temporary folder instead; anywhere else an unset folder is an error, since each executor would write to its own disk."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="tallyloom-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")
