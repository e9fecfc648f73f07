"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SHARED_FOLDER_SETTING = "spark.checkpoint.dir"


def apply_defaults(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    """Settings every job relies on: a fixed time zone, runtime re-planning, skew splitting."""
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the one named by ``spark.checkpoint.dir``, else the one given to
    ``setCheckpointDir``, else the warehouse: the same rule for every master.
    """
    root = (
        spark.conf.get(_SHARED_FOLDER_SETTING, None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return root.rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path for one run under the folder that every executor can reach."""
    return f"{shared_root(spark)}/tripweave/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative fits a checkpoint folder unless the cluster already set one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark, "checkpoint"))
