"""Session settings: durable folders and recommended configuration."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Calls must not be sent twice just because a task is slow.
    "spark.speculation": "false",
    "spark.sql.session.timeZone": "UTC",
}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="restframe-")
        spark.sparkContext.setCheckpointDir(current)
    return current


def new_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/restframe/{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, label: str = "kept") -> DataFrame:
    """Write a result once to the shared folder and read it back.

    For responses of live calls: later actions, retries and lost executors then re-read the
    answers where they would otherwise send the requests again.
    """
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of a session, once."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="restframe-ship-")) / "restframe"
        spark.sparkContext.addPyFile(shutil.make_archive(str(target), "zip", root.parent, root.name))
        _SHIPPED.add(app)
