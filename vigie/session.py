"""Session helpers used by tests, the bench and the entry point.

Library code never creates a session; it takes the caller's DataFrames.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vigie") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VIGIE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_code(spark)
    return spark


def ship_code(spark: SparkSession) -> None:
    """Send this package to the workers, once per context; needed where it is not installed on them."""
    context = spark.sparkContext
    if getattr(context, "_vigie_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="vigie-code-"), "vigie.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._vigie_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used as is. Only a local master, whose tasks all
    run on this machine, gets a scratch folder when it is unset; elsewhere that is an error, as no executor could read
    another one's local files.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not current:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="vigie-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", current)
    try:
        spark.sparkContext.setCheckpointDir(current)
    except Exception:  # Spark Connect has no SparkContext
        pass
    return current
