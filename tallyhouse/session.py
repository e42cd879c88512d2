"""Session defaults for local work. On a cluster the session is the caller's."""

import os
import tempfile

from pyspark.sql import SparkSession


# For one machine only; a cluster's session names a folder that its executors share.
LOCAL_FOLDER = os.path.join(tempfile.gettempdir(), "tallyhouse-shared")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyhouse")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.checkpoint.dir", os.environ.get("SPARK_CHECKPOINT_DIR", LOCAL_FOLDER))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
