"""The folder all executors see, for checkpoints and tables between steps."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; without it, one below the warehouse."""
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tallyhouse"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has been written to."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """The table written once to the shared folder, as a Parquet table that scans can prune."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.mode("errorifexists").parquet(folder, compression=codec)
    return spark.read.schema(df.schema).parquet(folder)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made and that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action are deleted when it ends, not when the driver collects its garbage."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
