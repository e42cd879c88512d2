"""Tables between the steps of one job, in the shared folder."""

import gc

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans.shared import new_folder


class Scratch:
    """Writes the result of a step, and takes it away once no later step reads it.

    A finished step is read from files that all executors see, so losing one costs no
    recomputation of earlier steps.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: dict[int, str] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        folder = new_folder(self.spark, name)
        df.write.option("compression", "zstd").parquet(folder)
        table = self.spark.read.schema(df.schema).parquet(folder)
        self.folders[id(table)] = folder
        # Shuffle files of the step go when the driver's objects for it are collected; left
        # alone, that may be long after the job. The scheduler holds on to the last job, so
        # a short one has to follow first.
        table.take(1)
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
        return table

    def drop(self, table: DataFrame) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folders.pop(id(table)))
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)
