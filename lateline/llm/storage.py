"""Tables that a job writes to the shared folder and reads back, so that a lost executor costs a re-read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lateline.workspace import REMOVE_SHUFFLES as REMOVE_SHUFFLES
from lateline.workspace import shared_root, shuffles_removed


class Scratch:
    """A folder of its own for each call of an operator; what is in it stays until the shared folder is cleaned."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/lateline/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"

    def keep(self, table: DataFrame, name: str, *partition_by: str) -> DataFrame:
        path = f"{self.root}/{name}"
        writer = table.write
        with shuffles_removed(self.spark):  # what comes after reads the stored table
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
