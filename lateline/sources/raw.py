"""The raw observation table: one folder per loaded month, reloaded as a whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.contract import OBSERVATION_COLUMNS, RAW_SCHEMA
from lateline.functions.months import check_month
from lateline.functions.observation import decode_ns_truncated, month_of
from lateline.sources.bronze import bronze_path, scan_nanos_parquet
from lateline.workspace import configure, delete, path_exists


def project_contract(observations: DataFrame) -> DataFrame:
    return observations.select(*OBSERVATION_COLUMNS)


def derive_source_month(observations: DataFrame) -> DataFrame:
    """Fills ``source_month`` from the row's own time, only where it is missing."""
    own = month_of(decode_ns_truncated(F.col("time")))
    known = [F.col("source_month")] if "source_month" in observations.columns else []
    return observations.withColumn("source_month", F.coalesce(*known, own))


def drop_month(raw: DataFrame, month: str) -> DataFrame:
    """The table without the rows of one month; rows of no known month stay."""
    return raw.where(~F.col("source_month").eqNullSafe(check_month(month)))


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    """The declared schema keeps the month folder names strings; an absent table reads as an empty one."""
    configure(spark)
    if not path_exists(spark, root):
        return spark.createDataFrame([], RAW_SCHEMA)
    return spark.read.schema(RAW_SCHEMA).parquet(root)


def replace_months(table: DataFrame, by: str, root: str, *, many: bool) -> None:
    """Replaces the folders of the months in the table and leaves the others alone.

    Dynamic overwrite swaps folders only when the whole job has committed. For many months the rows are rebalanced by
    month first, so that tasks x months small files do not come out; one month, or rows read from files of one month
    each, need no such shuffle.
    """
    (
        (table.hint("rebalance", by) if many else table)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(root)
    )


def write_raw(observations: DataFrame, root: str, *, many: bool = True) -> None:
    """The table is cut by loaded month because ``source_month`` follows the row's time: a file with stray rows would
    otherwise replace a neighbouring month."""
    rows = derive_source_month(observations).select(*OBSERVATION_COLUMNS, "source_month", "load_month")
    replace_months(rows, "load_month", root, many=many)


def delete_month(spark: SparkSession, root: str, month: str) -> bool:
    """Takes a loaded month out of the stored table; whether it was there."""
    folder = f"{root}/load_month={check_month(month)}"
    found = path_exists(spark, folder)
    delete(spark, folder)
    return found


def count_month(spark: SparkSession, root: str, month: str) -> int:
    return read_raw(spark, root).where((F.col("load_month") == month) & (F.col("source_month") == month)).count()


def load_raw(spark: SparkSession, bronze_root: str, raw_root: str, month: str, *, force: bool = False) -> int:
    """Loads one landed month and returns its row count. A loaded month is only counted unless forced."""
    existing = count_month(spark, raw_root, check_month(month))
    if existing and not force:
        return existing
    landed = scan_nanos_parquet(spark, bronze_path(month, bronze_root))
    write_raw(project_contract(landed).withColumn("load_month", F.lit(month)), raw_root, many=False)
    return count_month(spark, raw_root, month)
