"""Bronze: monthly files kept as they came, under year=/month= folders."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.contract import OBSERVATION_COLUMNS, OBSERVATION_SCHEMA
from lateline.functions.months import check_month
from lateline.workspace import configure, delete, folders, path_exists, replace_folder

BRONZE_PREFIX = "bronze/monthly-raw"

# Where a path says which month its rows belong to, by file name and by folder.
FILE_MONTH_PATTERN = r"data-(\d{4}-\d{2})\.parquet"
FOLDER_MONTH_PATTERN = r"year=(\d{4})/month=(\d{2})"


def month_folder(root: str, month: str) -> str:
    year, number = check_month(month).split("-")
    return f"{root}/year={year}/month={number}"


def bronze_path(month: str, root: str = BRONZE_PREFIX) -> str:
    return f"{month_folder(root, month)}/data-{month}.parquet"


def month_of_path(path: Column) -> Column:
    named = F.regexp_extract(path, FILE_MONTH_PATTERN, 1)
    folder = F.concat_ws(
        "-", F.regexp_extract(path, FOLDER_MONTH_PATTERN, 1), F.regexp_extract(path, FOLDER_MONTH_PATTERN, 2)
    )
    return F.when(named != "", named).otherwise(folder)


def scan_nanos_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet whose TIMESTAMP(NANOS) columns arrive as longs; Spark refuses such files otherwise."""
    return configure(spark).read.option("recursiveFileLookup", "true").parquet(*paths)


def scan_months(spark: SparkSession, root: str, months: Iterable[str]) -> DataFrame:
    """Only the folders of the given months are listed and read."""
    return scan_nanos_parquet(spark, *[month_folder(root, m) for m in months])


def with_provenance(scan: DataFrame) -> DataFrame:
    """Adds the file a row came from and the month that file stands for.

    The metadata columns are constant within a file, so they cost no data read and filters on them skip files.
    """
    return scan.select(
        "*", F.col("_metadata.file_path").alias("source_file"), month_of_path(F.col("_metadata.file_path")).alias("source_month")
    )


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """All landed months, each row with the month of its folder.

    The folder names are partition columns here: they cost no work per row, and a filter on the month leaves the
    folders of other months unread. They are declared as strings to keep leading zeros.
    """
    folders = [T.StructField("year", T.StringType()), T.StructField("month", T.StringType())]
    schema = T.StructType([*OBSERVATION_SCHEMA.fields, *folders])
    landed = configure(spark).read.schema(schema).parquet(root)
    return landed.select(*OBSERVATION_COLUMNS, F.concat_ws("-", "year", "month").alias("source_month"))


def file_sizes(spark: SparkSession, *paths: str) -> DataFrame:
    """Size by month from a file listing; the content column is never selected, so no file is opened."""
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    )
    return (
        listing.load(list(paths))
        .groupBy(month_of_path(F.col("path")).alias("source_month"))
        .agg(F.round(F.sum("length") / F.lit(1024.0**2), 2).alias("file_size_mb"))
        .select("source_month", F.concat(F.lit("data-"), "source_month", F.lit(".parquet")).alias("file_name"), "file_size_mb")
    )


def has_landed(spark: SparkSession, month: str, root: str) -> bool:
    """A folder counts as landed once its commit marker is there."""
    return path_exists(spark, f"{bronze_path(month, root)}/_SUCCESS")


def land_month(spark: SparkSession, source: str, month: str, root: str, *, force: bool = False) -> bool:
    """Lands one month in Bronze, values and columns unchanged. A month that is already there stays unless forced.

    Spark writes the rows anew, as a folder; nanosecond times keep their numbers but lose the annotation of their type,
    which Spark can't write. A landing that broke off is done again.
    """
    if not force and has_landed(spark, month, root):
        return False
    scan_nanos_parquet(spark, source).write.mode("overwrite").parquet(bronze_path(month, root))
    return True


def stage_months(observations: DataFrame, file_month: Column, folder: str) -> None:
    """Writes many months in one job, away from Bronze.

    The rebalance hint lets the adaptive plan cut a month that holds most of the rows into several files and put
    small months together in one task, so neither one huge task nor tasks x months small files come out.
    """
    parts = F.split(file_month, "-")
    (
        observations.select(*OBSERVATION_COLUMNS, parts[0].alias("year"), parts[1].alias("month"))
        .hint("rebalance", "year", "month")
        .write.partitionBy("year", "month")
        .parquet(folder)
    )


def staged_months(spark: SparkSession, folder: str) -> list[str]:
    return [
        f"{year.removeprefix('year=')}-{month.removeprefix('month=')}"
        for year in folders(spark, folder)
        for month in folders(spark, f"{folder}/{year}")
    ]


def publish_months(spark: SparkSession, folder: str, root: str, *, force: bool = False) -> list[str]:
    """Moves staged months into Bronze: those that aren't there, and with ``force`` in the place of those that are."""
    moved = []
    for month in staged_months(spark, folder):
        if force or not path_exists(spark, month_folder(root, month)):
            replace_folder(spark, month_folder(folder, month), month_folder(root, month))
            moved.append(month)
    delete(spark, folder)
    return moved


def land_months(observations: DataFrame, file_month: Column, root: str, *, force: bool = False) -> list[str]:
    """Lands many months in one job and returns those it landed. Other months, and landed ones unless forced, stay."""
    spark = observations.sparkSession
    folder = staging_folder(root)
    stage_months(observations, file_month, folder)
    return publish_months(spark, folder, root, force=force)


def staging_folder(root: str) -> str:
    """A new folder beside a table; readers of the table don't see it."""
    return f"{root}.staging/{uuid.uuid4().hex}"
