"""Tables, views and report exports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column types of the exported table definitions.
DDL_TYPES = {
    T.StringType: "varchar",
    T.DoubleType: "double precision",
    T.LongType: "bigint",
    T.IntegerType: "integer",
    T.BooleanType: "boolean",
    T.DateType: "date",
    T.TimestampType: "timestamp",
}


def save_table(model: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Full refresh of a stored table."""
    writer = model.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return model.sparkSession.table(name)


def save_view(model: DataFrame, name: str) -> DataFrame:
    model.createOrReplaceTempView(name)
    return model.sparkSession.table(name)


def flat_for_csv(report: DataFrame) -> DataFrame:
    """CSV has no arrays; they become comma-joined text."""
    return report.select(
        *[
            F.concat_ws(",", f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
            for f in report.schema
        ]
    )


def export_report(report: DataFrame, name: str, root: str) -> None:
    """One report as Parquet and as a single CSV file with a header.

    The CSV is made from the Parquet just written, so the report runs once. Reports are aggregates of a few
    thousand rows, which is why one CSV file is enough.
    """
    report.write.mode("overwrite").parquet(f"{root}/{name}_parquet")
    stored = report.sparkSession.read.parquet(f"{root}/{name}_parquet")
    flat_for_csv(stored).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{root}/{name}_csv")


def export_reports(reports: Mapping[str, DataFrame], root: str) -> None:
    for name, report in reports.items():
        export_report(report, name, root)


def export_json(document: DataFrame, path: str) -> None:
    """Nested rows as JSON; struct, map and array columns keep their shape, and NULL fields stay visible."""
    document.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def export_tables_csv(tables: Mapping[str, DataFrame], root: str) -> None:
    """Marts as headered CSV, written by as many tasks as the table has partitions."""
    for name, table in tables.items():
        flat_for_csv(table).write.mode("overwrite").option("header", True).csv(f"{root}/{name}")


def table_definitions(spark: SparkSession, tables: Mapping[str, DataFrame], schema: str = "marts") -> DataFrame:
    """CREATE TABLE text for each table, columns in table order."""
    rows = [
        (name, at, f.name, DDL_TYPES[type(f.dataType)])
        for name, table in tables.items()
        for at, f in enumerate(table.schema)
    ]
    columns = spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, type string")
    columns.createOrReplaceTempView("lateline_table_columns")
    return spark.sql(
        """
        SELECT table_name,
               concat('create table if not exists ', :schema, '.', table_name, ' (',
                      listagg(concat(column_name, ' ', type), ', ') WITHIN GROUP (ORDER BY ordinal), ');') AS ddl
        FROM lateline_table_columns
        GROUP BY table_name
        """,
        args={"schema": schema},
    )
