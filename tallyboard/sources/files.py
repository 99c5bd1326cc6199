"""Parquet and CSV in and out."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def scan_parquet(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Parquet files under a path; ``recursive`` walks nested folders that are not partitions."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.parquet(path)


def scan_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header line. Without a schema every column is text; nothing is inferred."""
    reader = spark.read.option("header", "true")
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def write_table(df: DataFrame, path: str, layout: Sequence[str] = ()) -> DataFrame:
    """Write a stage's result as Parquet and continue from what was written.

    ``layout`` ranges and sorts the rows by columns that later reads filter on, a month
    for example, so that whole files and row groups are skipped.
    """
    if layout:
        df = df.repartitionByRange(*layout).sortWithinPartitions(*layout)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_dealt(df: DataFrame, path: str, keys: Sequence[str], tasks: int) -> DataFrame:
    """The same for rows that are dealt over ``tasks`` by ``keys``: reads know how they lie.

    The layout is told by a catalogue entry that is dropped again; the files stay.
    """
    spark, name = df.sparkSession, f"dealt_{uuid.uuid4().hex}"
    df.write.bucketBy(tasks, *keys).format("parquet").option("path", path).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write a result as CSV with a header, in as many files as it has partitions.

    ``single_file`` is for small published tables that a dashboard loads as one file.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)
