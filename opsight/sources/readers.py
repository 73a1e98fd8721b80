"""Table and file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_files(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Files of any built-in format; text formats need a schema, none is guessed from the data."""
    if fmt in ("csv", "json") and schema is None:
        raise ValueError(f"{fmt} needs a schema")
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_remote(
    spark: SparkSession, url: str, table: str, partition_column: str | None = None, bounds: tuple | None = None,
    partitions: int = 32, **options,
) -> DataFrame:
    """A table of another database over JDBC. Spark pushes filters and columns down; with a
    partition column the read is spread over ``partitions`` range queries."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column:
        low, high = bounds
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=low, upperBound=high, numPartitions=partitions
        )
    return reader.load()


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int | None = None,
                 glob: str | None = None) -> DataFrame:
    """A folder of arriving files as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)
