"""Sources: split tables, calendar text files, warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_splits(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Training, validation and testing rows as one table with a ``split`` column.

    With ``split`` as the partition folder, a filter on it never opens the other folders.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def scan_calendar(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A calendar text file with a header and ``MM-dd-yyyy`` dates."""
    return spark.read.csv(path, header=True, schema=schema, dateFormat="MM-dd-yyyy", mode="FAILFAST")


def scan_table(
    spark: SparkSession,
    name: str,
    columns: list[str] | None = None,
    where: str | None = None,
    jdbc: dict[str, str] | None = None,
) -> DataFrame:
    """A warehouse table: through JDBC when connection options are given, else from the catalog.

    Column choice and filter reach the database or the files. For large JDBC tables pass
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` in ``jdbc``.
    """
    if jdbc is None:
        df = spark.table(name)
    else:
        df = spark.read.format("jdbc").options(dbtable=name, **jdbc).load()
    if where:
        df = df.where(where)
    return df.select(*columns) if columns else df
