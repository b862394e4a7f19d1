"""JDBC tables (connection details always come from the caller)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casemill.sources.ranges import even_bounds, range_predicates


def read_jdbc_table(spark: SparkSession, url: str, table: str, *, properties: dict[str, str] | None = None,
                    partition_column: str | None = None, lower_bound: int | None = None,
                    upper_bound: int | None = None, num_partitions: int | None = None,
                    fetch_size: int = 10000) -> DataFrame:
    """A table read over JDBC, split into parallel range reads when asked.

    Filters and column selection on the result are pushed into the SQL the
    database runs; give a numeric `partition_column` with bounds so a large
    table is read by `num_partitions` tasks instead of one.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    return reader.load()


def read_jdbc_even(spark: SparkSession, url: str, table: str, column: str, num_partitions: int, *,
                   properties: dict[str, str] | None = None, quote: str = '"', fetch_size: int = 10000) -> DataFrame:
    """A table read over JDBC in ranges of about equally many rows.

    For a column whose values are unevenly spread, nulls or strings included,
    where equal steps (`read_jdbc_table`) would leave one task with most rows.
    It costs a read of that one column (two of a string column) through one
    connection, which keeps nothing but a sketch.  The database must order
    strings by their bytes or code points, or rows could fit no part as Spark
    sees them; they still fit exactly one as the database does.
    """
    column_only = read_jdbc_table(spark, url, table, properties=properties, fetch_size=fetch_size).select(column)
    quoted = quote + column.replace(quote, quote * 2) + quote
    ranges = range_predicates(column, even_bounds(column_only, column, num_partitions), quoted)
    return spark.read.jdbc(url, table, predicates=ranges, properties={"fetchsize": str(fetch_size), **(properties or {})})


def write_jdbc_table(df: DataFrame, url: str, table: str, *, mode: str = "append",
                     properties: dict[str, str] | None = None, column_types: str | None = None,
                     batch_size: int = 1000) -> None:
    """Write a DataFrame to a JDBC table (batched inserts from every task)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()
