"""Tables behind JDBC. Spark opens the connections, one per partition."""

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str, table: str, column: str | None = None, lower=None, upper=None,
    partitions: int | None = None, **extra: str,
) -> dict[str, str]:
    """Reader options; a numeric or date `column` with its range splits the read.

    Rows outside the range are read too, by the first and the last partition.
    """
    options = {"url": url, "dbtable": table, **extra}
    if column is not None:
        if None in (lower, upper, partitions):
            raise ValueError("a split read needs lower, upper and partitions")
        options |= {
            "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", **extra: str
) -> None:
    """`extra`: Spark's options, such as `batchsize`."""
    options = jdbc_options(url, table, **extra)
    df.write.format("jdbc").options(**options).mode(mode).save()
