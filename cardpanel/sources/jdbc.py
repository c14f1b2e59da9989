"""Database query source: ``spark.read.format("jdbc")`` with injected options.

Connection settings are passed in (or read from a caller-supplied mapping such
as ``os.environ``); nothing is hard-wired.  Parallel reads need a numeric
``partition_column`` with bounds, otherwise one task reads the whole result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Setting names and defaults of the database connection.
DEFAULTS = {"DB_HOST": "localhost", "DB_PORT": "5432", "DB_NAME": "credit_risk", "DB_USER": "postgres"}


def jdbc_options(env: Mapping[str, str], query: str | None = None, table: str | None = None,
                 partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10000) -> dict[str, str]:
    get = lambda k: env.get(k, DEFAULTS.get(k, ""))
    opts = {
        "url": f"jdbc:postgresql://{get('DB_HOST')}:{get('DB_PORT')}/{get('DB_NAME')}",
        "user": get("DB_USER"),
        "password": env.get("DB_PASSWORD", ""),
        "driver": "org.postgresql.Driver",
        "fetchsize": str(fetch_size),
    }
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query / table")
    if partition_column:
        if table is None:
            table = f"({query}) AS q"
            query = None
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                     "numPartitions": str(num_partitions or 8)})
    if query is not None:
        opts["query"] = query
    else:
        opts["dbtable"] = table
    return opts


def read_query(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
