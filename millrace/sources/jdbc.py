"""Database sources over JDBC: whole tables in parallel, or a query that runs in the database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.config import as_list, blank_to_none, secret

# URL shape and driver class per database.
URLS = {
    "mysql": "jdbc:mysql://{hostname}:{port}/{database}",
    "postgres": "jdbc:postgresql://{hostname}:{port}/{database}",
    "mssql": "jdbc:sqlserver://{hostname}:{port};databaseName={database}",
    "oracle": "jdbc:oracle:thin:@//{hostname}:{port}/{database}",
    "snowflake": "jdbc:snowflake://{hostname}/?db={database}",
}
DRIVERS = {
    "mysql": "com.mysql.cj.jdbc.Driver",
    "postgres": "org.postgresql.Driver",
    "mssql": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "oracle": "oracle.jdbc.OracleDriver",
    "snowflake": "net.snowflake.client.jdbc.SnowflakeDriver",
}
DEFAULT_PARTITIONS = 32


def connection_options(database: str, connection: dict) -> dict[str, str]:
    """Options of a connection. A `url` in it wins; the password comes from the environment."""
    url = connection.get("url") or URLS[database].format(**connection)
    options = {"url": url}
    driver = connection.get("driver") or DRIVERS.get(database)
    if driver:
        options["driver"] = driver
    if connection.get("username"):
        options["user"] = connection["username"]
        options["password"] = secret(connection.get("connection_name") or database)
    return options


def table_name(spec: dict) -> str:
    """`database.schema.table`, whichever parts are given."""
    parts = [blank_to_none(spec.get(k)) for k in ("database", "schema", "table_name")]
    return ".".join(p for p in parts if p)


def hash_slices(column: str, slices: int, database: str = "") -> list[str]:
    """Disjoint predicates that cover all rows, nulls too. Even where a value range would be skewed."""
    rest = f"ABS({column}) % {slices}" if database == "mssql" else f"MOD(ABS({column}), {slices})"  # SQL Server has no MOD
    return [f"{rest} = 0 OR {column} IS NULL", *[f"{rest} = {i}" for i in range(1, slices)]]


def read_jdbc(spark: SparkSession, database: str, source: dict, connection: dict) -> DataFrame:
    """`query` if given, else the table.

    `partition_column` splits a table scan: by value range (bounds asked from the database), or with
    `partition_by_hash` by hash slices. Filters and column selection are pushed down by Spark.
    """
    options = connection_options(database, connection)
    if source.get("chunk_size"):
        options["fetchsize"] = str(source["chunk_size"])
    query = blank_to_none(source.get("query"))
    if query:
        return spark.read.format("jdbc").options(**options, query=query.strip().rstrip(";")).load()
    table, column = table_name(source), source.get("partition_column")
    slices = int(source.get("partitions") or DEFAULT_PARTITIONS)
    if column and source.get("partition_by_hash"):
        url = options.pop("url")
        df = spark.read.jdbc(url, table, predicates=hash_slices(column, slices, database), properties=options)
    else:
        if column:
            low, high = (
                spark.read.format("jdbc").options(**options, query=f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}").load().first()
            )
            if low is not None:
                options |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(slices)}
        df = spark.read.format("jdbc").options(**options, dbtable=table).load()
    columns = as_list(source.get("select_columns"))
    return df.select(*columns) if columns else df
