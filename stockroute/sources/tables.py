"""Table sink and scan.

A write replaces the table and its schema. Delta is used when its package is
on the class path; otherwise Parquet. Tables are addressed as
``database.table`` in the session catalog, or by path when ``root`` is given
(a shared folder such as the cluster's checkpoint directory).
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def delta_available(spark: SparkSession) -> bool:
    """Delta is usable when its session extension is configured."""
    return "DeltaSparkSessionExtension" in (spark.conf.get("spark.sql.extensions", "") or "")


def table_format(spark: SparkSession, fmt: str | None = None) -> str:
    if fmt:
        return fmt
    return "delta" if delta_available(spark) else "parquet"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def write_table(df: DataFrame, name: str, *, database: str | None = None, root: str | None = None,
                fmt: str | None = None, partition_by=(), append: bool = False) -> str:
    """Overwrite a table (schema included), or ``append`` to it. Returns its name or path."""
    spark = df.sparkSession
    fmt = table_format(spark, fmt)
    writer = df.write.format(fmt).mode("append") if append else df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if root:
        path = os.path.join(root, name)
        writer.save(path)
        return path
    full = f"`{database}`.`{name}`" if database else f"`{name}`"
    if database:
        ensure_database(spark, database)
    writer.saveAsTable(full)
    return full


def read_table(spark: SparkSession, name: str, *, database: str | None = None,
               root: str | None = None, fmt: str | None = None) -> DataFrame:
    if root:
        return spark.read.format(table_format(spark, fmt)).load(os.path.join(root, name))
    return spark.table(f"`{database}`.`{name}`" if database else f"`{name}`")


def table_exists(spark: SparkSession, name: str, *, database: str | None = None, root: str | None = None) -> bool:
    if not root:
        return spark.catalog.tableExists(f"`{database}`.`{name}`" if database else f"`{name}`")
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(root, name))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


PART = "part"


def part_path(root: str, stem: str, value: str) -> str:
    return os.path.join(root, stem, f"{PART}={value}")


OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Partitioned writes inside keep up to ``most`` files a task open at once; with
    more partitions in a task, Spark sorts its remaining rows as it does by default.
    Spark falls back to the sort as soon as its limit is reached, so that is one more."""
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, str(max(most + 1, int(before))))
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES, before)


def write_split(df: DataFrame, column: str, tables: dict[str, str], stem: str, *, database: str | None = None,
                root: str | None = None, fmt: str | None = None,
                columns: dict[str, tuple[str, ...]] | None = None, compression: str | None = None) -> tuple[dict[str, str], dict[str, int]]:
    """Several tables by one pass: ``df`` is written once, partitioned by the values
    of ``column`` (which stays a column of the files), and ``tables`` (name -> value)
    are the partitions. Returns their names or paths, and their row counts.

    The files are below ``root``, or below the database's location with the names
    registered as external tables. A value without rows gets an empty table. Rows
    with other values are an error. A table named in ``columns`` is registered with
    these columns only. A task keeps one file a table open, so its rows are not sorted
    by the column first. Formats with a log of their own (Delta) have no
    tables inside a table: there each is written by a pass of its own."""
    spark = df.sparkSession
    fmt = table_format(spark, fmt)
    place = {"database": database, "root": root, "fmt": fmt}
    if fmt == "delta":
        where, counts = {}, {}
        for name, value in tables.items():
            seen = Observation()
            part = df.where(F.col(column) == value).select(*(columns or {}).get(name, df.columns)).observe(seen, F.count(F.lit(1)).alias("rows"))
            where[name] = write_table(part, name, **place)
            counts[name] = seen.get["rows"]
        return where, counts
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[
        F.count_if(F.col(column) == value).alias(name) for name, value in tables.items()])
    if database:
        ensure_database(spark, database)
        base = spark.catalog.getDatabase(database).locationUri
    else:
        base = root
    writer = rows.withColumn(PART, F.col(column)).write.format(fmt).mode("overwrite").partitionBy(PART)
    if compression:
        writer = writer.option("compression", compression)
    with _open_files(spark, len(tables)):
        writer.save(os.path.join(base, stem))
    counts = dict(seen.get)
    if counts.pop("rows") != sum(counts.values()):
        raise ValueError(f"{column} has values other than {sorted(tables.values())}")
    where = {}
    for name, value in tables.items():
        path = part_path(base, stem, value)
        if not counts[name]:
            spark.createDataFrame([], df.schema).write.format(fmt).mode("overwrite").save(path)
        where[name] = path
        if database:
            where[name] = f"`{database}`.`{name}`"
            spark.sql(f"DROP TABLE IF EXISTS {where[name]}")
            kept = (columns or {}).get(name, df.columns)
            spark.catalog.createTable(f"{database}.{name}", path=path, source=fmt, schema=df.select(*kept).schema)
    return where, counts
