"""Batch sources: Parquet tables, timestamp-named drops, CSV files."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tempora.constants import CITY_COLUMNS, DROP_NAME_PREFIX_LENGTH


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A1: Parquet scan. A fixed ``schema`` skips footer inference and pins types.

    The scan is lazy; projections and filters applied later reach the reader
    (``ReadSchema`` / ``PushedFilters`` in the plan).
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def list_entries(spark: SparkSession, directory: str) -> list[str]:
    """Names of the entries (files or directories) directly under ``directory``.

    Uses the Hadoop FileSystem of the path, as Spark's own file index does, so it
    works on HDFS, object stores and local disks alike. Hidden names are skipped.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(conf)
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return [n for n in names if not n.startswith((".", "_"))]


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a directory, through the Hadoop file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def newest_drop_name(names: Sequence[str], strict: bool = True) -> str:
    """A2/H8: the name whose first 19 characters (yyyy-MM-dd-HH-mm-ss) are the latest.

    First name wins on a tie. With ``strict`` (the original behaviour) a name that
    does not parse raises; otherwise it is ignored. No names raises.
    """
    best_name, best_time = None, None
    for name in names:
        try:
            t = _dt.datetime.strptime(name[:DROP_NAME_PREFIX_LENGTH], "%Y-%m-%d-%H-%M-%S")
        except ValueError:
            if strict:
                raise ValueError(f"drop name does not start with a yyyy-MM-dd-HH-mm-ss time: {name!r}") from None
            continue
        if best_time is None or t > best_time:
            best_name, best_time = name, t
    if best_name is None:
        raise ValueError("no drop to read")
    return best_name


def read_newest_drop(spark: SparkSession, directory: str, schema: T.StructType | str | None = None,
                     strict: bool = True) -> DataFrame:
    """A2: read only the newest timestamp-named drop (a file or a directory) of ``directory``.

    Only the listing touches the driver; the chosen drop is scanned by executors
    and no other drop is opened.
    """
    # Names sorted as an HDFS listing returns them, so a tie always goes to the same drop.
    name = newest_drop_name(sorted(list_entries(spark, directory)), strict=strict)
    return read_table(spark, directory.rstrip("/") + "/" + name, schema)


def read_csv(spark: SparkSession, path: str, sep: str = ",", schema: T.StructType | str | None = None,
             columns: dict[str, str] | Sequence[str] | None = None) -> DataFrame:
    """A3 / A4: CSV with a header line, never with an inference pass.

    With ``schema`` the file's columns are typed as declared. Without it every
    column is read as text and ``columns`` (name -> SQL type, or names) keeps and
    casts only those (B13); CSV column pruning then skips the rest of each line.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if columns is None:
        return df
    if isinstance(columns, dict):
        return df.select(*[df[f"`{c}`"].cast(t).alias(c) for c, t in columns.items()])
    return df.select(*[df[f"`{c}`"] for c in columns])


# Kept columns of the city list and their types (names read from its header; types assumed).
CITY_COLUMN_TYPES = {
    CITY_COLUMNS[0]: "bigint",
    CITY_COLUMNS[1]: "string",
    CITY_COLUMNS[2]: "string",
    CITY_COLUMNS[3]: "string",
    CITY_COLUMNS[4]: "string",
}


def read_serving_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A serving table (batch view / predictions), optionally projected."""
    df = read_table(spark, path)
    return df.select(*columns) if columns else df
