"""Reading and writing Parquet and CSV tables, and listing stored objects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the column a pandas row index turns into in Parquet.
PANDAS_INDEX = "__index_level_0__"
OPEN_FILES = 32  # of one task in a partitioned write


def nanos_to_timestamp(col: Column) -> Column:
    """Epoch nanoseconds to a zone-less timestamp (microseconds)."""
    micros = F.call_function("div", col - F.pmod(col, F.lit(1000)), F.lit(1000))
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def read_parquet(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    ns_columns: Sequence[str] = (),
) -> DataFrame:
    """Read a Parquet table.

    The row index pandas may have stored is dropped: row order is never
    implied, it comes from an explicit key. ``ns_columns`` names the columns
    stored as nanosecond times (needs ``nanosAsLong``, see ``session``).
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.parquet(*paths)
    if PANDAS_INDEX in df.columns:
        df = df.drop(PANDAS_INDEX)
    if columns is not None:
        df = df.select(*columns)
    for name in ns_columns:
        df = df.withColumn(name, nanos_to_timestamp(F.col(name)))
    return df


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Read CSV with a header and a declared schema.

    Quotes inside a field are doubled, an empty field is null, blanks belong
    to the text, and a value that does not fit its type fails the read. Fields
    may hold line breaks, so a file is one task; where none does,
    ``multi_line=False`` lets large files be split, and a line break in a
    field would then pass for the end of a row.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Write CSV with a header, in the form ``read_csv`` reads."""
    (
        df.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a Parquet table to a new path, optionally in one folder per value.

    A task keeps the files of up to ``OPEN_FILES`` folders open and writes rows
    as they come; only with more folders it sorts its rows by folder.
    """
    if not partition_by:
        df.write.parquet(path)
        return
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name, None)
    conf.set(name, OPEN_FILES)
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def list_objects(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Path, modification time and size of stored files; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "modificationTime", "length")
