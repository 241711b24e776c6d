"""Tables on the shared folder, row marks and broadcasting behind a size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelcast.session import prepare, shared_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()
#: The characters 0x20 and 0x09-0x0D.
BLANKS = " \t\n\x0b\x0c\r"
#: Texts that a worker gets at a time: a few megabytes, where Spark's default of 10,000 rows would be tens.
BATCH_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500
#: A table of at most this many rows may be broadcast; callers keep rows under about 100 bytes, so 20 MB at most.
BROADCAST_ROWS = 200_000


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the folder all executors share and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_plain(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast only for a table whose counted rows are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame doesn't have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row(df: DataFrame) -> tuple[DataFrame, str]:
    """Mark each row with a number of its own, and write it: every later step reads the same numbers.

    A number given in each step anew would follow the partitions of that step's scan, and so the executors of the moment.
    """
    name = unused(df, "_row")
    return stored(df.withColumn(name, F.monotonically_increasing_id()), "marked"), name


def text_session(spark: SparkSession) -> SparkSession:
    """Session settings for rows that hold whole texts: few of them travel to a Python worker at a time."""
    prepare(spark)
    if int(spark.conf.get(BATCH_KEY)) > BATCH_ROWS:
        spark.conf.set(BATCH_KEY, str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
