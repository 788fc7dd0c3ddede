"""Column expressions and DataFrame steps that several operators share."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventloom.llm.words import SPACE_CLASS, SPACES
from eventloom.workspace import new_folder


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def trimmed(text: Column) -> Column:
    """The text (NULL: empty) without white space at both ends."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))


def words_of(text: Column) -> Column:
    """Array of the words of a text."""
    body = trimmed(text)
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE_CLASS + "+"))


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def column(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def boxed(docs: DataFrame, *without: str, **needed: Column) -> DataFrame:
    """The caller's row (but for the columns in ``without``) as one column ``row``, out of reach of any name that an
    operator gives, next to the columns that it reads."""
    rest = [column(c).alias(c) for c in docs.columns if c not in without]
    return docs.select(F.struct(*rest, F.lit(None).cast("boolean").alias("")).alias("row"), *(c.alias(n) for n, c in needed.items()))


def unboxed(docs: DataFrame, *others: str | Column, but: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``row`` again, except those named in ``but``, and others behind them."""
    names = [f.name for f in docs.schema["row"].dataType.fields if f.name and f.name not in but]
    return docs.select(*(F.col("row").getField(c).alias(c) for c in names), *others)


def row_key(text: str = "text", key: str = "doc_id") -> Column:
    """A 64-bit key of a row by its id and text: rows that agree in both get one key, whatever the order of the input."""
    return F.xxhash64(F.col(key), F.col(text))


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps.

    They go when the driver's garbage collector finds their last reference gone, which on a large heap may be hours
    later; the steps of one operator would then add up on the executors' disks.
    """
    for _ in range(2):  # what the first pass finds unused lets go of the rest
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)


def staged(df: DataFrame, label: str, small: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a step that is done, whatever executor is lost later.

    ``small``: the step's shuffle files can wait until a larger step is done.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    out = spark.read.schema(df.schema).parquet(folder)
    out.staged_folder = folder
    if not small:
        release(spark)
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        session = table.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path(table.staged_folder)
        path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)
