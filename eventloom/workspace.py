"""Intermediate tables in the folder all executors share.

``stage`` writes a DataFrame as Parquet and reads it back. That cuts lineage, survives the loss of executors, and
gives the optimizer the true size of the intermediate result, so whether a later join broadcasts it is decided
against ``spark.sql.autoBroadcastJoinThreshold`` and not by a hint.
"""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Part of the path of every staged table.
STAGED = "/eventloom/"


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a new temporary one only for a local master without that setting."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventloom-"))
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder nobody else writes to (not created yet)."""
    return f"{shared_folder(spark)}{STAGED}{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a DataFrame over the written files; ``discard`` removes them."""
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    staged = spark.read.schema(df.schema).parquet(folder)
    staged.staged_folder = folder
    return staged


LINEAGE = "_python_nodes.json"


def note_python(staged: DataFrame, nodes: list[str]) -> None:
    """Leave a note next to the files of a staged table: the Python plan nodes that its rows went through."""
    spark = staged.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{staged.staged_folder}/{LINEAGE}")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    stream.write(bytearray(json.dumps(nodes).encode()))
    stream.close()


def noted_python(spark: SparkSession, folder: str) -> list[str]:
    """What ``note_python`` left in a folder; nothing for other folders."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{LINEAGE}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def discard(*staged: DataFrame) -> None:
    """Remove the files of staged tables that nothing reads any more."""
    for table in staged:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.staged_folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
