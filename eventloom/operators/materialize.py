"""Explicit execution: keep a result on the cluster, or bring a small one to the client."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from eventloom.operators.udf_policy import apply_policy, udf_report
from eventloom.workspace import note_python, shared_folder, stage


def compute(df: DataFrame, mode: str = "table", udf_policy: str = "ignore") -> DataFrame:
    """Execute once and return a frame to query further.

    ``table`` writes Parquet in the shared folder, ``checkpoint`` uses Spark's reliable checkpoint, ``cache`` keeps
    blocks on the executors (recomputed when one is lost). Python code that made a ``table`` stays known to
    ``udf_report`` and the policies of later frames.
    """
    apply_policy(df, udf_policy)
    if mode == "table":
        staged, nodes = stage(df, "compute"), udf_report(df)
        if nodes:
            note_python(staged, nodes)
        return staged
    if mode == "checkpoint":
        if df.sparkSession.sparkContext.getCheckpointDir() is None:
            df.sparkSession.sparkContext.setCheckpointDir(shared_folder(df.sparkSession))
        return df.checkpoint(eager=True)
    if mode == "cache":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    raise ValueError(f"unknown mode {mode!r}")


def collect_limited(df: DataFrame, limit: int = 100_000, udf_policy: str = "ignore"):
    """The result as a pandas frame; raises instead of pulling more than ``limit`` rows to the driver."""
    apply_policy(df, udf_policy)
    result = df.limit(limit + 1).toPandas()
    if len(result) > limit:
        raise MemoryError(f"more than {limit} rows; aggregate further or use compute()")
    return result
