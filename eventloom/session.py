"""Session construction and the settings the library relies on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Settings that can be changed on a running session.
RUNTIME_CONF = {
    # event_timestamp is microseconds since the epoch in UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split a hot key even where that costs one more exchange downstream
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows of one key compress well, so a partition with very many of them may look small
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


MEGABYTE = 1 << 20
SHUFFLE_PARTITION_BYTES = 128 * MEGABYTE
MOST_SCAN_TASKS = 100_000
LARGEST_SPLIT = 1024 * MEGABYTE


def fit_to_input(spark: SparkSession, input_bytes: int) -> None:
    """Raise the number of shuffle partitions and the scan split size to what an input of this size needs.

    AQE can merge shuffle partitions that turn out small but cannot split ordinary ones that are too large, so it
    starts from a count that grows with the input. Very large inputs get larger splits: scans read a few columns of
    each, and the number of scan tasks times shuffle partitions has to stay manageable. Settings are never lowered.
    """
    partitions = input_bytes // SHUFFLE_PARTITION_BYTES
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    current = int(spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if partitions > current:
        spark.conf.set(initial, str(partitions))
    split = min(input_bytes // MOST_SCAN_TASKS, LARGEST_SPLIT)
    if split > spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes():
        spark.conf.set("spark.sql.files.maxPartitionBytes", f"{split}b")


def size_in_bytes(df: DataFrame) -> int:
    """The optimizer's size of a frame; for files, their total length."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def in_few_tasks(df: DataFrame) -> DataFrame:
    """A scan in no more tasks than twice what its bytes need, or several per core.

    Spark takes a very small file for ``spark.sql.files.openCostInBytes``, so a table of them is read a few files a task,
    and starting the tasks takes longer than reading.
    """
    spark = df.sparkSession
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.coalesce(max(2 * size_in_bytes(df) // split + 1, 8 * spark.sparkContext.defaultParallelism))


def get_session(
    app_name: str = "eventloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Build (or fetch) a session.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset and give
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` a generous
    value through ``conf``: AQE merges small shuffle partitions afterwards.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())
