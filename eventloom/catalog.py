"""Views and tables: expose frames to SQL, keep copies, inspect what is there."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame, SparkSession, functions as F


class ReadOnlyError(RuntimeError):
    """A write on a catalog that was opened for reading."""


class Catalog:
    """One database of a Spark session. ``read_only`` blocks everything that would change stored tables."""

    def __init__(self, spark: SparkSession, database: str = "default", read_only: bool = False):
        self.spark, self.database, self.read_only = spark, database, read_only
        if not read_only:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")

    def _qualified(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def _check_writable(self) -> None:
        if self.read_only:
            raise ReadOnlyError(f"{self.database} is open for reading only")

    def register(self, name: str, df: DataFrame) -> DataFrame:
        """Temporary view over a frame; nothing is copied or read."""
        df.createOrReplaceTempView(name)
        return self.spark.table(name)

    def register_path(self, name: str, path: str, fmt: str = "parquet") -> DataFrame:
        """Temporary view over files."""
        return self.register(name, self.spark.read.format(fmt).load(path))

    def create_table(
        self,
        name: str,
        df: DataFrame,
        bucket_by: Sequence[str] = (),
        buckets: int = 0,
        sort_by: Sequence[str] = (),
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """Stored copy. Tables bucketed alike on the join key are joined without a shuffle."""
        self._check_writable()
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket_by:
            writer = writer.bucketBy(buckets, *bucket_by)
            if sort_by:
                writer = writer.sortBy(*sort_by)
        writer.saveAsTable(self._qualified(name))
        return self.table(name)

    def drop_table(self, name: str) -> None:
        self._check_writable()
        self.spark.sql(f"DROP TABLE IF EXISTS {self._qualified(name)}")

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._qualified(name))

    def tables(self) -> list[str]:
        """Names of the stored tables."""
        return sorted(t.name for t in self.spark.catalog.listTables(self.database) if not t.isTemporary)

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """Run a SELECT; frames given by name are usable in the text as ``{name}``."""
        if self.read_only and self._changes_something(text.format(**{name: name for name in frames}) if frames else text):
            raise ReadOnlyError("only queries are allowed")
        return self.spark.sql(text, **frames)

    def _changes_something(self, text: str) -> bool:
        """Whether the statement, as the session parses it, holds a command or an insert anywhere."""
        plan = self.spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
        gateway, logical = self.spark.sparkContext._gateway, "org.apache.spark.sql.catalyst.plans.logical."
        nodes = [plan]
        while nodes:
            node = nodes.pop()
            # these only read, whatever statement they are about
            if node.getClass().getSimpleName().startswith(("Show", "Describe", "Explain")):
                continue
            if any(is_instance_of(gateway, node, logical + kind) for kind in ("Command", "InsertIntoStatement")):
                return True
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]
        return False

    def row_counts(self) -> DataFrame:
        """Number of rows of each stored table."""
        return row_counts({name: self.table(name) for name in self.tables()})


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per frame: its name and number of rows. Parquet answers this from the footers."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in frames.items()]
    return reduce(DataFrame.unionAll, counts)
