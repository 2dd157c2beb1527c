"""Published tables: parquet folders cut into partitions that a write replaces.

Writes use Spark's dynamic partition overwrite: tasks write beside the table, and the job's commit puts
whole partitions in place of those of the same name, so a job that fails leaves the table as it was and
may read what it replaces. A driver lost within the commit itself, while folders are renamed, may leave
some partitions old, and one absent whose files are still in the hidden staging folder.

One writer per table at a time, as one daily run gives. The file system must have renames.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART, WHOLE = "part", "all"


def _is_missing(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


@dataclass(frozen=True)
class Table:
    spark: SparkSession
    path: str
    schema: T.StructType

    def _scan(self) -> DataFrame | None:
        schema = T.StructType([*self.schema.fields, T.StructField(PART, T.StringType())])
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if _is_missing(error):
                return None
            raise

    def exists(self) -> bool:
        return self._scan() is not None

    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        """The table, or the named partitions of it; no rows if nothing was published yet."""
        rows = self._scan()
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        if parts is not None:
            rows = rows.where(F.col(PART).isin(list(parts)))
        return rows.select(*self.schema.names)

    def _empty(self, mode: str) -> None:
        none = self.spark.createDataFrame([], self.schema).withColumn(PART, F.lit(WHOLE))
        none.write.mode(mode).partitionBy(PART).parquet(self.path)

    def ensure(self) -> None:
        """Make an empty table if there is none."""
        self._empty("ignore")

    def overwrite(self, df: DataFrame) -> None:
        """Replace the whole table, which is one partition."""
        written = Observation()
        counted = df.select(*self.schema.names).observe(written, F.count(F.lit(1)).alias("rows"))
        self._write(counted.withColumn(PART, F.lit(WHOLE)))
        if not written.get["rows"]:  # no partition was written, so none was replaced
            self._empty("overwrite")

    def replace_parts(self, df: DataFrame, part: Column) -> None:
        """Put ``df`` in place of the partitions it has rows of; ``df`` must hold all rows of these.

        ``part`` must yield a date or its text, so that partitions stay few.
        """
        cut = df.select(*self.schema.names, part.cast("string").alias(PART))
        # Rebalancing gathers each partition into files of the advisory size and
        # splits one that holds most of the rows over many tasks.
        self._write(cut.hint("rebalance", F.col(PART)))

    def _write(self, df: DataFrame) -> None:
        dynamic = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        dynamic.partitionBy(PART).parquet(self.path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate files, on whatever file system it is."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


@dataclass(frozen=True)
class Warehouse:
    """All tables of one deployment below one folder."""

    spark: SparkSession
    root: str

    def table(self, name: str, schema: T.StructType) -> Table:
        return Table(self.spark, f"{self.root}/{name}", schema)

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows to a plain append-only log table."""
        df.write.mode("append").parquet(f"{self.root}/{name}")

    def read_log(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if _is_missing(error):
                return self.spark.createDataFrame([], schema)
            raise
